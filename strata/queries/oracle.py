"""DuckDB SQL for every registered query, written independently of the
Spark code: the derived feeds, the rules and the layer steps are restated
in SQL over the benchmark tables (``events``, ``orders``, ``lineitem``).

Columns carry the same names and types as the Spark results.  Audit
timestamps are compared as NOT NULL flags; quarantine rows by their row key
instead of the JSON text.
"""

from __future__ import annotations

from strata.schemas import ROADS_COLUMNS, TRAFFIC_COLUMNS

_NUMERIC = ("IntegerType", "DoubleType", "LongType")

TRAFFIC_PAYLOAD = [n for n, _ in TRAFFIC_COLUMNS]
TP = ", ".join(TRAFFIC_PAYLOAD)
ROADS_PAYLOAD = [n for n, _ in ROADS_COLUMNS]
RP = ", ".join(ROADS_PAYLOAD)

L_NN = "[Record_ID] expect_column_values_to_not_be_null"
L_FMT = "[Count_date] expect_column_values_to_match_strftime_format"
L_HOUR = "[hour] expect_column_values_to_be_between"
L_CAT = "[Road_Category_Id] expect_column_values_to_be_between"
L_RNN = "[Road_ID] expect_column_values_to_not_be_null"
L_LEN = "[Total_Link_Length_Km] expect_column_values_to_be_between"
L_TABLE = "[Table] expect_table_columns_to_match_set"

TRAFFIC_LIKE = """traffic_like AS (
  SELECT
    CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST(event_id AS INTEGER) END AS Record_ID,
    CAST(event_id AS INTEGER) AS Count_point_id,
    CASE WHEN event_id % 19 = 0 THEN NULL ELSE event_type END AS Direction_of_travel,
    CAST(year(ts) AS INTEGER) AS "Year",
    CASE WHEN event_id % 7 = 0 THEN strftime(ts, '%d/%m/%Y %H:%M')
         ELSE strftime(ts, '%-m/%-d/%Y %-H:%M') END AS Count_date,
    CAST(hour(ts) AS INTEGER) AS "hour",
    CAST(user_id % 5 AS INTEGER) AS Region_id,
    'Region ' || CAST(user_id % 5 AS VARCHAR) AS Region_name,
    'Authority ' || CAST(user_id % 11 AS VARCHAR) AS Local_authority_name,
    'R' || CAST(user_id % 13 AS VARCHAR) AS Road_name,
    CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST(event_id % 6 AS INTEGER) END AS Road_Category_ID,
    'J' || CAST(event_id % 31 AS VARCHAR) AS Start_junction_road_name,
    CASE WHEN event_id % 37 = 0 THEN NULL ELSE 'J' || CAST(event_id % 41 AS VARCHAR) END AS End_junction_road_name,
    CAST(user_id AS DOUBLE) / CAST(4 AS DOUBLE) AS Latitude,
    value * CAST(-1 AS DOUBLE) AS Longitude,
    CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 13 = 0 THEN CAST(0 AS DOUBLE) ELSE value END
      AS Link_length_km,
    CASE WHEN event_id % 23 = 0 THEN NULL ELSE CAST(user_id % 3 AS INTEGER) END AS Pedal_cycles,
    CAST(user_id % 4 AS INTEGER) AS Two_wheeled_motor_vehicles,
    CAST(user_id % 50 AS INTEGER) AS Cars_and_taxis,
    CAST(user_id % 7 AS INTEGER) AS Buses_and_coaches,
    CAST(user_id % 9 AS INTEGER) AS LGV_Type,
    CAST(user_id % 8 AS INTEGER) AS HGV_Type,
    CAST(user_id % 5 AS INTEGER) AS EV_Car,
    CASE WHEN event_id % 29 = 0 THEN NULL ELSE CAST(user_id % 2 AS INTEGER) END AS EV_Bike,
    ts AS _event_ts
  FROM events)"""

TRAFFIC_DUP = """traffic_dup AS (
  SELECT * FROM traffic_like
  UNION ALL SELECT * FROM traffic_like WHERE Count_point_id % 20 = 0)"""

ROADS_LIKE = """roads_like AS (
  SELECT
    CASE WHEN o_orderkey % 37 = 0 THEN NULL ELSE CAST(o_orderkey AS INTEGER) END AS Road_ID,
    CASE WHEN o_orderkey % 31 = 0 THEN 8 ELSE CAST(substr(o_orderpriority, 1, 1) AS INTEGER) END
      AS Road_Category_Id,
    CASE WHEN o_orderkey % 23 = 0 THEN 'X'
         ELSE CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'TM' WHEN '2' THEN 'TA' WHEN '3' THEN 'PA'
                   WHEN '4' THEN 'PM' WHEN '5' THEN 'M' END END AS Road_Category,
    CAST(o_custkey % 5 AS INTEGER) AS Region_ID,
    CASE WHEN o_orderkey % 47 = 0 THEN NULL ELSE 'Region ' || CAST(o_custkey % 5 AS VARCHAR) END AS Region_Name,
    CASE WHEN o_orderkey % 29 = 0 THEN -o_totalprice ELSE o_totalprice END AS Total_Link_Length_Km,
    CASE WHEN o_orderkey % 43 = 0 THEN NULL ELSE o_totalprice * CAST(0.625 AS DOUBLE) END
      AS Total_Link_Length_Miles,
    CAST(o_custkey AS DOUBLE) * CAST(1000 AS DOUBLE) AS All_Motor_Vehicles
  FROM orders)"""


def traffic_checked(src: str, name: str = "tc") -> str:
    """Rule flags, bad flag and rule text over a traffic-shaped relation."""
    return f"""{name}_f AS (
  SELECT *,
    Record_ID IS NULL AS f_nn,
    (Count_date IS NOT NULL AND try_strptime(Count_date, '%m/%d/%Y %H:%M') IS NULL) AS f_fmt,
    COALESCE(NOT ("hour" BETWEEN 1 AND 24), false) AS f_hour,
    COALESCE(NOT (Road_Category_ID BETWEEN 1 AND 5), false) AS f_cat
  FROM {src}),
{name} AS (
  SELECT *, (f_nn OR f_fmt OR f_hour OR f_cat) AS bad,
    concat_ws('; ', CASE WHEN f_nn THEN '{L_NN}' END, CASE WHEN f_fmt THEN '{L_FMT}' END,
              CASE WHEN f_hour THEN '{L_HOUR}' END, CASE WHEN f_cat THEN '{L_CAT}' END) AS vr
  FROM {name}_f)"""


def roads_checked(src: str = "roads_like", name: str = "rc") -> str:
    return f"""{name}_f AS (
  SELECT *,
    Road_ID IS NULL AS f_nn,
    COALESCE(Total_Link_Length_Km < 0, false) AS f_len,
    COALESCE(NOT (Road_Category_Id BETWEEN 1 AND 5), false) AS f_cat
  FROM {src}),
{name} AS (
  SELECT *, (f_nn OR f_len OR f_cat) AS bad,
    concat_ws('; ', CASE WHEN f_nn THEN '{L_RNN}' END, CASE WHEN f_len THEN '{L_LEN}' END,
              CASE WHEN f_cat THEN '{L_CAT}' END) AS vr
  FROM {name}_f)"""


def _fill(columns, strings: bool = True, numerics: bool = True) -> str:
    out = []
    for name, dtype in columns:
        kind = type(dtype).__name__
        c = f'"{name}"'
        if strings and kind == "StringType":
            out.append(f"COALESCE({c}, 'Unknown') AS {c}")
        elif numerics and kind in _NUMERIC:
            out.append(f"COALESCE({c}, 0) AS {c}")
        else:
            out.append(c)
    return ", ".join(out)


def traffic_silver(src: str, name: str, distinct: bool = True) -> str:
    """dedup -> null policy -> EV count -> motor count."""
    base = f"SELECT DISTINCT {TP} FROM {src}" if distinct else f"SELECT {TP} FROM {src}"
    return f"""{name}_d AS ({base}),
{name}_n AS (SELECT {_fill(TRAFFIC_COLUMNS)} FROM {name}_d),
{name} AS (
  SELECT *, EV_Car + EV_Bike AS Electrics_Vehicles_Count,
    Two_wheeled_motor_vehicles + Cars_and_taxis + Buses_and_coaches + LGV_Type + HGV_Type + EV_Car + EV_Bike
      AS Motor_Vehicles_Count
  FROM {name}_n)"""


def traffic_gold(src: str, name: str) -> str:
    return f"""{name} AS (
  SELECT *, CAST(Motor_Vehicles_Count AS DOUBLE) / NULLIF(Link_length_km, 0) AS Vehicle_Indensity FROM {src})"""


def roads_silver(src: str, name: str) -> str:
    return f"""{name}_d AS (SELECT DISTINCT {RP} FROM {src}),
{name}_n AS (SELECT {_fill(ROADS_COLUMNS)} FROM {name}_d),
{name}_c AS (
  SELECT *, CASE Road_Category WHEN 'TA' THEN 'Class A Trunk Road' WHEN 'TM' THEN 'Class A Trunk Motor'
    WHEN 'PA' THEN 'Class A Principal Road' WHEN 'PM' THEN 'Class A Principal Motorway'
    WHEN 'M' THEN 'Class B Road' ELSE 'NA' END AS Road_Category_Name
  FROM {name}_n),
{name} AS (
  SELECT *, CASE WHEN Road_Category_Name LIKE '%Class A%' THEN 'Major'
    WHEN Road_Category_Name LIKE '%Class B%' THEN 'Minor' ELSE 'NA' END AS Road_Type
  FROM {name}_c)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _long(src: str, key: str, flags) -> str:
    parts = [
        f"SELECT {key} AS Count_point_id, '{lab.split('] ')[0][1:]}' AS rule_column, "
        f"'{lab.split('] ')[1]}' AS rule, '{lab}' AS label FROM {src} WHERE {flag}"
        for flag, lab in flags
    ]
    return " UNION ALL ".join(parts)


TRAFFIC_FLAGS = [("f_nn", L_NN), ("f_fmt", L_FMT), ("f_hour", L_HOUR), ("f_cat", L_CAT)]
ROADS_FLAGS = [("f_nn", L_RNN), ("f_len", L_LEN), ("f_cat", L_CAT)]

_TC = _with(TRAFFIC_LIKE, traffic_checked("traffic_like"))
_RC = _with(ROADS_LIKE, roads_checked())
_TRC = _with(TRAFFIC_LIKE, ROADS_LIKE, traffic_checked("traffic_like"), roads_checked())
_RECOVERABLE = "f_fmt AND NOT f_nn AND NOT f_hour AND NOT f_cat"


def _gold_good_traffic(dup: bool) -> str:
    src = "traffic_dup" if dup else "traffic_like"
    ctes = [TRAFFIC_LIKE] + ([TRAFFIC_DUP] if dup else [])
    ctes += [
        traffic_checked(src),
        "good AS (SELECT * FROM tc WHERE NOT bad)",
        traffic_silver("good", "ts"),
        traffic_gold("ts", "tg"),
    ]
    return _with(*ctes)


def _region_summary(keys: str) -> str:
    return f"""SELECT {keys}, count(*) AS n_records, CAST(sum(Motor_Vehicles_Count) AS BIGINT) AS total_motor_vehicles,
  round(avg(Vehicle_Indensity), 6) AS avg_intensity, round(sum(Link_length_km), 4) AS total_link_km
FROM tg GROUP BY {keys}"""


def _layer_counts_cte() -> str:
    return _with(
        TRAFFIC_LIKE,
        TRAFFIC_DUP,
        ROADS_LIKE,
        traffic_checked("traffic_dup"),
        roads_checked(),
        f"""counts AS (
  SELECT 'landing_traffic' AS layer, count(*) AS n_rows FROM traffic_dup
  UNION ALL SELECT 'landing_roads', count(*) FROM roads_like
  UNION ALL SELECT 'bronze_traffic', count(*) FROM tc WHERE NOT bad
  UNION ALL SELECT 'bronze_roads', count(*) FROM rc WHERE NOT bad
  UNION ALL SELECT 'quarantine_traffic', count(*) FROM tc WHERE bad
  UNION ALL SELECT 'quarantine_roads', count(*) FROM rc WHERE bad
  UNION ALL SELECT 'silver_traffic', count(*) FROM (SELECT DISTINCT {TP} FROM tc WHERE NOT bad)
  UNION ALL SELECT 'silver_roads', count(*) FROM (SELECT DISTINCT {RP} FROM rc WHERE NOT bad)
  UNION ALL SELECT 'gold_traffic', count(*) FROM (SELECT DISTINCT {TP} FROM tc WHERE NOT bad)
  UNION ALL SELECT 'gold_roads', count(*) FROM (SELECT DISTINCT {RP} FROM rc WHERE NOT bad)
  UNION ALL SELECT 'gold_traffic_roads', count(*) FROM (SELECT DISTINCT {TP} FROM tc WHERE NOT bad)
  UNION ALL SELECT 'gold_region_summary', count(*) FROM (
    SELECT DISTINCT COALESCE(Region_id, 0), COALESCE(Road_Category_ID, 0)
    FROM (SELECT DISTINCT {TP} FROM tc WHERE NOT bad)))""",
    )


def _count(layer: str) -> str:
    return f"(SELECT n_rows FROM counts WHERE layer = '{layer}')"


def _firsts(src: str, columns: str) -> str:
    """Distinct good records, as those that are the first of their like."""
    return (
        f"(SELECT count(*) FROM (SELECT row_number() OVER (PARTITION BY {columns}) AS k FROM {src} WHERE NOT bad) WHERE k = 1)"
    )


def _grouped(src: str, columns: str) -> str:
    return f"(SELECT count(*) FROM (SELECT 1 FROM {src} WHERE NOT bad GROUP BY {columns}))"


def _reconcile_sql() -> str:
    checks = [
        ("traffic_landing_split", _count("landing_traffic"), f"{_count('bronze_traffic')} + {_count('quarantine_traffic')}"),
        ("roads_landing_split", _count("landing_roads"), f"{_count('bronze_roads')} + {_count('quarantine_roads')}"),
        # The two sides are counted in different ways, so a wrong side shows.
        ("traffic_silver_distinct", _count("silver_traffic"), _firsts("tc", TP)),
        ("roads_silver_distinct", _count("silver_roads"), _firsts("rc", RP)),
        ("traffic_gold_silver", _firsts("tc", TP), _grouped("tc", TP)),
        ("roads_gold_silver", _firsts("rc", RP), _grouped("rc", RP)),
        ("traffic_roads_join_rows", _grouped("tc", TP), _firsts("tc", TP)),
    ]
    rows = " UNION ALL ".join(
        f"SELECT '{name}' AS \"check\", CAST({lhs} AS BIGINT) AS lhs, CAST({rhs} AS BIGINT) AS rhs, "
        f"({lhs}) = ({rhs}) AS ok"
        for name, lhs, rhs in checks
    )
    return _layer_counts_cte() + rows


def _summary_sql() -> str:
    return _TRC + """SELECT 'raw_traffic' AS table_name, count(*) AS n_input, count(*) FILTER (WHERE NOT bad) AS n_good,
  count(*) FILTER (WHERE bad) AS n_quarantined FROM tc
UNION ALL SELECT 'raw_roads', count(*), count(*) FILTER (WHERE NOT bad), count(*) FILTER (WHERE bad) FROM rc"""


def _rule_counts(table: str, src: str, flags) -> str:
    rows = [f"SELECT '{table}' AS table_name, '{L_TABLE}' AS rule, CAST(0 AS BIGINT) AS n_failed, true AS success"]
    rows += [
        f"SELECT '{table}', '{lab}', CAST(count(*) FILTER (WHERE {flag}) AS BIGINT), "
        f"count(*) FILTER (WHERE {flag}) = 0 FROM {src}"
        for flag, lab in flags
    ]
    return " UNION ALL ".join(rows)


def _long_regroup() -> str:
    return _TC.rstrip() + f""",
lg AS ({_long('tc', 'Count_point_id', TRAFFIC_FLAGS)}),
rg AS (SELECT Count_point_id, string_agg(label, '; ' ORDER BY label) AS violated_rules FROM lg GROUP BY Count_point_id)
"""


def _quarantine_sql() -> str:
    return _TRC + """SELECT 'raw_traffic' AS table_name, '0' AS gx_batch_id, vr AS violated_rules, Count_point_id AS row_key,
  true AS has_ingestion_time FROM tc WHERE bad
UNION ALL SELECT 'raw_roads', '0', vr, Road_ID, true FROM rc WHERE bad"""


def _quarantine_by_rule_sql() -> str:
    t = " UNION ALL ".join(f"SELECT 'raw_traffic' AS table_name, '{lab}' AS rule FROM tc WHERE {f}" for f, lab in TRAFFIC_FLAGS)
    r = " UNION ALL ".join(f"SELECT 'raw_roads', '{lab}' FROM rc WHERE {f}" for f, lab in ROADS_FLAGS)
    return _TRC + (
        f"SELECT table_name, '0' AS gx_batch_id, rule, count(*) AS n_rows FROM ({t} UNION ALL {r}) "
        "GROUP BY table_name, rule"
    )


def _recovered_sql() -> str:
    cols = ", ".join(
        "strftime(_event_ts, '%-m/%-d/%Y %-H:%M') AS Count_date" if c == "Count_date" else f'"{c}"'
        for c in TRAFFIC_PAYLOAD
    )
    return _TC + f"SELECT {cols} FROM tc WHERE {_RECOVERABLE}"


def _fill_sql(strings: bool, numerics: bool) -> str:
    return _with(TRAFFIC_LIKE) + f"SELECT {_fill(TRAFFIC_COLUMNS, strings, numerics)} FROM traffic_like"


def _silver_plain() -> str:
    return _with(TRAFFIC_LIKE, traffic_silver("traffic_like", "ts", distinct=False))


def _roads_named() -> str:
    return _with(
        ROADS_LIKE,
        f"rn AS (SELECT {_fill(ROADS_COLUMNS)} FROM roads_like)",
        """rc AS (SELECT *, CASE Road_Category WHEN 'TA' THEN 'Class A Trunk Road' WHEN 'TM' THEN 'Class A Trunk Motor'
    WHEN 'PA' THEN 'Class A Principal Road' WHEN 'PM' THEN 'Class A Principal Motorway'
    WHEN 'M' THEN 'Class B Road' ELSE 'NA' END AS Road_Category_Name FROM rn)""",
    )


def _bronze_union_sql() -> str:
    return _TRC + """SELECT 'bronze' AS layer, 'raw_traffic' AS table_name, CAST(NULL AS VARCHAR) AS violated_rules,
  Count_point_id AS row_key FROM tc WHERE NOT bad
UNION ALL SELECT 'bronze', 'raw_roads', NULL, Road_ID FROM rc WHERE NOT bad
UNION ALL SELECT 'quarantine', 'raw_traffic', vr, Count_point_id FROM tc WHERE bad
UNION ALL SELECT 'quarantine', 'raw_roads', vr, Road_ID FROM rc WHERE bad"""


ORACLE = {
    "csv_schema_on_read": _with(ROADS_LIKE)
    + """SELECT Road_ID, CASE WHEN Road_ID % 53 = 0 THEN NULL ELSE Road_Category_Id END AS Road_Category_Id,
  Road_Category, Region_ID, Region_Name, Total_Link_Length_Km, Total_Link_Length_Miles, All_Motor_Vehicles
FROM roads_like""",
    "rule_not_null": _with(TRAFFIC_LIKE)
    + "SELECT Count_point_id, Record_ID, Record_ID IS NULL AS failed FROM traffic_like",
    "rule_between": _with(TRAFFIC_LIKE)
    + """SELECT Count_point_id, "hour", Road_Category_ID,
  COALESCE(NOT ("hour" BETWEEN 1 AND 24), false) AS hour_failed,
  COALESCE(NOT (Road_Category_ID BETWEEN 1 AND 5), false) AS category_failed
FROM traffic_like""",
    "rule_min_only": _with(ROADS_LIKE)
    + "SELECT Road_ID, Total_Link_Length_Km, COALESCE(Total_Link_Length_Km < 0, false) AS failed FROM roads_like",
    "rule_strftime": _with(
        TRAFFIC_LIKE,
        """dated AS (SELECT *, lpad(CAST(Count_point_id % 12 + 1 AS VARCHAR), 2, '0') || '/'
    || lpad(CAST(Count_point_id % 31 + 1 AS VARCHAR), 2, '0') AS month_day,
  lpad(CAST(Count_point_id % 100 AS VARCHAR), 2, '0') AS yy FROM traffic_like)""",
    )
    + """SELECT Count_point_id, Count_date, month_day || '/' || yy AS short_date, month_day,
  (Count_date IS NOT NULL AND try_strptime(Count_date, '%m/%d/%Y %H:%M') IS NULL) AS failed,
  try_strptime(month_day || '/' || CASE WHEN yy >= '69' THEN '19' ELSE '20' END || yy, '%m/%d/%Y') IS NULL AS short_failed,
  try_strptime(month_day || '/1900', '%m/%d/%Y') IS NULL AS month_day_failed
FROM dated""",
    "rule_max_length": _with(TRAFFIC_LIKE)
    + """SELECT Count_point_id, Local_authority_name, length(Local_authority_name) > 11 AS failed FROM traffic_like""",
    "rule_column_set": """SELECT 'raw_traffic' AS table_name, count(*) AS n_rows, true AS success, '' AS missing,
  '' AS unexpected FROM events
UNION ALL SELECT 'raw_traffic_extra_column', count(*), false, '', 'Unexpected' FROM events
UNION ALL SELECT 'raw_roads', count(*), true, '', '' FROM orders
UNION ALL SELECT 'raw_roads_missing_column', count(*), false, 'All_Motor_Vehicles', '' FROM orders""",
    "rule_header_match": _with(ROADS_LIKE)
    + """SELECT Region_ID, Region_ID NOT IN (2, 4) AS header_ok,
  count(*) - CASE WHEN Region_ID = 2 THEN 1 ELSE 0 END AS n_rows FROM roads_like GROUP BY Region_ID""",
    "validate_suite": _TC + "SELECT Count_point_id, NULLIF(vr, '') AS violated_rules, NOT bad AS is_valid FROM tc",
    "rule_failure_counts": _TRC
    + _rule_counts("raw_traffic", "tc", TRAFFIC_FLAGS)
    + " UNION ALL "
    + _rule_counts("raw_roads", "rc", ROADS_FLAGS),
    "violations_long": _TC + _long("tc", "Count_point_id", TRAFFIC_FLAGS),
    "violations_regroup": _long_regroup() + "SELECT Count_point_id, violated_rules FROM rg",
    "violations_join_back": _long_regroup()
    + """SELECT t.Count_point_id, t.Record_ID, t.Count_date, t."hour", t.Road_Category_ID, rg.violated_rules
FROM tc t LEFT JOIN rg ON t.Count_point_id = rg.Count_point_id""",
    "split_valid": _TC + f"SELECT {TP} FROM tc WHERE NOT bad",
    "quarantine_rows": _quarantine_sql(),
    "quarantine_table_level": _with(TRAFFIC_LIKE)
    + """SELECT 'raw_traffic' AS table_name, '0' AS gx_batch_id, 'Table-level Schema/Count Error' AS violated_rules,
  Count_point_id AS row_key, true AS has_ingestion_time FROM traffic_like""",
    "quarantine_summary": _summary_sql(),
    "quarantine_by_rule": _quarantine_by_rule_sql(),
    "validate_fail_open": _with(TRAFFIC_LIKE) + "SELECT Count_point_id, Record_ID, Count_date FROM traffic_like",
    "empty_batch_skip": _TC.rstrip()
    + """,
s AS (SELECT Region_id AS batch_id, count(*) AS n_total, count(*) FILTER (WHERE NOT bad) AS n_good,
  count(*) FILTER (WHERE bad) AS n_bad FROM tc GROUP BY Region_id),
b AS (SELECT CAST(range AS INTEGER) AS batch_id FROM range(6))
SELECT b.batch_id, COALESCE(s.n_total, 0) = 0 AS skipped, CAST(COALESCE(s.n_good, 0) AS BIGINT) AS n_bronze,
  CAST(COALESCE(s.n_bad, 0) AS BIGINT) AS n_quarantined
FROM b LEFT JOIN s ON b.batch_id = s.batch_id""",
    "recover_quarantine": _recovered_sql(),
    "purge_quarantine": _TC
    + f"""SELECT 'raw_traffic' AS table_name, '0' AS gx_batch_id, vr AS violated_rules, Count_point_id AS row_key
FROM tc WHERE bad AND NOT ({_RECOVERABLE})""",
    "recover_twice": _TC.rstrip()
    + f""",
left_over AS (SELECT * FROM tc WHERE bad AND NOT ({_RECOVERABLE}) AND NOT (f_hour AND NOT f_nn AND NOT f_fmt AND NOT f_cat))
SELECT 'landing' AS layer, count(*) AS n_rows FROM traffic_like
UNION ALL SELECT 'bronze', (SELECT count(*) FROM traffic_like) - (SELECT count(*) FROM left_over)
UNION ALL SELECT 'quarantine', count(*) FROM left_over""",
    "recover_without_purge": _TC.rstrip()
    + f""",
brought AS (SELECT * FROM tc WHERE {_RECOVERABLE})
SELECT 'landing' AS layer, count(*) AS n_rows FROM traffic_like
UNION ALL SELECT 'bronze', (SELECT count(*) FROM tc WHERE NOT bad) + (SELECT count(*) FROM brought)
UNION ALL SELECT 'quarantine', count(*) FROM tc WHERE bad
UNION ALL SELECT 'recovered', count(*) FROM brought""",
    "stream_recover_chain": _TC.rstrip()
    + f""",
kept AS (
  SELECT * FROM tc WHERE NOT bad
  UNION ALL SELECT * REPLACE (strftime(_event_ts, '%-m/%-d/%Y %-H:%M') AS Count_date) FROM tc WHERE {_RECOVERABLE}),
{traffic_silver("kept", "ts")}
SELECT Count_point_id, Count_date, Motor_Vehicles_Count FROM ts""",
    "schema_evolution_stream": _TC
    + "SELECT Count_point_id, CASE WHEN Region_id >= 3 THEN 'S' || CAST(Region_id AS VARCHAR) END AS Survey FROM tc WHERE NOT bad",
    "schema_evolution_append": _with(TRAFFIC_LIKE)
    + """SELECT Count_point_id, CASE WHEN Region_id < 3 THEN 1 ELSE 2 END AS batch_id,
  CASE WHEN Region_id < 3 THEN NULL
       ELSE Two_wheeled_motor_vehicles + Cars_and_taxis + Buses_and_coaches + LGV_Type + HGV_Type + EV_Car + EV_Bike
  END AS Motor_Vehicles_Count
FROM traffic_like""",
    "dedup_full_row": _with(TRAFFIC_LIKE, TRAFFIC_DUP) + f"SELECT DISTINCT {TP} FROM traffic_dup",
    "dedup_by_key": """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
  l_tax, l_returnflag, l_linestatus, l_shipdate
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                 l_returnflag, l_linestatus) AS rn
      FROM lineitem) WHERE rn = 1""",
    "null_fill_strings": _fill_sql(True, False),
    "null_fill_numerics": _fill_sql(False, True),
    "null_policy": _fill_sql(True, True),
    "derived_ev_count": _silver_plain() + "SELECT Count_point_id, EV_Car, EV_Bike, Electrics_Vehicles_Count FROM ts",
    "derived_motor_count": _silver_plain()
    + "SELECT Count_point_id, Electrics_Vehicles_Count, Motor_Vehicles_Count FROM ts",
    "audit_columns": _with(TRAFFIC_LIKE)
    + """SELECT Count_point_id, true AS has_extract_time, true AS has_transformed_time, true AS has_loading_time
FROM traffic_like""",
    "map_category_name": _roads_named() + "SELECT Road_ID, Road_Category, Road_Category_Name FROM rc",
    "classify_road_type": _roads_named()
    + """SELECT Road_ID, Road_Category_Name, CASE WHEN Road_Category_Name LIKE '%Class A%' THEN 'Major'
  WHEN Road_Category_Name LIKE '%Class B%' THEN 'Minor' ELSE 'NA' END AS Road_Type FROM rc""",
    "vehicle_intensity": _silver_plain()
    + """SELECT Count_point_id, Motor_Vehicles_Count, Link_length_km,
  CAST(Motor_Vehicles_Count AS DOUBLE) / NULLIF(Link_length_km, 0) AS Vehicle_Indensity FROM ts""",
    "gold_roads_passthrough": _with(ROADS_LIKE, roads_checked(), "rg AS (SELECT * FROM rc WHERE NOT bad)", roads_silver("rg", "rs"))
    + f"SELECT {RP}, Road_Category_Name, Road_Type FROM rs",
    "gold_traffic_roads_join": _with(
        TRAFFIC_LIKE,
        ROADS_LIKE,
        traffic_checked("traffic_like"),
        "good AS (SELECT * FROM tc WHERE NOT bad)",
        traffic_silver("good", "ts"),
        roads_checked(),
        "rgood AS (SELECT * FROM rc WHERE NOT bad)",
        roads_silver("rgood", "rs"),
        """ra AS (SELECT Region_ID, Road_Category_Id, count(*) AS n_roads,
  avg(Total_Link_Length_Km) AS link_avg, sum(Total_Link_Length_Km) AS link_sum, sum(All_Motor_Vehicles) AS road_vehicles_sum FROM rs
  GROUP BY Region_ID, Road_Category_Id)""",
    )
    + """SELECT t.Count_point_id, t.Region_id, t.Road_Category_ID, t.Motor_Vehicles_Count, ra.n_roads,
  round(ra.link_avg, 4) AS road_link_km_avg, round(ra.link_sum, 2) AS road_link_km_sum, ra.road_vehicles_sum
FROM ts t LEFT JOIN ra ON t.Region_id = ra.Region_ID AND t.Road_Category_ID = ra.Road_Category_Id""",
    "gold_region_summary": _gold_good_traffic(False) + _region_summary("Region_id, Road_Category_ID"),
    "traffic_region_report": _gold_good_traffic(True) + _region_summary("Region_id"),
    "monitor_layer_counts": _layer_counts_cte() + "SELECT layer, n_rows FROM counts",
    "monitor_reconcile": _reconcile_sql(),
    "monitor_quality_rate": _with(
        TRAFFIC_LIKE, ROADS_LIKE, traffic_checked("traffic_like"), roads_checked(),
        """s AS (SELECT 'raw_traffic' AS table_name, count(*) AS n_input, count(*) FILTER (WHERE NOT bad) AS n_good,
  count(*) FILTER (WHERE bad) AS n_quarantined FROM tc
  UNION ALL SELECT 'raw_roads', count(*), count(*) FILTER (WHERE NOT bad), count(*) FILTER (WHERE bad) FROM rc)""",
    )
    + """SELECT table_name, n_input, n_quarantined,
  round(CAST(n_good AS DOUBLE) / CAST(n_input AS DOUBLE), 6) AS pass_rate FROM s""",
    "monitor_batch_quality": _TRC
    + """SELECT table_name, '0' AS batch_id, n_input, n_good, n_quarantined,
  round(CAST(n_good AS DOUBLE) / CAST(n_input AS DOUBLE), 6) AS pass_rate
FROM (SELECT 'raw_traffic' AS table_name, count(*) AS n_input, count(*) FILTER (WHERE NOT bad) AS n_good,
        count(*) FILTER (WHERE bad) AS n_quarantined FROM tc
      UNION ALL SELECT 'raw_roads', count(*), count(*) FILTER (WHERE NOT bad), count(*) FILTER (WHERE bad) FROM rc)""",
    "stream_file_ingest": _with(TRAFFIC_LIKE) + f"SELECT {TP}, true AS has_extract_time FROM traffic_like",
    "stream_incremental": _with(TRAFFIC_LIKE)
    + """SELECT 1 AS run, count(*) AS n_new_rows FROM traffic_like WHERE Region_id < 3
UNION ALL SELECT 2, CAST(0 AS BIGINT)
UNION ALL SELECT 3, count(*) FROM traffic_like WHERE Region_id >= 3""",
    "stream_dedup": _with(TRAFFIC_LIKE) + f"SELECT DISTINCT {TP} FROM traffic_like",
    "stream_table_chain": _gold_good_traffic(True)
    + f"""SELECT {TP}, Electrics_Vehicles_Count, Motor_Vehicles_Count, Vehicle_Indensity,
  true AS has_extract_time, true AS has_transformed_time, true AS has_loading_time FROM tg""",
    "stream_validate_quarantine": _bronze_union_sql(),
}
# The same rows whether the roads came at once or in two waves.
ORACLE["gold_region_incremental"] = _gold_good_traffic(True) + _region_summary("Region_id, Road_Category_ID")
ORACLE["monitor_observed_counts"] = (
    _layer_counts_cte()
    + """SELECT CASE layer WHEN 'bronze_traffic' THEN 'raw_traffic' WHEN 'bronze_roads' THEN 'raw_roads'
    WHEN 'quarantine_traffic' THEN 'raw_traffic_quarantine' WHEN 'quarantine_roads' THEN 'raw_roads_quarantine' ELSE layer END AS layer,
  CAST(n_rows AS BIGINT) AS n_rows
FROM counts WHERE layer NOT LIKE 'landing%' AND layer NOT IN ('gold_traffic_roads', 'gold_region_summary')"""
)
ORACLE["stream_two_feeds"] = (
    _layer_counts_cte() + "SELECT layer, n_rows FROM counts WHERE layer LIKE 'bronze%' OR layer LIKE 'quarantine%'"
)
ORACLE["publish_after_failure"] = (
    _TC.rstrip()
    + """,
steps(step, n) AS (VALUES ('first batch', 2), ('failed batch', 2), ('retried batch', 5))
SELECT step, 'bronze' AS layer, count(*) AS n_rows FROM steps JOIN tc ON Region_id < n AND NOT bad GROUP BY step
UNION ALL SELECT step, 'quarantine', count(*) FROM steps JOIN tc ON Region_id < n AND bad GROUP BY step"""
)
ORACLE["purge_by_tombstone"] = (
    f"SELECT * FROM ({ORACLE['purge_quarantine']}) CROSS JOIN (VALUES ('marked'), ('compacted')) AS s(state)"
)
ORACLE["stream_archive_source"] = (
    _with(TRAFFIC_LIKE)
    + "SELECT layer, count(*) AS n_rows FROM traffic_like CROSS JOIN (VALUES ('landed'), ('written'), ('landing and archive')) AS l(layer) GROUP BY layer"
)
ORACLE["batch_recover_chain"] = ORACLE["stream_recover_chain"]
ORACLE["dedup_batch_history"] = (
    _with(TRAFFIC_LIKE, TRAFFIC_DUP, traffic_checked("traffic_dup"), "good AS (SELECT * FROM tc WHERE NOT bad)", traffic_silver("good", "ts"))
    + f"SELECT {TP}, Motor_Vehicles_Count FROM ts"
)
ORACLE["stream_traffic_roads_join"] = ORACLE["gold_traffic_roads_join"]
