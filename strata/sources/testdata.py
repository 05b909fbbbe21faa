"""Feeds derived from the benchmark tables.

The benchmark parquet tables are clean; these functions derive traffic- and
roads-shaped feeds from them with deterministic dirt (NULL ids, bad dates,
out-of-range codes, NULL cells, repeats), so the rules and the cleaning
have something to catch.  The same expressions are written in SQL for the
DuckDB oracle (``strata.queries.oracle``).  Every row of the source table
becomes one feed row, so the work grows with the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.schemas import ROADS_COLUMNS, TRAFFIC_COLUMNS

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _every(col: str, k: int) -> Column:
    return F.col(col) % k == 0


def _int(c: Column) -> Column:
    return c.cast("int")


def _text(prefix: str, c: Column) -> Column:
    return F.concat(F.lit(prefix), c.cast("string"))


def traffic_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A traffic feed, one row per ``events`` row.

    Dirt: Record_ID NULL every 97th event; Count_date day-first every 7th
    (a format error when the day is above 12); hour 0 breaks the 1-24 range;
    Road_Category_ID in 0-5 and NULL every 11th; link length 0 every 13th
    and NULL every 17th; NULL strings every 19th / 37th; NULL counts every
    23rd / 29th.
    """
    ev = load(spark, sf_dir, "events")
    eid, uid, ts = F.col("event_id"), F.col("user_id"), F.col("ts")
    null = F.lit(None)
    cols = {
        "Record_ID": F.when(_every("event_id", 97), null.cast("int")).otherwise(_int(eid)),
        "Count_point_id": _int(eid),
        "Direction_of_travel": F.when(_every("event_id", 19), null.cast("string")).otherwise(F.col("event_type")),
        "Year": _int(F.year(ts)),
        "Count_date": F.when(_every("event_id", 7), F.date_format(ts, "dd/MM/yyyy HH:mm")).otherwise(
            F.date_format(ts, "M/d/yyyy H:mm")
        ),
        "hour": _int(F.hour(ts)),
        "Region_id": _int(uid % 5),
        "Region_name": _text("Region ", uid % 5),
        "Local_authority_name": _text("Authority ", uid % 11),
        "Road_name": _text("R", uid % 13),
        "Road_Category_ID": F.when(_every("event_id", 11), null.cast("int")).otherwise(_int(eid % 6)),
        "Start_junction_road_name": _text("J", eid % 31),
        "End_junction_road_name": F.when(_every("event_id", 37), null.cast("string")).otherwise(
            _text("J", eid % 41)
        ),
        "Latitude": uid.cast("double") / F.lit(4.0),
        "Longitude": F.col("value") * F.lit(-1.0),
        "Link_length_km": F.when(_every("event_id", 17), null.cast("double"))
        .when(_every("event_id", 13), F.lit(0.0))
        .otherwise(F.col("value")),
        "Pedal_cycles": F.when(_every("event_id", 23), null.cast("int")).otherwise(_int(uid % 3)),
        "Two_wheeled_motor_vehicles": _int(uid % 4),
        "Cars_and_taxis": _int(uid % 50),
        "Buses_and_coaches": _int(uid % 7),
        "LGV_Type": _int(uid % 9),
        "HGV_Type": _int(uid % 8),
        "EV_Car": _int(uid % 5),
        "EV_Bike": F.when(_every("event_id", 29), null.cast("int")).otherwise(_int(uid % 2)),
    }
    return ev.select(*[cols[name].alias(name) for name, _ in TRAFFIC_COLUMNS])


def traffic_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``traffic_like`` plus a second delivery of every 20th record."""
    base = traffic_like(spark, sf_dir)
    return base.unionByName(base.filter(F.col("Count_point_id") % 20 == 0))


# Road category code per priority digit 1-5.
ROAD_CODE_BY_PRIORITY = {"1": "TM", "2": "TA", "3": "PA", "4": "PM", "5": "M"}


def roads_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A roads feed, one row per ``orders`` row.

    Road_ID NULL every 37th order; category id 8 every 31st; code 'X' every
    23rd; negative link length every 29th; NULL miles every 43rd and NULL
    region name every 47th.
    """
    od = load(spark, sf_dir, "orders")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    digit = F.substring(F.col("o_orderpriority"), 1, 1)
    code = F.create_map(*[F.lit(x) for kv in ROAD_CODE_BY_PRIORITY.items() for x in kv])
    null = F.lit(None)
    cols = {
        "Road_ID": F.when(_every("o_orderkey", 37), null.cast("int")).otherwise(_int(key)),
        "Road_Category_Id": F.when(_every("o_orderkey", 31), F.lit(8)).otherwise(_int(digit)),
        "Road_Category": F.when(_every("o_orderkey", 23), F.lit("X")).otherwise(F.element_at(code, digit)),
        "Region_ID": _int(cust % 5),
        "Region_Name": F.when(_every("o_orderkey", 47), null.cast("string")).otherwise(_text("Region ", cust % 5)),
        "Total_Link_Length_Km": F.when(_every("o_orderkey", 29), -F.col("o_totalprice")).otherwise(
            F.col("o_totalprice")
        ),
        "Total_Link_Length_Miles": F.when(_every("o_orderkey", 43), null.cast("double")).otherwise(
            F.col("o_totalprice") * F.lit(0.625)
        ),
        "All_Motor_Vehicles": cust.cast("double") * F.lit(1000.0),
    }
    return od.select(*[cols[name].alias(name) for name, _ in ROADS_COLUMNS])
