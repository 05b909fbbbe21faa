from __future__ import annotations

import datetime as dt

import pandas as pd
from strata.operators import clean, enrich, monitor
from strata.plans import gold, roads, traffic
from strata.sources.testdata import load

from .conftest import SF_SMALL


def test_dedup_ignores_audit_columns(spark):
    df = spark.createDataFrame(
        [(1, "a", dt.datetime(2024, 1, 1)), (1, "a", dt.datetime(2024, 1, 2)), (2, "b", dt.datetime(2024, 1, 1))],
        "k int, v string, Extract_Time timestamp",
    )
    assert clean.dedup_full_row(df).count() == 2


def test_dedup_by_key_matches_brute_force(spark):
    li = load(spark, SF_SMALL, "lineitem")
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
             "l_returnflag", "l_linestatus"]
    got = clean.dedup_by_key(li, ["l_orderkey", "l_linenumber"], order).toPandas()
    pdf = li.toPandas()
    want = pdf.sort_values(["l_orderkey", "l_linenumber", *order]).groupby(["l_orderkey", "l_linenumber"]).head(1)
    cols = list(pdf.columns)
    a = got[cols].sort_values(cols).reset_index(drop=True)
    b = want[cols].sort_values(cols).reset_index(drop=True)
    pd.testing.assert_frame_equal(a, b, check_dtype=False)


def test_dedup_by_key_hot_key(spark):
    # One key holds a third of all rows; the partial aggregate reduces it per task.
    rows = [(0, i) for i in range(3000)] + [(k, k) for k in range(1, 6001)]
    df = spark.createDataFrame(rows, "k int, v int").repartition(8)
    out = {r.k: r.v for r in clean.dedup_by_key(df, ["k"], ["v"], keep="last").collect()}
    assert out[0] == 2999 and len(out) == 6001


def test_null_policy_types_and_timestamps(spark):
    df = spark.createDataFrame([(None, None, None, None)], "s string, i int, d double, t timestamp")
    out = clean.null_policy(df)
    assert [f.dataType.simpleString() for f in out.schema] == ["string", "int", "double", "timestamp"]
    row = out.first()
    assert (row.s, row.i, row.d, row.t) == ("Unknown", 0, 0.0, None)


def test_sum_overflow_gives_null(spark):
    df = spark.createDataFrame([(2**31 - 1, 1), (1, 2)], "a int, b int")
    assert [r.s for r in enrich.sum_columns(df, "s", ["a", "b"]).collect()] == [None, 3]


def test_ratio_zero_and_null(spark):
    df = spark.createDataFrame([(10, 4.0), (10, 0.0), (10, None)], "m int, l double")
    assert [r.x for r in enrich.ratio(df, "x", "m", "l").collect()] == [2.5, None, None]


def test_category_mapping_and_type(spark):
    df = spark.createDataFrame([("TA",), ("M",), ("X",), (None,)], "Road_Category string")
    out = roads.road_type(roads.category_name(df)).collect()
    assert [(r.Road_Category_Name, r.Road_Type) for r in out] == [
        ("Class A Trunk Road", "Major"),
        ("Class B Road", "Minor"),
        ("NA", "NA"),
        ("NA", "NA"),
    ]


def test_motor_count_excludes_pedal_cycles(spark):
    cols = ["Pedal_cycles", *traffic.MOTOR_CLASSES, "EV_Car", "EV_Bike"]
    df = spark.createDataFrame([tuple(range(1, len(cols) + 1))], ", ".join(f"{c} int" for c in cols))
    row = traffic.motor_count(traffic.ev_count(df)).first()
    assert row.Electrics_Vehicles_Count == 7 + 8
    assert row.Motor_Vehicles_Count == 2 + 3 + 4 + 5 + 6 + 15


def test_gold_join_does_not_multiply_facts(spark):
    facts = spark.createDataFrame([(1, 1, 1, 10), (2, 1, 2, 20)], "id int, Region_id int, Road_Category_ID int, Motor_Vehicles_Count int")
    dims = spark.createDataFrame(
        [(1, 1, 5.0, 100.0), (1, 1, 7.0, 50.0), (1, 1, 9.0, 10.0)],
        "Region_ID int, Road_Category_Id int, Total_Link_Length_Km double, All_Motor_Vehicles double",
    )
    out = {r.id: r for r in gold.traffic_roads_join(facts, dims).collect()}
    assert len(out) == 2
    assert out[1].n_roads == 3 and out[1].road_link_km_avg == 7.0 and out[1].road_vehicles_sum == 160.0
    assert out[2].n_roads is None


def test_reconcile(spark):
    counts = spark.createDataFrame([("a", 5), ("b", 3), ("c", 2)], "layer string, n_rows long")
    out = {r.check: r.ok for r in monitor.reconcile(counts, {"x": (["a"], ["b", "c"]), "y": (["a"], ["b"])}).collect()}
    assert out == {"x": True, "y": False}


def test_region_summary(spark):
    df = spark.createDataFrame(
        [(1, 1, 10, 2.0, 5.0), (1, 1, 20, None, 0.0)],
        "Region_id int, Road_Category_ID int, Motor_Vehicles_Count int, Vehicle_Indensity double, Link_length_km double",
    )
    row = gold.region_summary(df).first()
    assert (row.n_records, row.total_motor_vehicles, row.avg_intensity, row.total_link_km) == (2, 30, 2.0, 5.0)


def test_gold_join_without_broadcast_and_without_jobs(spark):
    # hot key: a third of the facts share one (region, category)
    facts = spark.createDataFrame(
        [(i, 1 if i % 3 == 0 else i % 7, 3 if i % 3 == 0 else i % 5, i % 11) for i in range(3000)],
        "id int, Region_id int, Road_Category_ID int, Motor_Vehicles_Count int",
    )
    dims = spark.createDataFrame(
        [(k % 7, k % 5, float(k), float(k * 10)) for k in range(200)],
        "Region_ID int, Road_Category_Id int, Total_Link_Length_Km double, All_Motor_Vehicles double",
    )
    key = ["id", "n_roads", "road_link_km_sum", "road_vehicles_sum"]
    results = []
    for limit in ("10m", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        spark.sparkContext.setJobGroup("plan-only", "no job may run while the join is planned")
        joined = gold.traffic_roads_join(facts, dims)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("plan-only")
        spark.sparkContext.setJobGroup("run", "")
        results.append(sorted(joined.select(*key).collect()))
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert results[0] == results[1] and len(results[0]) == 3000


def test_payload_digest_is_one_for_equal_records(spark):
    rows = [(1, 0.0, None, "a"), (1, -0.0, None, "a"), (1, 0.0, "", "a"), (1, 0.0, None, "b"), (None, 0.0, None, "a"), (1, None, None, "a")]
    df = spark.createDataFrame(rows, "i int, d double, s string, t string")
    got = [bytes(r.k) for r in df.select(clean.payload_digest(df).alias("k")).collect()]
    assert got[0] == got[1] and len(set(got)) == 5
