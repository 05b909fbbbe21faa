from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators import quality
from strata.operators.rules import TABLE_LEVEL_ERROR, Between, ColumnSet, NotNull, Suite
from strata.plans import roads, traffic

ROWS = [
    (1, 5, 10.0, "a"),
    (None, 5, 10.0, "b"),  # not null
    (3, 0, 10.0, "c"),  # range low
    (4, 6, -1.0, "d"),  # range high + min-only
    (5, None, None, "e"),  # NULLs pass range rules
    (None, 9, -5.0, "f"),  # three rules
]
SCHEMA = "id int, cat int, length double, name string"
SUITE = Suite(
    "t",
    (
        ColumnSet(("id", "cat", "length", "name")),
        NotNull("id"),
        Between("cat", min_value=1, max_value=5),
        Between("length", min_value=0),
    ),
)


def _df(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_row_rules_are_null_safe(spark):
    df = _df(spark).select("name", *[r.failed().alias(f"r{i}") for i, r in enumerate(SUITE.row_rules)])
    got = {r.name: (r.r0, r.r1, r.r2) for r in df.collect()}
    assert got == {
        "a": (False, False, False),
        "b": (True, False, False),
        "c": (False, True, False),
        "d": (False, True, True),
        "e": (False, False, False),
        "f": (True, True, True),
    }


def test_labels_follow_suite_order(spark):
    ann = quality.annotate(_df(spark), SUITE)
    got = {r.name: r.v for r in ann.select("name", quality.violated_rules_text().alias("v")).collect()}
    assert got["f"] == (
        "[id] expect_column_values_to_not_be_null; [cat] expect_column_values_to_be_between; "
        "[length] expect_column_values_to_be_between"
    )
    assert got["a"] == ""


def test_split_conserves_rows(spark):
    ann = quality.annotate(_df(spark), SUITE)
    good, bad = quality.split(ann)
    assert good.count() + bad.count() == len(ROWS)
    assert sorted(r.name for r in good.collect()) == ["a", "e"]
    assert quality.VIOLATIONS not in good.columns


def test_column_set_rule():
    rule = ColumnSet(("a", "b"))
    assert rule.check(["b", "a"])["success"]
    assert rule.check(["a"]) == {"success": False, "missing": ["b"], "unexpected": []}
    assert rule.check(["a", "b", "c"])["unexpected"] == ["c"]
    assert ColumnSet(("a",), exact_match=False).check(["a", "z"])["success"]


def test_rule_failure_counts(spark):
    out = {r.rule: (r.n_failed, r.success) for r in quality.rule_failure_counts(_df(spark), SUITE).collect()}
    assert out["[id] expect_column_values_to_not_be_null"] == (2, False)
    assert out["[cat] expect_column_values_to_be_between"] == (3, False)
    assert out["[length] expect_column_values_to_be_between"] == (2, False)
    assert out["[Table] expect_table_columns_to_match_set"] == (0, True)


def test_long_and_regroup_roundtrip(spark):
    ann = quality.annotate(_df(spark), SUITE)
    long = quality.violations_long(ann, ["name"])
    assert long.count() == 7
    cols = {r.rule_column for r in long.collect()}
    assert cols == {"id", "cat", "length"}
    regroup = {r.name: r.violated_rules for r in quality.violations_regroup(long, ["name"]).collect()}
    assert set(regroup) == {"b", "c", "d", "f"}
    assert regroup["d"] == "; ".join(
        sorted(["[cat] expect_column_values_to_be_between", "[length] expect_column_values_to_be_between"])
    )


def test_rule_column_resolves_case_insensitively(spark):
    # The traffic suite names Road_Category_Id; the column is Road_Category_ID.
    df = spark.createDataFrame([(7,)], "Road_Category_ID int")
    rule = traffic.SUITE.row_rules[3]
    assert rule.label == "[Road_Category_Id] expect_column_values_to_be_between"
    assert df.select(rule.failed().alias("f")).first().f is True


def test_quarantine_layout(spark):
    ann = quality.annotate(_df(spark), SUITE)
    q = quality.quarantine_rows(ann, "t", 7)
    assert q.columns == ["table_name", "gx_batch_id", "violated_rules", "raw_data", "ingestion_time"]
    rows = q.collect()
    assert len(rows) == 4 and {r.gx_batch_id for r in rows} == {"7"}
    whole = quality.quarantine_whole_batch(_df(spark), "t", 7).collect()
    assert len(whole) == len(ROWS) and {r.violated_rules for r in whole} == {TABLE_LEVEL_ERROR}


def test_json_roundtrip_restores_nulls(spark):
    ann = quality.annotate(_df(spark), SUITE)
    q = quality.quarantine_rows(ann, "t", 0)
    back = q.select(F.from_json("raw_data", _df(spark).schema).alias("p")).select("p.*")
    assert sorted(map(tuple, back.collect()), key=str) == sorted(
        [r for r in ROWS if r[3] in ("b", "c", "d", "f")], key=str
    )


def test_roads_suite_shape():
    assert [r.label for r in roads.SUITE.row_rules] == [
        "[Road_ID] expect_column_values_to_not_be_null",
        "[Total_Link_Length_Km] expect_column_values_to_be_between",
        "[Road_Category_Id] expect_column_values_to_be_between",
    ]


def test_suite_spec_roundtrip(spark):
    import json

    import pytest

    from strata.operators.rules import suite_from_spec, suite_to_spec

    spec = json.loads(json.dumps(suite_to_spec(traffic.SUITE)))
    rebuilt = suite_from_spec("raw_traffic", spec)
    assert rebuilt == traffic.SUITE
    assert spec[2] == {
        "type": "expect_column_values_to_match_strftime_format",
        "kwargs": {"column": "Count_date", "strftime_format": "%m/%d/%Y %H:%M"},
    }
    assert suite_from_spec("raw_roads", suite_to_spec(roads.SUITE)) == roads.SUITE
    with pytest.raises(ValueError):
        suite_from_spec("t", [{"type": "expect_column_values_to_be_unique", "kwargs": {"column": "a"}}])


def test_length_rules_from_a_schema(spark):
    from strata.operators.rules import MaxLength, suite_from_spec, suite_to_spec

    suite = SUITE.with_lengths(_df(spark).schema, 3)
    assert suite.rules[-1] == MaxLength("name", 3) and suite.with_lengths(_df(spark).schema, 9) == suite
    df = spark.createDataFrame([(1, 1, 1.0, "abc"), (2, 1, 1.0, "\u00e9\u00e9\u00e9"), (3, 1, 1.0, "abcd"), (4, 1, 1.0, None)], SCHEMA)
    got = {r.id: r.v for r in quality.annotate(df, suite).select("id", quality.violated_rules_text().alias("v")).collect()}
    assert got == {1: "", 2: "", 3: "[name] expect_column_value_lengths_to_be_between", 4: ""}
    assert suite_from_spec("t", suite_to_spec(suite)) == suite


def test_join_back_keeps_rows_without_violations(spark):
    df = _df(spark)
    regrouped = quality.violations_regroup(quality.violations_long(quality.annotate(df, SUITE), ["name"]), ["name"])
    got = {r.name: r.violated_rules for r in quality.violations_join_back(df, regrouped, ["name"]).collect()}
    assert set(got) == set("abcdef") and got["a"] is None and got["f"].count(";") == 2
