"""The native strftime check must accept exactly what Python's strptime accepts."""

from __future__ import annotations

from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.functions.strftime import compile_strftime, matches_strftime

FMT = "%m/%d/%Y %H:%M"

ACCEPTED = [
    "6/25/2014 0:00", "06/25/2014 00:00", "6/25/2014 7:5", "6/25/2014  0:00", "6/25/2014\t0:00",
    "6/ 5/2014 0:00", "2/29/2016 1:00", "2/29/2000 0:00", "6/25/0001 0:00", "12/31/9999 23:59",
    "1/1/2014 9:9",
]
REJECTED = [
    "25/6/2014 0:00", "2/30/2014 0:00", "6/31/2014 0:00", "2/29/2015 1:00", "2/29/1900 0:00",
    "6/25/14 0:00", "6/25/2014", "6/25/2014 24:00", "6/25/2014 23:60", "6/25/2014 0:00:00",
    " 6/25/2014 0:00", "6/25/2014 0:00 ", "6/25/2014 0:00\n", "006/25/2014 0:00", "6/25/02014 0:00",
    "6/25/0000 0:00", "6/25/2014 000:00", "", "2014-06-25 00:00", "+6/25/2014 0:00",
]


def python_ok(text: str, fmt: str = FMT) -> bool:
    try:
        datetime.strptime(text, fmt)
        return True
    except ValueError:
        return False


def spark_ok(spark, values, fmt=FMT):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    rows = df.select("i", F.coalesce(matches_strftime("v", fmt), F.lit(False)).alias("ok")).collect()
    return {r.i: r.ok for r in rows}


def test_fixture_lists_agree_with_python():
    assert all(python_ok(v) for v in ACCEPTED)
    assert not any(python_ok(v) for v in REJECTED)


def test_native_check_matches_fixture_lists(spark):
    values = ACCEPTED + REJECTED
    got = spark_ok(spark, values)
    for i, v in enumerate(values):
        assert got[i] == python_ok(v), repr(v)


def test_null_gives_null(spark):
    df = spark.createDataFrame([(None,)], "v string")
    assert df.select(matches_strftime("v", FMT).alias("ok")).first().ok is None


def test_unsupported_directive_rejected_at_build_time():
    with pytest.raises(ValueError):
        compile_strftime("%m/%d/%Y %Z")


_ALPHABET = st.sampled_from(list("0123456789/: ") + ["\t"])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(_ALPHABET, min_size=0, max_size=18), min_size=1, max_size=40))
def test_random_strings_match_python(spark, values):
    got = spark_ok(spark, values)
    for i, v in enumerate(values):
        assert got[i] == python_ok(v), repr(v)


@settings(max_examples=30, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.integers(0, 13), st.integers(0, 32), st.integers(0, 2100), st.integers(0, 25), st.integers(0, 61)
        ),
        min_size=1,
        max_size=40,
    )
)
def test_structured_dates_match_python(spark, parts):
    values = [f"{m}/{d}/{y:04d} {h}:{mi:02d}" for m, d, y, h, mi in parts]
    got = spark_ok(spark, values)
    for i, v in enumerate(values):
        assert got[i] == python_ok(v), repr(v)


def test_other_format_with_seconds(spark):
    fmt = "%Y-%m-%d %H:%M:%S"
    values = ["2024-01-31 23:59:59", "2024-02-30 00:00:00", "2024-1-1 1:1:1", "2024-01-01 00:00", "2023-02-29 00:00:00"]
    got = spark_ok(spark, values, fmt)
    for i, v in enumerate(values):
        assert got[i] == python_ok(v, fmt), repr(v)


def test_two_digit_and_missing_years(spark):
    for fmt, values in {
        "%m/%d/%y": ["02/29/24", "02/30/24", "02/29/23", "2/29/00", "04/31/10", "12/31/68", "12/31/69", "02/29/68", "02/29/70"],
        "%m/%d": ["02/29", "02/28", "04/31", "12/31", "13/01"],
        "%d.%m.": ["31.04.", "30.04.", "29.02."],
    }.items():
        got = spark_ok(spark, values, fmt)
        for i, v in enumerate(values):
            assert got[i] == python_ok(v, fmt), (fmt, v)
