"""The traffic suite on random rows equals a plain-Python evaluation of the
same rules (brute force, strptime for the date rule)."""

from __future__ import annotations

from datetime import datetime

from hypothesis import given, settings
from hypothesis import strategies as st

from strata.operators.quality import annotate, violated_rules_text
from strata.plans import traffic

LABELS = [r.label for r in traffic.SUITE.row_rules]


def python_violations(record_id, count_date, hour, category) -> str:
    out = []
    if record_id is None:
        out.append(LABELS[0])
    if count_date is not None:
        try:
            datetime.strptime(count_date, "%m/%d/%Y %H:%M")
        except ValueError:
            out.append(LABELS[1])
    if hour is not None and not 1 <= hour <= 24:
        out.append(LABELS[2])
    if category is not None and not 1 <= category <= 5:
        out.append(LABELS[3])
    return "; ".join(out)


dates = st.one_of(
    st.none(),
    st.builds(
        lambda m, d, y, h, mi, sep: f"{m}/{d}/{y} {h}{sep}{mi:02d}",
        st.integers(0, 14), st.integers(0, 32), st.sampled_from([1999, 2000, 2014, 2016, 2100, 14]),
        st.integers(0, 25), st.integers(0, 61), st.sampled_from([":", ".", ""]),
    ),
    st.text(st.sampled_from(list("0123456789/: ")), max_size=16),
)
rows = st.lists(
    st.tuples(
        st.one_of(st.none(), st.integers(-5, 10**6)),
        dates,
        st.one_of(st.none(), st.integers(-2, 27)),
        st.one_of(st.none(), st.integers(-1, 8)),
    ),
    min_size=1,
    max_size=60,
)


@settings(max_examples=25, deadline=None)
@given(rows)
def test_suite_matches_python(spark, data):
    df = spark.createDataFrame(
        [(i, *r) for i, r in enumerate(data)],
        "i int, Record_ID int, Count_date string, hour int, Road_Category_ID int",
    )
    got = {r.i: r.v for r in annotate(df, traffic.SUITE).select("i", violated_rules_text().alias("v")).collect()}
    for i, r in enumerate(data):
        assert got[i] == python_violations(*r), (r, got[i])
