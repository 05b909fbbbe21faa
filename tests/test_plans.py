"""Physical plans have the shape the design relies on at scale."""

from __future__ import annotations

import contextlib
import io
import re

from strata.queries import QUERIES

from .conftest import SF_SMALL


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_pruning_reaches_the_scan(spark):
    text = plan(QUERIES["rule_not_null"](spark, SF_SMALL))
    schemas = re.findall(r"ReadSchema: (struct<[^\n]*>)", text)
    assert schemas == ["struct<event_id:bigint>"]


def test_validation_needs_no_shuffle(spark):
    for name in ("validate_suite", "split_valid", "null_policy", "derived_motor_count", "vehicle_intensity"):
        assert "Exchange" not in plan(QUERIES[name](spark, SF_SMALL)), name


def test_rule_counts_are_one_global_aggregate(spark):
    text = plan(QUERIES["rule_failure_counts"](spark, SF_SMALL))
    tree = text.split("\n\n")[0]
    assert len(re.findall(r"Exchange \(", tree)) == 2  # one per feed
    assert "SinglePartition" in text and "partial_count" in text


def test_gold_join_broadcasts_the_aggregated_roads(spark):
    text = plan(QUERIES["gold_traffic_roads_join"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in text
    assert "SortMergeJoin" not in text


def test_dedups_combine_before_the_shuffle(spark):
    full = plan(QUERIES["dedup_full_row"](spark, SF_SMALL))
    # the map-side aggregate sits below the exchange
    assert re.search(r"Exchange[\s\S]*HashAggregate", full.split("\n\n")[0])
    by_key = plan(QUERIES["dedup_by_key"](spark, SF_SMALL))
    assert "partial_min" in by_key
