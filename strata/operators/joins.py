"""Joins against pre-aggregated dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def aggregate_dimension(dim: DataFrame, keys: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """One row per key: a non-unique dimension would multiply fact rows."""
    return dim.groupBy(*keys).agg(*aggs)


def join_aggregated(
    facts: DataFrame,
    dim: DataFrame,
    fact_keys: Sequence[str],
    dim_keys: Sequence[str],
    aggs: Sequence[Column],
    how: str = "left",
) -> DataFrame:
    """Facts joined to the dimension aggregated on its join keys.

    The dimension is reduced to one row per key first (partial aggregate, so
    a hot key is combined map-side).  How the join runs is left to Spark: it
    broadcasts the reduced side when its measured size allows, and otherwise
    splits a hot key's facts (adaptive skew join).
    """
    agg = aggregate_dimension(dim, dim_keys, aggs)
    renamed = agg
    for fk, dk in zip(fact_keys, dim_keys):
        if fk != dk:
            renamed = renamed.withColumnRenamed(dk, fk)
    return facts.join(renamed, on=list(fact_keys), how=how)


def anti_join(df: DataFrame, remove: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key is not in ``remove`` (null-safe keys)."""
    cond = [df[k].eqNullSafe(remove[k]) for k in keys]
    return df.join(remove.select(*keys), on=cond, how="left_anti")
