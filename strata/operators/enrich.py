"""Enrichment: derived counts, code mapping, classification, ratios, audit stamps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sum_columns(df: DataFrame, name: str, columns: Sequence[str]) -> DataFrame:
    """``name`` = sum of ``columns``; an integer overflow gives NULL instead
    of failing the job (``try_add``)."""
    total = reduce(F.try_add, [F.col(c) for c in columns])
    return df.withColumn(name, total)


def map_codes(
    df: DataFrame,
    source: str,
    target: str,
    mapping: Mapping[str, str],
    default: str = "NA",
) -> DataFrame:
    """Code to name through a literal map (a JVM hash lookup, no join).

    Unknown and NULL codes give ``default``.
    """
    if not mapping:
        return df.withColumn(target, F.lit(default))
    lookup = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return df.withColumn(target, F.coalesce(F.try_element_at(lookup, F.col(source)), F.lit(default)))


def classify_contains(
    df: DataFrame,
    source: str,
    target: str,
    rules: Sequence[tuple[str, str]],
    default: str = "NA",
) -> DataFrame:
    """First rule whose substring occurs in ``source`` wins."""
    expr: Column | None = None
    for needle, value in rules:
        cond = F.col(source).contains(needle)
        expr = F.when(cond, F.lit(value)) if expr is None else expr.when(cond, F.lit(value))
    if expr is None:
        return df.withColumn(target, F.lit(default))
    return df.withColumn(target, expr.otherwise(F.lit(default)))


def ratio(df: DataFrame, name: str, numerator: str, denominator: str) -> DataFrame:
    """``numerator / denominator`` as DOUBLE; a zero or NULL denominator
    gives NULL rather than a DIVIDE_BY_ZERO failure under ANSI mode."""
    return df.withColumn(
        name, F.try_divide(F.col(numerator).cast("double"), F.col(denominator).cast("double"))
    )


def stamp(df: DataFrame, name: str) -> DataFrame:
    """Audit column: the query's start time, one value per job/micro-batch."""
    return df.withColumn(name, F.current_timestamp())
