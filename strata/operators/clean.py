"""Cleaning: duplicate removal and the null policy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.schemas import AUDIT_COLUMNS


def payload_columns(df: DataFrame, exclude: Sequence[str] = AUDIT_COLUMNS) -> list[str]:
    """Columns that describe the record (audit and lineage columns excluded)."""
    skip = set(exclude)
    return [c for c in df.columns if c not in skip]


def payload_digest(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """A 256-bit digest of a record: equal records, and only those, share it.

    Keys of 32 bytes instead of whole records, for dedup state and indexes.
    Zeros of either sign are one value, as in ``dropDuplicates``.
    """
    cols = list(columns) if columns else payload_columns(df)
    kinds = dict(df.dtypes)

    def plain(c: str) -> Column:
        if kinds[c] in ("double", "float"):
            return F.col(c) + F.lit(0.0)
        return F.col(c).cast("string") if kinds[c].startswith("timestamp") else F.col(c)

    return F.unhex(F.sha2(F.to_json(F.struct(*[plain(c).alias(c) for c in cols])), 256))


def dedup_full_row(df: DataFrame, exclude: Sequence[str] = AUDIT_COLUMNS) -> DataFrame:
    """Drop repeated records, comparing payload columns only.

    Audit timestamps differ per delivery, so including them would let a
    re-delivered row through.  Planned as a hash aggregate with a map-side
    partial step, so a very hot duplicate collapses before the shuffle.
    """
    return df.dropDuplicates(payload_columns(df, exclude))


def dedup_by_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] = (),
    keep: str = "first",
) -> DataFrame:
    """Keep one row per key: the smallest (``first``) or largest (``last``)
    by ``order_by``, ties broken by the remaining columns.

    Written as ``min``/``max`` of a struct instead of ``row_number`` over a
    window: the aggregate is partial per task, so a key holding a third of
    all rows is reduced to one candidate per task before the shuffle, while
    a window would sort the whole hot key in one task.
    """
    if keep not in ("first", "last"):
        raise ValueError("keep must be 'first' or 'last'")
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    ordered = list(order_by) + rest
    pick = F.min if keep == "first" else F.max
    agg = df.groupBy(*keys).agg(pick(F.struct(*[F.col(c) for c in ordered])).alias("_pick"))
    return agg.select(*[F.col(k) for k in keys], *[F.col(f"_pick.{c}").alias(c) for c in ordered]).select(
        *df.columns
    )


def fill_strings(df: DataFrame, value: str = "Unknown", subset: Sequence[str] | None = None) -> DataFrame:
    """NULL strings become ``value``; other types are untouched."""
    return df.fillna(value, subset=list(subset) if subset else None)


def fill_numerics(df: DataFrame, value: int = 0, subset: Sequence[str] | None = None) -> DataFrame:
    """NULL numbers become ``value`` (column types are kept); timestamps stay NULL."""
    return df.fillna(value, subset=list(subset) if subset else None)


def null_policy(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Strings to 'Unknown', then numbers to 0 -- one projection."""
    cols = list(subset) if subset else df.columns
    return fill_numerics(fill_strings(df, "Unknown", cols), 0, cols)
