"""Helpers shared by the text operators.

Operators read their inputs through :func:`keyed`, which keeps nothing but an
id and a text under names of its own, so extra columns of the caller can never
clash.  A null id takes part as :data:`NO_ID` and is null again in results.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.config import fresh_dir, shared_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: Words between ASCII white space.
SPACED_WORD = r"[^\x20\x09-\x0D]+"
#: Runs of ASCII letters and digits and of all other non-ASCII characters (after lower-casing).
PLAIN_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
NO_ID = -(2**63)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z; every other character stays as it is."""
    return F.translate(text, UPPER, LOWER)


def keyed(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(_id long, _text string or null)`` of every row."""
    return df.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("_id"), F.col(text_col).alias("_text")
    )


def unkeyed(col: Column) -> Column:
    """The id as the caller gave it."""
    return F.nullif(col, F.lit(NO_ID))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Written once to the folder that all executors share (``spark.checkpoint.dir``)."""
    shared_dir(df.sparkSession)
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def written(df: DataFrame, label: str) -> DataFrame:
    """Written once as Parquet to the shared folder and read back: smaller than a
    checkpoint for tables of many rows with repeated values."""
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def groups_for(n: int, rows_each: int) -> int:
    """So many groups that none expects more than ``rows_each`` of ``n`` rows."""
    return max(1, math.ceil(n / rows_each))
