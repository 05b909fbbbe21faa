"""Sharding by rendezvous hashing.

Every shard scores a record's key with a hash of (key, shard) and its weight;
the highest score wins.  A shard's score depends on nothing else, so one more
shard takes rows only into itself, and dropping a shard moves only its rows.

Native: hashes, the choice and the numbering are column expressions and
windows.  No row's text is shuffled.

Defined cases: a null key is the key ``\\N``; repeated keys go to one shard;
rows equal in key and text are interchangeable, so which of them gets which of
their slots is open; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read_table

_HEX = 13  # 52 bits: exact in a double
#: Slots are numbered within so many hash buckets a shard, then offset: no
#: shard is ever sorted in one task.
SLOT_BUCKETS_HEX = 3


def _key_text(key: Column) -> Column:
    return F.coalesce(key.cast("string"), F.lit("\\N"))


def _hash52(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text), 1, _HEX), 16, 10).cast("long")


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard (0 .. len(weights) - 1) of a key.

    Score of shard s: ``weight / -ln(u)``, u the hash of (key, s) in (0, 1);
    a key lands on s with probability ``weight / sum of weights``.  Ties go to
    the larger hash, then to the smaller shard.
    """
    if not weights or any(not w > 0 for w in weights):
        raise ValueError("every shard needs a weight above 0")
    k = _key_text(key)
    scores = []
    for s, w in enumerate(weights):
        h = _hash52(F.concat(k, F.lit(f"#{s}")))
        u = (h.cast("double") + 0.5) / float(2 ** (4 * _HEX))
        scores.append((F.lit(float(w)) / -F.log(u), h, F.lit(-s)))
    best = F.array_max(
        F.array(*[F.struct(a.alias("score"), h.alias("hash"), s.alias("minus")) for a, h, s in scores])
    )
    return (-best["minus"]).cast("int")


def numbered(df: DataFrame, shard: str, key: str, order: Sequence[str]) -> DataFrame:
    """Adds ``slot``: 0, 1, 2 ... without gaps within each shard.

    Rows are ordered by a hash bucket of the key, then by ``order``.  Each
    bucket is numbered on its own and shifted by the sizes of those before it.
    """
    bucket = F.substring(F.md5(_key_text(F.col(key))), 1, SLOT_BUCKETS_HEX)
    rows = df.withColumn("_bucket", bucket)
    sizes = rows.groupBy(shard, "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(shard).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        F.col(shard).alias("_s"), F.col("_bucket").alias("_b"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    place = Window.partitionBy(shard, "_bucket").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    ranked = rows.withColumn("_place", F.row_number().over(place) - 1)
    return (
        ranked.join(starts, (F.col(shard) == F.col("_s")) & (F.col("_bucket") == F.col("_b")))
        .withColumn("slot", (F.col("_start") + F.col("_place")).cast("long"))
        .drop("_s", "_b", "_bucket", "_start", "_place")
    )


def shard_records(docs: DataFrame, weights: Sequence[float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its key, size, text checksum, shard, slot
    in the shard, and the shard it would get with one more of the last weight.
    A null text has no bytes (size 1, checksum 0)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "utf-8")).cast("long").alias("text_crc32"),
        rendezvous(F.col(id_col), weights).alias("shard"),
        rendezvous(F.col(id_col), [*weights, weights[-1]]).alias("grown_shard"),
    )
    return numbered(rows, "shard", "doc_id", ["doc_id", "size", "text_crc32"]).withColumn("law", F.lit("key")).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )


N_SHARDS = 16


def op10_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_records(read_table(spark, sf_dir, "documents"), [1.0] * N_SHARDS)


#: With equal weights the highest score is the highest hash.  The checksum
#: follows the reflected polynomial 0xEDB88320 byte by byte.
OP10_SQL = f"""
WITH RECURSIVE bits(v, c, k) AS (
  SELECT range, range::BIGINT, 0 FROM range(256)
  UNION ALL
  SELECT v, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8
),
tab AS (SELECT list(c ORDER BY v) AS t FROM bits WHERE k = 8),
docs AS (
  SELECT doc_id, coalesce(text, '') AS body, md5(doc_id::VARCHAR) AS m,
         list_transform(range({N_SHARDS + 1}),
           lambda s: ('0x' || substr(md5(doc_id::VARCHAR || '#' || s::VARCHAR), 1, {_HEX}))::BIGINT) AS h
  FROM documents
),
summed AS (
  SELECT docs.*, octet_length(encode(body)) + 1 AS size,
         xor(list_reduce(list_prepend(4294967295::BIGINT,
           list_transform(regexp_extract_all(hex(encode(body)), '..'), lambda b: ('0x' || b)::BIGINT)),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295::BIGINT) AS text_crc32
  FROM docs, tab
),
placed AS (
  SELECT *, list_position(h[1:{N_SHARDS}], list_max(h[1:{N_SHARDS}])) - 1 AS shard,
         list_position(h, list_max(h)) - 1 AS grown_shard
  FROM summed
)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'key' AS law, shard::INT AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY substr(m, 1, {SLOT_BUCKETS_HEX}), doc_id, size, text_crc32) - 1 AS slot,
       grown_shard::INT AS grown_shard
FROM placed
"""
