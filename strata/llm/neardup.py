"""Near-duplicates by SetSketch registers.

1. Each text's set of word shingles is sketched into ``REGISTERS`` registers:
   register i keeps the smallest of exponential values of the shingles, as the
   exponent ``floor(1 - log_b(.))``.  The sketch of a union is the register-wise
   maximum, and registers of similar sets agree.
2. Texts with equal sets are one class (by a 128-bit digest of the whole set).
3. Bands of ``BAND`` registers are candidate buckets.  A bucket's centre is its
   class whose buckets hold most others.  Every class is compared with the
   centres of its buckets, so a group of thousands of near copies costs about
   one comparison each.  A pair's Jaccard similarity is first estimated jointly
   from its registers and set sizes by maximum likelihood; pairs that could reach
   the threshold (within 5.8 standard errors) are confirmed on the full sets.
4. Classes that did not join their centre's component may still be similar to its
   other classes.  All classes of a bucket are told apart by what they change in
   the set of one that is central to many buckets (:func:`edits`): similar classes share so many of their changes that one of the
   first few must agree, at places that allow the rest (:func:`candidates` has the
   argument).  So no pair of a bucket that could join two components is passed
   over, and few others are looked at.
5. Components of the confirmed links.

Sets are compared as sorted 64-bit hashes of their shingles; two different
shingles of a pair of sets of a thousand share one with probability 1e-13.
A pair at exactly 0.8 shares no band with probability 5e-6; above 0.85, 1e-8.

Defined cases: a null or wordless text has an empty set, linked with nothing;
with fewer words than a shingle the whole sequence is the one shingle; rows of
one doc_id are one document (their texts' links all count, and they share a
component); an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import NO_ID, cut_lineage, keyed, read_table, unkeyed
from .graph import components
from .words import random64, shingles, spaced

REGISTERS = 240
BAND = 6
_BASE, _RATE, _LIMIT = 1.001, 20.0, 65535
_ROWS = 512


def registers(members: np.ndarray) -> np.ndarray:
    """The registers of a set of 64-bit hashes (big-endian 16 bits each)."""
    factors = (random64(REGISTERS, 11) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    shifts = (random64(REGISTERS, 13) >> np.uint64(32)).astype(np.uint32)
    values = (members >> np.uint64(32)).astype(np.uint32)
    least = np.full(REGISTERS, np.iinfo(np.uint32).max, np.uint32)
    with np.errstate(over="ignore"):
        for i in range(0, len(values), _ROWS):
            np.minimum(least, (values[i : i + _ROWS, None] * factors + shifts).min(axis=0), out=least)
    exponential = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**32) / _RATE
    return np.clip(np.floor(1 - np.log(exponential) / math.log(_BASE)), 0, _LIMIT).astype(">u2")


def likely_jaccard(a: np.ndarray, b: np.ndarray, n_a: float, n_b: float) -> float:
    """Maximum likelihood of J given which registers are larger, smaller, equal.

    With shares u, v of the summed sizes, a register of the first set is larger
    with probability u - v J, smaller with v - u J and equal with J; the
    derivative's zero is the smaller root of a quadratic.
    """
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)
    larger, smaller = int((a > b).sum()), int((a < b).sum())
    m = len(a)
    equal = m - larger - smaller
    s = u * u * (equal + smaller) + v * v * (equal + larger)
    return (s - math.sqrt(max(0.0, s * s - 4 * u * u * v * v * m * equal))) / (2 * m * u * v)


def sketches(docs: DataFrame, k: int) -> DataFrame:
    """``(_id, _n, _set, _regs)``: set size, 128-bit digest of the set, registers."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, bounds = spaced(batch.column("_text"))
            sizes, digests, regs = [], [], []
            for lo, hi in zip(bounds[:-1], bounds[1:]):
                members = shingles(words[lo:hi], k)
                sizes.append(len(members))
                digests.append(hashlib.blake2b(members.tobytes(), digest_size=16).digest())
                regs.append(registers(members).tobytes() if len(members) else b"")
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(regs, pa.binary())],
                names=["_id", "_n", "_set", "_regs"],
            )

    return keyed(docs).mapInArrow(sketch, "_id long, _n long, _set binary, _regs binary")


def full_sets(docs: DataFrame, nodes: DataFrame, k: int) -> DataFrame:
    """``(node, h, s)``: the sorted shingle hashes of the texts of ``nodes``; h tells
    apart the sets of a node that has several."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, bounds = spaced(batch.column("_text"))
            sets = [shingles(words[lo:hi], k) for lo, hi in zip(bounds[:-1], bounds[1:])]
            keys = [int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "big", signed=True) for s in sets]
            ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            values = np.concatenate([*sets, np.empty(0, np.uint64)]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(keys, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(values))],
                names=["node", "h", "s"],
            )

    texts = keyed(docs).join(nodes.select(F.col("node").alias("_id")), "_id", "left_semi")
    sets = texts.mapInArrow(read, "node long, h long, s array<long>").where(F.size("s") > 0)
    return sets.groupBy("node", "h").agg(F.any_value("s").alias("s"))


def _could_reach(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Pairs whose estimate is not clearly under the threshold."""
    j = percent / 100
    floor = j - 5.8 * math.sqrt(j * (1 - j) / REGISTERS)

    @F.pandas_udf("double")
    def estimate(a: pd.Series, b: pd.Series, n_a: pd.Series, n_b: pd.Series) -> pd.Series:
        read = lambda x: np.frombuffer(x, ">u2")
        return pd.Series([likely_jaccard(read(x), read(y), p, q) for x, y, p, q in zip(a, b, n_a, n_b)], dtype=float)

    side = lambda s: reps.select(F.col("node").alias(s), F.col("_n").alias(f"n_{s}"), F.col("_regs").alias(f"r_{s}"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    sized = joined.where((F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent))
    return sized.where(estimate("r_a", "r_b", "n_a", "n_b") >= floor).select("a", "b")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links: pairs whose full shingle sets are similar enough."""
    side = lambda x: sets.select(F.col("node").alias(x), F.col("s").alias(f"s_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    common = F.size(F.array_intersect("s_a", "s_b"))
    return both.where(common * 100 >= (F.size("s_a") + F.size("s_b") - common) * percent).select("a", "b")


def edits(grouped: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """What the classes x of ``grouped`` (c, x, part, apart) change in the set of
    their centre c: ``e`` has the shingles of x that c lacks and those of c that x
    lacks, d of them.  ``first`` is how many of these :func:`candidates` must look at."""
    centre = sets.select(F.col("node").alias("c"), F.col("h").alias("hc"), F.col("s").alias("s_c"))
    own = sets.select(F.col("node").alias("x"), "h", F.col("s").alias("s_x"))
    both = grouped.join(centre, "c").join(own, "x")
    changed = both.select(
        "c", "hc", "x", "h", "part", "apart", F.size("s_x").cast("long").alias("n"), F.size("s_c").cast("long").alias("n_c"),
        F.concat(F.array_except("s_x", "s_c"), F.array_except("s_c", "s_x")).alias("e"),
    ).withColumn("d", F.size("e").cast("long"))
    less, more = 100 - percent, 100 + percent
    far = F.expr(f"{less} * n div {percent} + 1")
    near = F.expr(f"({more} * d + {less} * (n - n_c) - 1) div {2 * more} + 1")
    return changed.withColumn("first", F.least(F.greatest(F.when(F.col("apart"), far).otherwise(near), F.lit(0)), F.col("d")).cast("int"))


def places(changes: DataFrame) -> DataFrame:
    """The changes ``e`` at places i < first of each class of ``changes``, without those
    that classes of one part alone have.  All classes of a centre sort changes
    alike: first those of one part, then the others, each the rarest first, so what
    many classes changed seldom takes one of the first places."""
    every = changes.where("first > 0").select("c", "hc", "x", "h", "part", "apart", "n", "d", "first", F.explode("e").alias("e"))
    shared = every.groupBy("c", "hc", "e").agg(F.count("*").alias("often"), (F.min("part") != F.max("part")).alias("between"))
    order = Window.partitionBy("c", "hc", "x", "h").orderBy("between", "often", "e")
    placed = every.join(shared, ["c", "hc", "e"]).withColumn("i", F.row_number().over(order) - 1)
    return placed.where("between AND i < first").select("c", "hc", "x", "h", "part", "apart", "n", "d", "i", "e")


def candidates(changes: DataFrame, percent: int) -> DataFrame:
    """Pairs ``(c, hc, a, ha, b, hb)`` of classes of one centre in different parts
    that could be similar; a is apart from the centre: not similar to it.

    a and b differ in D = d_a + d_b - 2 o shingles, where o of their changes are
    the same, and are similar if (100 + percent) D <= (100 - percent) (n_a + n_b);
    call this limit.  (o > 0, as else b would have to differ from the centre by
    less than its size does.)  All classes of a centre sort changes alike, so if
    the first that a and b share has j before it in a and i in b, then
    o <= min(d_a - j, d_b - i), which must keep D within the limit.  Without
    knowing the other class: j <= D, and n_b <= 100 n_a / percent, so
    j <= (100 - percent) n_a / percent.  For b in the centre's part, a's own
    distance from the centre is beyond the limit, so
    2 (100 + percent) i < (100 + percent) d_b + (100 - percent) (n_b - n_c).
    Changes after these places need not be looked at.

    Changes are met by part first, so the classes of one part, however many share
    a change, are not paired with each other.
    """
    less, more = 100 - percent, 100 + percent
    looked_at = cut_lineage(places(changes))
    by_part = looked_at.groupBy("c", "hc", "e", "part").agg(
        F.min(F.expr(f"{more} * d - {less} * n")).alias("low"), F.max(F.expr(f"{more} * d + {less} * n - {2 * more} * i")).alias("high"),
        F.min("n").alias("least"), F.max("n").alias("most"),
    ).withColumnsRenamed({"c": "_c", "hc": "_hc", "e": "_e", "part": "other"})
    meets = (F.col("c") == F.col("_c")) & (F.col("hc") == F.col("_hc")) & (F.col("e") == F.col("_e")) & (F.col("part") != F.col("other"))
    could = F.expr(f"low <= {less} * n + {more} * d - {2 * more} * i AND {more} * d - {less} * n <= high AND 100 * most >= {percent} * n AND {percent} * least <= 100 * n")
    met = looked_at.where("apart").join(by_part, meets & could).select(
        "c", "hc", "e", "other", F.col("x").alias("a"), F.col("h").alias("ha"), F.col("n").alias("n_a"), F.col("d").alias("d_a"), F.col("i").alias("j")
    )
    right = looked_at.select(
        F.col("c").alias("_c"), F.col("hc").alias("_hc"), F.col("e").alias("_e"), "part", "apart", F.col("x").alias("b"), F.col("h").alias("hb"),
        F.col("n").alias("n_b"), F.col("d").alias("d_b"), "i",
    )
    same = (F.col("c") == F.col("_c")) & (F.col("hc") == F.col("_hc")) & (F.col("e") == F.col("_e")) & (F.col("other") == F.col("part"))
    once = ~F.col("apart") | (F.col("a") < F.col("b"))
    within = F.expr(
        f"{more} * (d_a + d_b - 2 * least(d_a - j, d_b - i)) <= {less} * (n_a + n_b) AND {more} * abs(d_a - d_b) <= {less} * (n_a + n_b)"
        f" AND 100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)"
    )
    return met.join(right, same & once & within).select("c", "hc", "a", "ha", "b", "hb").distinct()


def _linked_by_edits(changes: DataFrame, percent: int) -> DataFrame:
    """Links between classes of one centre that are in different parts."""
    less, more = 100 - percent, 100 + percent
    side = lambda s: changes.select(
        "c", "hc", F.col("x").alias(s), F.col("h").alias(f"h{s}"), F.col("n").alias(f"n_{s}"), F.col("d").alias(f"d_{s}"), F.col("e").alias(f"e_{s}")
    )
    pairs = candidates(changes, percent).join(side("a"), ["c", "hc", "a", "ha"]).join(side("b"), ["c", "hc", "b", "hb"])
    differ = F.col("d_a") + F.col("d_b") - 2 * F.size(F.array_intersect("e_a", "e_b"))
    linked = pairs.where(more * differ <= less * (F.col("n_a") + F.col("n_b"))).select("a", "b")
    # Those that the estimate passed over, if any.
    to_centre = changes.where(F.col("apart") & (more * F.col("d") <= less * (F.col("n") + F.col("n_c")))).select(F.col("c").alias("a"), F.col("x").alias("b"))
    return linked.unionByName(to_centre).distinct()


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles,
    component_id (smallest doc_id reachable), kept (it is that one)."""
    rows = cut_lineage(sketches(docs, k))
    classes = rows.where("_n > 0").groupBy("_set").agg(F.min("_id").alias("node"), F.any_value("_n").alias("_n"), F.any_value("_regs").alias("_regs"))
    classes = cut_lineage(classes)
    # Joins of written tables alone, so that a hot set is split.
    members = cut_lineage(rows.select("_id", "_n", "_set").join(classes.select("_set", "node"), "_set", "left").drop("_set"))
    reps = classes.select("node", "_n", "_regs")

    keys = [
        F.xxhash64(F.lit(i), F.substring("_regs", 2 * i + 1, 2 * BAND)) for i in range(0, REGISTERS, BAND)
    ]
    bands = reps.select("node", F.explode(F.array(*keys)).alias("key"))
    filled = bands.groupBy("key").agg(F.count("*").alias("_members")).where("_members > 1")
    shared = cut_lineage(bands.join(filled, "key").select("key", "node", "_members"))
    score = shared.groupBy("node").agg(F.sum("_members").alias("score"))
    top = F.struct("score", "node")
    central = shared.join(score, "node").groupBy("key").agg(F.max_by("node", top).alias("c"), F.max("score").alias("_top"))
    met = cut_lineage(shared.join(central, "key").select("node", "c", "_top"))
    grouped = cut_lineage(met.where("node <> c").select("c", F.col("node").alias("x")).distinct())

    nodes = grouped.select(F.explode(F.array("c", "x")).alias("node")).distinct()
    sets = cut_lineage(full_sets(docs, nodes, k))
    pairs = grouped.select(F.greatest("c", "x").alias("a"), F.least("c", "x").alias("b")).distinct()
    likely = cut_lineage(_could_reach(pairs, reps, percent))

    # Rows of one doc_id with different texts belong together.
    of_id = members.where("node is not null").groupBy("_id").agg(F.min("node").alias("a"), F.max("node").alias("_top")).where("a <> _top")
    same_id = of_id.select("_id", "a").join(members.select("_id", F.col("node").alias("b")), "_id").where("a <> b").select("a", "b")
    found = cut_lineage(_confirmed(likely, sets, percent).unionByName(same_id))

    parts = cut_lineage(components(found))
    part_of = lambda x, name: parts.select(F.col("node").alias(x), F.col("component").alias(name))
    # A bucket's classes are told apart by what they change in the most central
    # centre that the bucket's own centre meets, so one set serves a group's buckets.
    hubs = met.groupBy(F.col("node").alias("c")).agg(F.max_by("c", F.struct("_top", "c")).alias("hub"))
    around = grouped.join(hubs, "c").select(F.col("hub").alias("c"), "x").where("c <> x").distinct()
    placed = around.join(part_of("x", "p_x"), "x", "left").join(part_of("c", "p_c"), "c", "left")
    placed = placed.select("c", "x", F.coalesce("p_x", "x").alias("part"), (F.coalesce("p_x", "x") != F.coalesce("p_c", "c")).alias("apart"))
    count = placed.groupBy("c").agg(F.count("*").alias("_all"), F.max("apart").alias("_apart")).where("_all > 1 and _apart")
    changes = cut_lineage(edits(placed.join(count.select("c"), "c"), sets, percent))
    # The parts are stars already, so only what the new links join takes rounds.
    stars = parts.select(F.col("node").alias("a"), F.col("component").alias("b"))
    joined = components(stars.unionByName(_linked_by_edits(changes, percent)))

    whole = members.join(joined, "node", "left").withColumn("_to", F.coalesce("component", "node", "_id"))
    return whole.select(
        unkeyed(F.col("_id")).alias("doc_id"),
        F.col("_n").alias("n_shingles"),
        unkeyed(F.col("_to")).alias("component_id"),
        (F.col("_id") == F.col("_to")).alias("kept"),
    )


def _text_key(docs: DataFrame) -> Column:
    """A 64-bit key of each row's (doc_id, text), different for all different
    ones of ``docs``: the first of a series of hashes without a collision."""
    doc_id, text = F.col("doc_id").cast("long"), F.col("text")
    own = [doc_id.isNull(), text.isNull(), doc_id, text]
    digest = F.struct(doc_id, F.md5(F.encode(text, "utf-8")))
    for seed in itertools.count():
        key = F.xxhash64(F.lit(seed), *own)
        of_key = docs.select(key.alias("key"), digest.alias("d")).groupBy("key").agg(F.min("d").alias("lo"), F.max("d").alias("hi"))
        if not of_key.where((~F.col("lo").eqNullSafe(F.col("hi"))) | (F.col("key") == NO_ID)).count():
            return key


def drop_near_duplicate_texts(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The documents that stay, where every text counts for itself, whatever its
    id: of each group of linked texts the one with the smallest doc_id (null
    last).  Texts are not linked by a null or repeated id; rows of one doc_id and
    one text are one document, and the first by their other columns stays."""
    key = _text_key(docs)
    groups = near_duplicates(docs.select(key.alias("doc_id"), "text"), k, percent)
    groups = groups.select(F.col("doc_id").alias("_key"), F.col("component_id").alias("_group")).distinct()
    ids = docs.select(key.alias("_of"), F.col("doc_id").cast("long").alias("_doc")).distinct()
    order = F.struct(F.col("_doc").isNull(), "_doc", "_key")
    kept = groups.join(ids, F.col("_key") == F.col("_of")).groupBy("_group").agg(F.min_by("_key", order).alias("_kept"))
    kept = cut_lineage(kept.select("_kept"))
    others = [F.struct(F.col(c).isNull(), F.col(c)) for c in docs.columns if c not in ("doc_id", "text")]
    first = F.min_by(F.struct(*docs.columns), F.struct(F.lit(0), *others))
    stay = docs.groupBy(key.alias("_key")).agg(first.alias("_row")).join(kept, F.col("_key") == F.col("_kept"))
    return stay.select("_row.*")


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"), k=2)


OP3_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN w
    ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s
  FROM words
),
members AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM members a JOIN members b ON a.x = b.x AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, r) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT reach.doc_id, both_ways.b FROM reach JOIN both_ways ON reach.r = both_ways.a
)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, min(r.r) AS component_id, s.doc_id = min(r.r) AS kept
FROM sets s JOIN reach r ON s.doc_id = r.doc_id GROUP BY s.doc_id, s.s
"""
