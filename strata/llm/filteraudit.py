"""How filters interact: what each removes, in every order of application.

Every text fails a set of conditions, its mask.  In an order of the filters it is
removed by the first of them that is in its mask.  Orders are ranked
lexicographically (Lehmer codes), so those that begin with the same filters are
one interval of ranks: a mask's removal at step s belongs to the intervals of
all beginnings whose first s - 1 filters it passes and whose s-th it fails.  The
documents of a mask are added where such an interval begins and subtracted where
it ends; one prefix sum over the ranks gives the removals of every order.

The text is read once, in a worker that keeps only flags and a 128-bit digest.
Documents are then counted by (part, mask, labels): the first document of a text
fails nothing for being a copy, its others do, and this needs one small group a
text, never a join back.  A part is at last one row of counts by mask.

Defined cases: a null text is empty, and equal to other empty ones; a null
source is the part ''; of a text's rows those with the smallest doc_id are its
first; a null doc_id is neither smaller nor larger than another, so its row
never counts as a copy; documents without a row in ``labels`` (or with null
ones) are neither good nor toxic, and a doc_id that has several is what any of
them says; repeated rows all count; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut_lineage, read_table
from .words import text_bytes, word_pieces

FILTERS = "ABCDE"
MIN_WORDS = 200
_UPPER, _MARKS, _INNER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"#$%&*|", bytes(range(0x80, 0xC0))
_COPY = 1 << FILTERS.index("E")
_COUNTS = ["n", "good", "toxic"]


def text_mask(data: bytes) -> int:
    """Bits of the conditions A to D that a text (UTF-8) fails."""
    n_words, distinct = 0, set()
    for words in word_pieces(data):
        n_words += len(words)
        distinct.update(words)
    gone = lambda chars: len(data) - len(data.translate(None, chars))
    fails = (
        n_words < MIN_WORDS,
        100 * len(distinct) < 50 * n_words,
        100 * gone(_UPPER) > 2 * (len(data) - gone(_INNER)),
        gone(_MARKS) > 0,
    )
    return sum(1 << i for i, failed in enumerate(fails) if failed)


def masks(docs: DataFrame) -> DataFrame:
    """``(_id, part, mask, digest, n)``: rows of ``docs`` by id, source, conditions A to D and text."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = text_bytes(batch.column(2))
            found, digests = [], []
            for lo, hi in zip(bounds[:-1], bounds[1:]):
                text = data[lo:hi].tobytes()
                found.append(text_mask(text))
                digests.append(hashlib.blake2b(text, digest_size=16).digest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.int32()), pa.array(digests, pa.binary())],
                names=["_id", "part", "mask", "digest"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), F.coalesce("source", F.lit("")).alias("part"), "text")
    judged = rows.mapInArrow(judge, "_id long, part string, mask int, digest binary")
    return judged.groupBy("_id", "part", "mask", "digest").agg(F.count("*").alias("n"))


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(part, mask, n, good, toxic)``: documents by all five conditions."""
    rows = cut_lineage(masks(docs))
    told = (F.max(F.coalesce((F.col(c) == 1).cast("long"), F.lit(0))).alias(f"_{c}") for c in ("quality", "toxic"))
    told = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("_of")).agg(*told)
    known = rows.where("_id is not null").join(told, F.col("_id") == F.col("_of"), "left").drop("_of").na.fill(0, ["_quality", "_toxic"])
    unknown = rows.where("_id is null").withColumns({"_quality": F.lit(0).cast("long"), "_toxic": F.lit(0).cast("long")})
    kinds = ["part", "mask", "_quality", "_toxic"]
    same_id = known.groupBy("digest", "_id").agg(F.collect_list(F.struct(*kinds, "n")).alias("of_id"))
    first = same_id.groupBy("digest").agg(F.min_by("of_id", "_id").alias("of_id")).select(F.explode("of_id").alias("x")).select("x.*")
    # All that have an id count as copies, then each text's first as none.
    copies = lambda df, n: df.select(*kinds[:1], (F.col("mask").bitwiseOR(_COPY)).alias("mask"), *kinds[2:], n.alias("n"))
    signed = (
        copies(known, F.col("n"))
        .unionByName(copies(first, -F.col("n")))
        .unionByName(first.select(*kinds, "n"))
        .unionByName(unknown.select(*kinds, "n"))
    )
    of_label = lambda c: F.sum(F.col("n") * F.col(c))
    return signed.groupBy("part", "mask").agg(F.sum("n").alias("n"), of_label("_quality").alias("good"), of_label("_toxic").alias("toxic"))


def order_intervals(filters: str = FILTERS) -> list[tuple[int, int, int, int]]:
    """``(mask, step, low, high)``: in the orders of ranks low to high - 1 a
    document of that mask is removed at that step (from 0)."""
    k, found = len(filters), []
    for step in range(k):
        for beginning in permutations(range(k), step + 1):
            low, left = 0, list(range(k))
            for i, letter in enumerate(beginning):
                low += left.index(letter) * factorial(k - 1 - i)
                left.remove(letter)
            others = [i for i in range(k) if i not in beginning]
            for some in range(1 << len(others)):
                mask = 1 << beginning[-1] | sum(1 << x for i, x in enumerate(others) if some >> i & 1)
                found.append((mask, step, low, low + factorial(k - 1 - step)))
    return found


def removals(counts: np.ndarray, filters: str = FILTERS) -> np.ndarray:
    """``counts[mask]`` (of any trailing shape) as removals ``[step, rank]``."""
    k = len(filters)
    change = np.zeros((k, factorial(k) + 1, *counts.shape[1:]), np.int64)
    mask, step, low, high = np.array(order_intervals(filters)).T
    np.add.at(change, (step, low), counts[mask])
    np.subtract.at(change, (step, high), counts[mask])
    return change.cumsum(axis=1)[:, :-1]


def audit_rows(counts: np.ndarray, filters: str = FILTERS) -> pd.DataFrame:
    """The audit of one part from ``counts[mask, (all, good, toxic)]``."""
    k = len(filters)
    orders = np.array(list(permutations(range(k))))
    gone = removals(counts, filters)
    letter = orders.T  # [step, rank]
    of_mask = np.arange(1 << k)
    failing = np.array([counts[of_mask >> i & 1 == 1, 0].sum() for i in range(k)])
    only = np.array([counts[1 << i, 0] for i in range(k)])
    shapley = np.array([gone[..., 0][letter == i].sum() for i in range(k)])
    columns = {
        "filter_order": np.broadcast_to(np.array(["".join(filters[i] for i in order) for order in orders]), letter.shape),
        "step": np.broadcast_to(np.arange(1, k + 1)[:, None], letter.shape),
        "kept": counts[:, 0].sum() - gone[..., 0].cumsum(axis=0),
        "removed": gone[..., 0],
        "redundant": failing[letter] - gone[..., 0],
        "unique_fails": only[letter],
        "good_lost": gone[..., 1],
        "toxic_lost": gone[..., 2],
        "shapley": shapley[letter],
    }
    return pd.DataFrame({name: values.ravel() for name, values in columns.items()})


_AUDIT = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the five filters and step: how many documents
    the step's filter keeps and removes, of those it fails how many were removed
    earlier or fail nothing else, how many good and toxic ones it takes, and its
    removals summed over all orders and steps."""
    counts = mask_counts(docs, labels)
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("mask", *_COUNTS)).alias("counts"))

    def audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                table = np.zeros((1 << len(FILTERS), len(_COUNTS)), np.int64)
                for row in found:
                    table[row["mask"]] = [row[c] for c in _COUNTS]
                rows = audit_rows(table)
                rows.insert(0, "part", part)
                yield pa.RecordBatch.from_pandas(rows.astype({"step": "int32"}), preserve_index=False)

    return parts.mapInArrow(audit, _AUDIT)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


OP11_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
firsts AS (SELECT coalesce(text, '') AS t, min(doc_id) AS first_id FROM documents GROUP BY 1),
told AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS q, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS x FROM labels GROUP BY doc_id),
judged AS (
  SELECT part, coalesce(q, 0) AS q, coalesce(x, 0) AS x,
    CASE WHEN len(w) < 200 THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
    || CASE WHEN 100 * (length(words.t) - length(regexp_replace(words.t, '[A-Z]', '', 'g'))) > 2 * length(words.t) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(words.t, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN words.doc_id > first_id THEN 'E' ELSE '' END AS fails
  FROM words JOIN firsts USING (t) LEFT JOIN told ON words.doc_id = told.doc_id
),
counts AS (SELECT part, fails, count(*) AS n, sum(q) AS good, sum(x) AS toxic FROM judged GROUP BY part, fails),
orders(o) AS (
  SELECT ''
  UNION ALL
  SELECT o || f FROM orders, (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) AS letters(f) WHERE length(o) < 5 AND NOT contains(o, f)
),
steps AS (
  SELECT o, s::INTEGER AS step, substring(o, s, 1) AS f, substring(o, 1, s - 1) AS earlier
  FROM orders, range(1, 6) AS r(s) WHERE length(o) = 5
),
results AS (
  SELECT part, o, step, f,
    sum(n) - sum(CASE WHEN translate(fails, earlier || f, '') <> fails THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN contains(fails, f) AND translate(fails, earlier, '') = fails THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN contains(fails, f) AND translate(fails, earlier, '') <> fails THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN fails = f THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN contains(fails, f) AND translate(fails, earlier, '') = fails THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN contains(fails, f) AND translate(fails, earlier, '') = fails THEN toxic ELSE 0 END) AS toxic_lost
  FROM counts, steps GROUP BY part, o, step, f
)
SELECT part, o AS filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
  unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM results
"""
