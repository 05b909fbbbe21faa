"""Benchmark leaks by a positional inverted index.

1. Corpus counts of the benchmark's words, over all documents.  A window (ten
   consecutive words of an item, or a whole shorter item) with a word that no
   document has cannot occur and is left out.
2. Of every other window the ``PROBES`` places with the rarest words are probes.
   The index stores, for the probes' words, each document's positions.
3. A posting meets the item places of its word: (document, item, offset).
   Offset-adjusted lists intersect where one offset gathers two probe places.
4. Such alignments are compared word by word with the item; runs of a whole
   window are hits.  Probe places within ``slop`` words of one offset count as
   proximity matches.

The benchmark is read in blocks of ``block_bytes`` (its measured size decides
how many), each block broadcast and run against all documents, so no broadcast
grows with it.  Nothing is keyed by word in a shuffle, so frequent words make no
hot task.

Defined cases: null texts and texts without words have no hits; items without
words or with a null id are ignored; rows of one item_id are one item with the
windows of all; rows equal in doc_id and text get equal results each; an empty
benchmark leaves every document clean.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import NO_ID, keyed, read_table, unkeyed
from .words import plain

WINDOW = 10
PROBES = 2
SLOP = 5
BLOCK_BYTES = 8 << 20


@dataclass(frozen=True)
class Block:
    """A bounded part of the benchmark: item ids, their words' hashes, all distinct words in order."""

    ids: list[str]
    words: list[np.ndarray]
    terms: np.ndarray

    @classmethod
    def of(cls, rows: list) -> Block:
        hashes, bounds = plain(pa.array([r[1] for r in rows], pa.string()))
        items = [(r[0], hashes[lo:hi]) for r, lo, hi in zip(rows, bounds[:-1], bounds[1:]) if hi > lo]
        return cls([i for i, _ in items], [w for _, w in items], np.unique(hashes))

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        """Term numbers; -1 for words that no item has."""
        if not len(self.terms):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        return np.where(self.terms[at] == hashes, at, -1)


def _blocks(items: DataFrame, block_bytes: int) -> Iterator[Block]:
    size = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    n = math.ceil(size / block_bytes)
    for b in range(n):
        part = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == b) if n > 1 else items
        yield Block.of(part.orderBy("id", "text").collect())


def _term_counts(texts: DataFrame, block) -> dict[int, int]:
    """How often every term of the block occurs in all documents (one row a task and term is shuffled)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Block(*block.value)
        total = np.zeros(len(own.terms), np.int64)
        for batch in batches:
            found = own.lookup(plain(batch.column("_text"))[0])
            total += np.bincount(found[found >= 0], minlength=len(total))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen])], names=["term", "n"])

    rows = texts.select("_text").mapInArrow(count, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    return {r.term: r.n for r in rows}


def _probes(block: Block, counts: dict[int, int], window: int) -> list[tuple[int, int, int]]:
    """(term, item, place) of the rarest words of every window that can occur."""
    found = set()
    for i, words in enumerate(block.words):
        terms = block.lookup(words).tolist()
        size = min(window, len(terms))
        for s in range(len(terms) - size + 1):
            places = sorted(range(s, s + size), key=lambda p: (counts.get(terms[p], 0), terms[p], p))
            if counts.get(terms[places[0]], 0):
                found.update((terms[p], i, p) for p in places[:PROBES])
    return sorted(found)


def posting_lists(texts: DataFrame, block, wanted: np.ndarray) -> DataFrame:
    """The index: ``(term, _id, _tie, at)``, the positions of each wanted term in each document."""

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_block = Block(*block.value)
        for batch in batches:
            words, bounds = plain(batch.column("_text"))
            terms = own_block.lookup(words)
            at = np.flatnonzero(wanted[terms] & (terms >= 0)) if len(wanted) else np.empty(0, np.int64)
            doc = np.searchsorted(bounds, at, side="right") - 1
            order = np.lexsort((at, terms[at], doc))
            at, doc = at[order], doc[order]
            key = np.stack([doc, terms[at]])
            first = np.flatnonzero(np.append(True, (key[:, 1:] != key[:, :-1]).any(axis=0))) if len(at) else at
            lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(at)), pa.int32()), pa.array(at - bounds[doc], pa.int32()))
            own = pa.array(doc[first])
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[1][first], pa.int32()), batch.column("_id").take(own), batch.column("_tie").take(own), lists],
                names=["term", "_id", "_tie", "at"],
            )

    return texts.mapInArrow(post, "term int, _id long, _tie long, at array<int>")


def _alignments(spark: SparkSession, texts: DataFrame, block, window: int, slop: int) -> DataFrame:
    """``(_id, _tie, item, near, offsets)``: offsets at which two probe places
    of an item meet, and whether two stand within ``slop`` of that."""
    own = Block(*block.value)
    probes = _probes(own, _term_counts(texts, block), window)
    wanted = np.zeros(max(1, len(own.terms)), bool)
    wanted[[t for t, _, _ in probes]] = True
    places = F.broadcast(spark.createDataFrame(probes, "term int, item int, place int"))
    need = spark.createDataFrame([(i, min(PROBES, window, len(w))) for i, w in enumerate(own.words)], "item int, need int")
    met = posting_lists(texts, block, wanted).join(places, "term").select("_id", "_tie", "item", "place", F.explode("at").alias("p"))
    by_offset = met.groupBy("_id", "_tie", "item", (F.col("p") - F.col("place")).alias("offset")).agg(
        F.min("place").alias("lo"), F.max("place").alias("hi")
    )
    by_offset = by_offset.join(F.broadcast(need), "item").withColumn("whole", (F.col("need") == 1) | (F.col("lo") < F.col("hi")))
    by_item = by_offset.groupBy("_id", "_tie", "item").agg(F.array_sort(F.collect_list(F.struct("offset", "lo", "hi", "whole"))).alias("o"))
    close = F.exists(
        F.sequence(F.lit(1), F.size("o") - 1),
        lambda i: (F.element_at("o", i + 1)["offset"] - F.element_at("o", i)["offset"] <= slop)
        & ((F.element_at("o", i + 1)["hi"] != F.element_at("o", i)["lo"]) | (F.element_at("o", i + 1)["lo"] != F.element_at("o", i)["hi"])),
    )
    exact = F.transform(F.filter("o", lambda x: x["whole"]), lambda x: x["offset"])
    return by_item.select(
        "_id", "_tie", "item", (F.exists("o", lambda x: x["whole"]) | ((F.size("o") > 1) & close)).alias("near"), exact.alias("offsets")
    )


def _confirm(texts: DataFrame, aligned: DataFrame, block, window: int) -> DataFrame:
    """Every row of ``texts``: number of words, hit ranges and hit items."""
    per_doc = aligned.groupBy("_id", "_tie").agg(
        F.collect_list(F.struct("item", "offsets")).alias("found"), F.sum(F.col("near").cast("long")).alias("n_near")
    )
    rows = texts.join(per_doc, ["_id", "_tie"], "left").select("_id", "_tie", "_text", "found", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"))

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Block(*block.value)
        for batch in batches:
            words, bounds = plain(batch.column("_text"))
            hits, ids = [], []
            for lo, hi, found in zip(bounds[:-1], bounds[1:], batch.column("found").to_pylist()):
                doc, places, named = words[lo:hi], [], set()
                for x in found or ():
                    item = items.words[x["item"]]
                    size = min(window, len(item))
                    for offset in x["offsets"]:
                        a, b = max(0, offset), min(len(doc), offset + len(item))
                        if b - a < size:
                            continue
                        same = np.concatenate([[0], np.cumsum(doc[a:b] == item[a - offset : b - offset])])
                        starts = a + np.flatnonzero(same[size:] - same[:-size] == size)
                        if len(starts):
                            named.add(items.ids[x["item"]])
                            places.append((starts[:, None] + np.arange(size)).ravel())
                hits.append(np.unique(np.concatenate(places)).tolist() if places else [])
                ids.append(sorted(named))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_tie"), pa.array(np.diff(bounds)), pa.array(hits, pa.list_(pa.int32())), pa.array(ids, pa.list_(pa.string())), batch.column("n_near")],
                names=["_id", "_tie", "n_words", "hits", "items", "n_near"],
            )

    return rows.mapInArrow(confirm, "_id long, _tie long, n_words long, hits array<int>, items array<string>, n_near long")


def leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int = SLOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``: ``_id``, ``_tie`` (a hash of the text),
    n_words, hits (places of hit words), items (ids of items with occurring
    windows) and n_near (items with a proximity match)."""
    spark = docs.sparkSession
    texts = keyed(docs).withColumn("_tie", F.xxhash64("_text"))
    items = benchmark.select(F.col("item_id").cast("string").alias("id"), F.col("text")).where("id is not null and text is not null")
    parts = []
    for own in _blocks(items, block_bytes):
        block = spark.sparkContext.broadcast((own.ids, own.words, own.terms))
        parts.append(_confirm(texts, _alignments(spark, texts, block, window, slop), block, window))
    if not parts:
        empty = spark.sparkContext.broadcast(([], [], np.empty(0, np.uint64)))
        nothing = spark.createDataFrame([], "_id long, _tie long, item int, near boolean, offsets array<int>")
        parts.append(_confirm(texts, nothing, empty, window))
    if len(parts) == 1:
        return parts[0]
    return (
        reduce(DataFrame.unionByName, [p.withColumn("_block", F.lit(i)) for i, p in enumerate(parts)])
        .groupBy("_id", "_tie", "_block")
        .agg(F.count("*").alias("_rows"), F.first("n_words").alias("n_words"), F.first("hits").alias("hits"), F.first("items").alias("items"), F.first("n_near").alias("n_near"))
        .groupBy("_id", "_tie")
        .agg(
            F.max("_rows").alias("_rows"),
            F.max("n_words").alias("n_words"),
            F.array_distinct(F.flatten(F.collect_list("hits"))).alias("hits"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
            F.sum("n_near").alias("n_near"),
        )
        .withColumn("_row", F.explode(F.expr("sequence(1L, _rows)")))
        .drop("_row", "_rows")
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a hit, with all their columns."""
    dirty = leaks(docs, benchmark).where(F.size("hits") > 0).select("_id", "_tie").distinct()
    same = (F.coalesce(docs["doc_id"].cast("long"), F.lit(NO_ID)) == F.col("_id")) & (F.xxhash64(docs["text"]) == F.col("_tie"))
    return docs.join(dirty, same, "left_anti")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select(
        unkeyed(F.col("_id")).alias("doc_id"),
        "n_words",
        F.size("hits").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


_SQL_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
OP8_SQL = f"""
WITH items AS (SELECT item_id::VARCHAR AS id, {_SQL_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
sized AS (SELECT id, w, least({WINDOW}, len(w)) AS k FROM items WHERE len(w) > 0),
wins AS (
  SELECT DISTINCT id, k, unnest(list_transform(range(1, len(w) - k + 2), lambda s: array_to_string(w[s:s + k - 1], ' '))) AS g FROM sized
),
docs AS (SELECT row_number() OVER () AS r, doc_id, {_SQL_WORDS} AS w FROM documents),
starts AS (
  SELECT r, k, unnest(range(1, len(w) - k + 2)) AS s,
         unnest(list_transform(range(1, len(w) - k + 2), lambda s: array_to_string(w[s:s + k - 1], ' '))) AS g
  FROM docs, (SELECT DISTINCT k FROM wins)
),
hits AS (SELECT r, s, k, id FROM starts JOIN wins USING (k, g)),
found AS (
  SELECT r, count(DISTINCT p) AS n_hit, list_sort(list(DISTINCT id)) AS ids
  FROM (SELECT r, id, unnest(range(s, s + k)) AS p FROM hits) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(len(ids), 0)::BIGINT AS n_items,
       sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN found USING (r)
"""
