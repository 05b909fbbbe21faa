"""Exact removal of repeated substrings, by suffix arrays.

A byte goes if some 100-byte string that covers it also starts earlier (in a
document of smaller id, or earlier in the same one).

1. Equal texts: only the first is searched; a copy of 100 bytes or more goes whole.
2. Every 100-byte window has an anchor: the 32-byte substring with the smallest
   hash in it, the leftmost of equals.  Neighbouring windows with one anchor
   form a piece.  Equal windows have equal anchors, whatever surrounds them.
3. Pieces are spread by anchor.  Equal pieces (by hash) repeat the first of
   them.  What is left are anchors with several different pieces, as at the
   ends of a repeated passage.
4. The bytes of those pieces are fetched and, by anchor, sorted into suffix
   arrays (two-stage sorting); adjacent common prefixes of 100 bytes are equal
   windows, and all but the earliest repeat.
5. A document's repeating windows become byte ranges; what they leave is hashed.

Anchors with more than ``HOT_PIECES`` different pieces do not fit one task's
suffix array; their windows are compared by 128-bit digest, pre-aggregated
before the shuffle, with the same result.  Within an Arrow batch, repeats of
one piece are recognised before anything is shuffled, so a line that a third of
all documents share reaches its task once a batch.

Defined cases: a null text is empty; rows equal in doc_id and text are one
document and get equal results each; texts that share a doc_id follow each
other by MD5; a null doc_id comes first; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut_lineage, keyed, read_table, unkeyed
from .suffixes import adjacent_prefixes, eights, joined, suffix_array
from .words import mix64, powers, random64, text_bytes

LENGTH = 100
ANCHOR = 32
HOT_PIECES = 5_000
#: Bytes of pieces that one suffix array holds: its numpy arrays take some 150 bytes for each.
BATCH_BYTES = 1 << 20
_PIECE = 1 << 19
_EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def pieces(data: np.ndarray, bounds: np.ndarray, length: int = LENGTH, anchor: int = ANCHOR):
    """Pieces of all texts: (text number, first window, windows - 1, anchor hash, piece hash).

    Works through stretches of about ``_PIECE`` bytes; a longer text is cut
    into stretches that overlap by a window, which only splits pieces.
    """
    codes, wide = random64(256, 23), length - anchor + 1
    found = []

    def stretch(of: np.ndarray, cuts: np.ndarray) -> None:
        base, n = int(cuts[0]), int(cuts[-1] - cuts[0])
        starts = n - length + 1
        if starts <= 0:
            return
        ends = np.repeat(cuts[1:], np.diff(cuts))[:starts] - base
        valid = ends - np.arange(starts) >= length
        with np.errstate(over="ignore"):
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(codes[data[base : base + n]] * powers(n), out=sums[1:])
            back = powers(n, inverse=True)
            hashes = mix64((sums[anchor:] - sums[:-anchor]) * back[: n - anchor + 1])
        low = np.uint64((1 << 20) - 1)
        value = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
        # The smallest of `wide` neighbours: of a block's rest and the next block's start.
        padded = np.full(-(-len(value) // wide) * wide, np.iinfo(np.uint64).max, np.uint64)
        padded[: len(value)] = value
        blocks = padded.reshape(-1, wide)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        at = (np.minimum(behind[:starts], ahead[wide - 1 : wide - 1 + starts]) & low).astype(np.int64)
        where = np.flatnonzero(valid)
        if not len(where):
            return
        new = np.append(True, (at[where[1:]] != at[where[:-1]]) | (where[1:] != where[:-1] + 1))
        first = where[new]
        last = where[np.append(np.flatnonzero(new)[1:], len(where)) - 1]
        with np.errstate(over="ignore"):
            body = (sums[last + length] - sums[first]) * back[first]
            whole = mix64(body + mix64((last - first).astype(np.uint64)))
        text = np.searchsorted(cuts[1:] - base, first, side="right")
        found.append((of[text], first + base, last - first, hashes[at[first]], whole))

    texts, cuts = [], [int(bounds[0])]
    for i in range(len(bounds) - 1):
        lo, hi = int(bounds[i]), int(bounds[i + 1])
        if texts and hi - cuts[0] > _PIECE:
            stretch(np.array(texts), np.array(cuts))
            texts, cuts = [], [lo]
        while hi - lo > _PIECE:
            stretch(np.array([i]), np.array([lo, lo + _PIECE]))
            lo += _PIECE - length + 1
            cuts = [lo]
        texts.append(i)
        cuts.append(hi)
    if texts:
        stretch(np.array(texts), np.array(cuts))
    if not found:
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    of, first, more, key, whole = (np.concatenate(x) for x in zip(*found))
    return of, first - bounds[of], more, key, whole


def _place(first: np.ndarray, more: np.ndarray) -> np.ndarray:
    """First window and further windows in one number that sorts as they do."""
    return (first.astype(np.int64) << 7) | more.astype(np.int64)


_FIRST, _MORE = "shiftright(_at, 7)", "(_at & 127)"


def _all_pieces(texts: DataFrame) -> DataFrame:
    """``(anchor, piece, _id, _at, again)``; ``again``: an equal piece is earlier in the same batch."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = text_bytes(batch.column("_text"))
            of, first, more, anchor, piece = pieces(data, bounds)
            ids = batch.column("_id").to_numpy()[of]
            at = _place(first, more)
            order = np.lexsort((at, ids, piece, anchor))
            again = np.zeros(len(order), bool)
            again[order[1:]] = (anchor[order[1:]] == anchor[order[:-1]]) & (piece[order[1:]] == piece[order[:-1]])
            with np.errstate(over="ignore"):
                spread = mix64(at.astype(np.uint64) + mix64(ids.astype(np.uint64)))
            key = np.where(again, spread, anchor).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key), pa.array(piece.astype(np.int64)), pa.array(ids), pa.array(at), pa.array(again)],
                names=["anchor", "piece", "_id", "_at", "again"],
            )

    return texts.select("_id", "_text").mapInArrow(cut, "anchor long, piece long, _id long, _at long, again boolean")


def repeated_windows(rows: list[tuple[int, int, bytes]], length: int = LENGTH) -> list[tuple[int, int]]:
    """Windows of pieces (document, place, bytes) that an earlier window of
    these pieces equals: (row number, window of the piece)."""
    text, starts = joined([r[2] for r in rows])
    key = eights(text)
    windows = np.array([len(r[2]) - length + 1 for r in rows])
    row = np.repeat(np.arange(len(rows)), windows)
    offset = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows)
    is_window, number = np.zeros(len(text), bool), np.zeros(len(text), np.int64)
    spots = starts[row] + offset
    is_window[spots] = True
    number[spots] = np.arange(len(row))
    order = suffix_array(text, key, length)
    order = order[is_window[order]]
    same = adjacent_prefixes(key, order, length) >= length
    if not same.any():
        return []
    # Earliest first: pieces in document order, then the window's place.
    ids = np.array([r[0] for r in rows])
    at = np.array([r[1] for r in rows]) & ~np.int64(127)
    age = np.empty(len(row), np.int64)
    age[np.lexsort((at[row] + (offset.astype(np.int64) << 7), ids[row]))] = np.arange(len(row))
    group = np.concatenate([[0], np.cumsum(~same)])
    ages = age[number[order]]
    least = np.minimum.reduceat(ages, np.flatnonzero(np.append(True, ~same)))
    late = number[order[ages > least[group]]]
    return list(zip(row[late].tolist(), offset[late].tolist()))


def _by_suffix_array(fetched: DataFrame) -> DataFrame:
    """``(_id, lo, hi)``: repeating windows (first, last) of pieces (anchor, _id, _at, bytes)."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, anchors, size = [], [], 0

        def found(upto: int) -> pa.RecordBatch:
            part = rows[:upto]
            hits = sorted(repeated_windows(part))
            ids, lo, hi = [], [], []
            for r, w in hits:
                place = part[r][1] >> 7
                ids.append(part[r][0])
                if len(lo) and hi[-1] == place + w - 1 and ids[-2] == ids[-1]:
                    hi[-1] = place + w
                    ids.pop()
                else:
                    lo.append(place + w)
                    hi.append(place + w)
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (ids, lo, hi)], names=["_id", "lo", "hi"])

        for batch in batches:
            for anchor, doc, at, body in zip(*(batch.column(c).to_pylist() for c in ("anchor", "_id", "_at", "body"))):
                if size > BATCH_BYTES and anchor != anchors[-1]:
                    yield found(len(rows))
                    rows.clear()
                    anchors.clear()
                    size = 0
                rows.append((doc, at, body))
                anchors.append(anchor)
                size += len(body)
        if rows:
            yield found(len(rows))

    spread = fetched.repartition("anchor").sortWithinPartitions("anchor")
    return spread.mapInArrow(search, "_id long, lo long, hi long")


def _by_digest(fetched: DataFrame) -> DataFrame:
    """The same for anchors with too many pieces for one task: windows as rows."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, at, body in zip(*(batch.column(c).to_pylist() for c in ("_id", "_at", "body"))):
                n, first = len(body) - LENGTH + 1, at >> 7
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([hashlib.blake2b(body[i : i + LENGTH], digest_size=16).digest() for i in range(n)], pa.binary()),
                        pa.array([doc] * n, pa.int64()),
                        pa.array(range(first, first + n), pa.int64()),
                    ],
                    names=["w", "_id", "lo"],
                )

    rows = fetched.mapInArrow(windows, "w binary, _id long, lo long")
    least = rows.groupBy("w").agg(F.min(F.struct("_id", "lo")).alias("least"))
    late = rows.join(least, "w").where(F.struct("_id", "lo") > F.col("least"))
    return late.select("_id", "lo", F.col("lo").alias("hi"))


def _by_text(per_doc: DataFrame, firsts: DataFrame) -> DataFrame:
    """Rows of a document number by the digest of its text: texts are dealt out by
    that already, so what is found goes to the texts and these stay where they are."""
    return firsts.select(F.col("first").alias("_id"), "_md5").join(per_doc, "_id").drop("_id")


def _fetch(texts: DataFrame, firsts: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes of pieces (anchor, _id, _at)."""
    per_doc = wanted.groupBy("_id").agg(F.collect_list(F.struct("anchor", "_at")).alias("own"))
    rows = texts.join(_by_text(per_doc, firsts), "_md5").select("_id", "_text", "own")

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = text_bytes(batch.column("_text"))
            for i, doc in enumerate(batch.column("_id").to_pylist()):
                body, own = data[bounds[i] : bounds[i + 1]].tobytes(), batch.column("own")[i].as_py()
                spans = [(x["_at"] >> 7, x["_at"] & 127) for x in own]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([x["anchor"] for x in own], pa.int64()),
                        pa.array([doc] * len(own), pa.int64()),
                        pa.array([x["_at"] for x in own], pa.int64()),
                        pa.array([body[p : p + more + LENGTH] for p, more in spans], pa.binary()),
                    ],
                    names=["anchor", "_id", "_at", "body"],
                )

    return rows.mapInArrow(fetch, "anchor long, _id long, _at long, body binary")


def _without(texts: DataFrame, firsts: DataFrame, ranges: DataFrame) -> DataFrame:
    """Each text's repeating windows (lo, hi) as removed byte ranges: n_bytes, n_removed, n_spans, kept_sha256, kept."""
    per_doc = ranges.groupBy("_id").agg(F.collect_list("lo").alias("lo"), F.collect_list("hi").alias("hi"))
    rows = texts.join(_by_text(per_doc, firsts), "_md5", "left").select("_id", "_text", "lo", "hi")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = text_bytes(batch.column("_text"))
            out = []
            for i in range(len(batch)):
                body = data[bounds[i] : bounds[i + 1]]
                lo = batch.column("lo")[i].values
                if lo is None:
                    out.append((len(body), 0, 0, hashlib.sha256(body.tobytes()).hexdigest()))
                    continue
                edge = np.zeros(len(body) + 1, np.int64)
                np.add.at(edge, lo.to_numpy(), 1)
                np.add.at(edge, batch.column("hi")[i].values.to_numpy() + LENGTH, -1)
                gone = np.cumsum(edge[:-1]) > 0
                spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                out.append((len(body), int(gone.sum()), spans, hashlib.sha256(body[~gone].tobytes()).hexdigest()))
            sizes = [pa.array([o[c] for o in out], pa.int64()) for c in range(3)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), *sizes, pa.array([o[3] for o in out], pa.string())],
                names=["_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    return rows.mapInArrow(remove, "_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def repeated_substrings(docs: DataFrame, hot_pieces: int = HOT_PIECES) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    rows = keyed(docs).select("_id", F.coalesce("_text", F.lit("")).alias("_text"))
    rows = rows.withColumn("_md5", F.unhex(F.md5(F.encode("_text", "utf-8"))))
    digests = cut_lineage(rows.select("_id", "_md5", F.octet_length("_text").alias("_n")))
    # Documents in order: a number that grows with (doc_id, text digest).
    ordered = digests.select("_id", "_md5").distinct().repartitionByRange("_id", "_md5").sortWithinPartitions("_id", "_md5")
    numbered = cut_lineage(ordered.withColumn("_doc", F.monotonically_increasing_id()))
    firsts = numbered.groupBy("_md5").agg(F.min("_doc").alias("first"))
    texts = rows.groupBy("_md5").agg(F.any_value("_text").alias("_text")).join(firsts, "_md5")
    texts = texts.select("_md5", F.col("first").alias("_id"), "_text")

    by_anchor = Window.partitionBy("anchor")
    prior = F.lag("piece").over(by_anchor.orderBy("piece", "_id", "_at"))
    marked = (
        _all_pieces(texts)
        .withColumn("_prior", prior)
        .withColumn("new", ~F.col("again") & (F.col("_prior").isNull() | (F.col("_prior") != F.col("piece"))))
        .withColumn("_kinds", F.sum(F.col("new").cast("long")).over(by_anchor))
    )
    # Written once: what repeats whole, and what must be compared further.
    marked = cut_lineage(marked.where("not new or _kinds > 1").drop("_prior", "piece", "again"))
    whole = marked.where("not new").select("_id", F.expr(_FIRST).alias("lo"), F.expr(f"{_FIRST} + {_MORE}").alias("hi"))
    open_pieces = marked.where("new").select("anchor", "_id", "_at", (F.col("_kinds") > hot_pieces).alias("hot"))
    ranges = whole.unionByName(_by_suffix_array(_fetch(texts, firsts, open_pieces.where("not hot"))))
    if not open_pieces.where("hot").isEmpty():
        ranges = ranges.unionByName(_by_digest(_fetch(texts, firsts, open_pieces.where("hot"))))
    result = _without(texts, firsts, ranges).withColumnRenamed("_id", "_fid")

    all_rows = digests.join(numbered, ["_id", "_md5"]).join(firsts, "_md5").join(result, F.col("first") == F.col("_fid"))
    copy = (F.col("_doc") != F.col("first")) & (F.col("_n") >= LENGTH)
    return all_rows.select(
        unkeyed(F.col("_id")).alias("doc_id"),
        "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(copy, 1).otherwise(F.col("n_spans")).cast("long").alias("n_spans"),
        F.when(copy, F.lit(_EMPTY_SHA)).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
    )


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_substrings(read_table(spark, sf_dir, "documents"))


#: Windows as slices of the bytes' hex digits.
OP6_SQL = f"""
WITH bytes AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
wins AS (
  SELECT doc_id, unnest(range(0, greatest(0, len(h) // 2 - {LENGTH} + 1))) AS p,
         unnest(list_transform(range(0, greatest(0, len(h) // 2 - {LENGTH} + 1)), lambda p: md5(substr(h, 2 * p + 1, {2 * LENGTH})))) AS g
  FROM bytes
),
late AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY g ORDER BY doc_id, p) AS k FROM wins) WHERE k > 1
),
ends AS (
  SELECT doc_id, p, max(p) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM late
),
runs AS (
  SELECT doc_id, p, sum(CASE WHEN before IS NULL OR p > before + {LENGTH} THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM ends
),
spans AS (SELECT doc_id, run, min(p) AS lo, max(p) + {LENGTH} AS hi FROM runs GROUP BY doc_id, run),
cuts AS (SELECT doc_id, list(lo ORDER BY lo) AS lo, list(hi ORDER BY lo) AS hi, sum(hi - lo)::BIGINT AS gone FROM spans GROUP BY doc_id)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(gone, 0) AS n_removed, coalesce(len(lo), 0)::BIGINT AS n_spans,
       sha256(unhex(CASE WHEN lo IS NULL THEN h ELSE array_to_string(list_transform(range(0, len(lo) + 1),
         lambda i: substr(h, 2 * (CASE WHEN i = 0 THEN 0 ELSE hi[i] END) + 1,
                          2 * ((CASE WHEN i = len(lo) THEN len(h) // 2 ELSE lo[i + 1] END) - (CASE WHEN i = 0 THEN 0 ELSE hi[i] END)))), '') END)) AS kept_sha256
FROM bytes LEFT JOIN cuts USING (doc_id)
"""
