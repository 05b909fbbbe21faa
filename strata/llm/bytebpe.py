"""Byte-level BPE encoding and decoding with a rank queue.

A text is cut into pre-tokens by a pattern; each is merged by itself, always the
neighbours whose joined bytes have the lowest rank, the leftmost of equals.

The queue (:class:`RankQueue`) has one bucket for each rank, a heap of the
places at which a pair of that rank starts, and a bitmap of three levels of
64-bit words that tells which buckets hold anything: the lowest rank is three
find-first-set steps away.  The parts of the pre-tokens are a linked list over
their bytes.  A merge removes the right part and gives two pairs new ranks; their
old entries stay in the queue and are passed over when they come up, since a
place remembers its pair's rank of now.  So n bytes take O(n log n) steps and
about 100 n bytes of memory, however long a pre-token is.  Short pre-tokens share
one queue, some thousands at a time: no pair crosses their bounds, so each is
merged as if alone.

The rank file (tiktoken's format) is read on the driver and broadcast: a
vocabulary, whose size does not depend on the data.  Texts are cut with the
``regex`` module; code points newer than this Python's Unicode tables are
classed as the installed tiktoken classes them, so both cut alike.  A worker
keeps the ids of the short pre-tokens it met last, ``CACHE`` to twice as many.

Defined cases: a null text is empty and has no ids; a null list of ids decodes
to no bytes; an id outside the vocabulary raises; repeated rows each get their
row; an empty table gives no rows.  Texts are taken in slices of about ``SLICE``
pre-tokens.
"""

from __future__ import annotations

import base64
import hashlib
import sys
import unicodedata
from array import array
from collections.abc import Callable, Iterator
from heapq import heappop, heappush
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table
from .words import PIECE

CACHE = 400_000
SLICE = 1 << 17
_PIECES = 1 << 14


class RankQueue:
    """Places by rank; ``lowest`` is the first rank that has any."""

    def __init__(self, n_ranks: int):
        self.buckets: dict[int, list[int]] = {}
        words = (n_ranks >> 6) + 1
        self.low, self.middle, self.top = [0] * words, [0] * ((words >> 6) + 1), 0

    def fill(self, rank: int, places: list[int]) -> None:
        """A rank's first places, in ascending order (which is a heap)."""
        self.buckets[rank] = places
        self.low[rank >> 6] |= 1 << (rank & 63)
        self.middle[rank >> 12] |= 1 << (rank >> 6 & 63)
        self.top |= 1 << (rank >> 12)

    def push(self, rank: int, place: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is None:
            self.fill(rank, [place])
        else:
            heappush(bucket, place)

    def lowest(self) -> int | None:
        if not self.top:
            return None
        first = (self.top & -self.top).bit_length() - 1
        word = self.middle[first]
        second = first << 6 | (word & -word).bit_length() - 1
        word = self.low[second]
        return second << 6 | (word & -word).bit_length() - 1

    def drop(self, rank: int) -> None:
        """A rank whose bucket is empty."""
        del self.buckets[rank]
        second, first = rank >> 6, rank >> 12
        self.low[second] ^= 1 << (rank & 63)
        if not self.low[second]:
            self.middle[first] ^= 1 << (second & 63)
            if not self.middle[first]:
                self.top ^= 1 << first


class Vocabulary:
    """Ranks of byte strings; a rank is the id."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.size = max(ranks.values(), default=-1) + 1
        self.longest = max(map(len, ranks), default=0)
        self.pieces = [b""] * self.size
        self.of_byte, self.of_pair = np.full(256, -1, np.int32), np.full(1 << 16, -1, np.int32)
        for piece, rank in ranks.items():
            self.pieces[rank] = piece
            if len(piece) == 1:
                self.of_byte[piece[0]] = rank
            elif len(piece) == 2:
                self.of_pair[piece[0] << 8 | piece[1]] = rank
        self._kept: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}

    @classmethod
    def read(cls, lines: bytes) -> Vocabulary:
        """From the bytes of a rank file: a base64 string and a rank a line."""
        return cls({base64.b64decode(a): int(b) for a, b in (line.split() for line in lines.splitlines() if line.strip())})

    def merge(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of pre-tokens (not empty), which share one queue."""
        # One place a byte, and one after each pre-token, which ends it.
        data = b"\0".join(pieces) + b"\0"
        ends = np.cumsum([len(piece) + 1 for piece in pieces]) - 1
        codes = np.frombuffer(data, np.uint8)
        n = len(codes)
        ids = self.of_byte[codes]
        pair = np.full(n, -1, np.int32)
        pair[:-1] = self.of_pair[codes[:-1].astype(np.int32) << 8 | codes[1:]]
        follows, before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
        ids[ends] = pair[ends] = pair[ends - 1] = -1
        follows[ends] = 0
        before[0] = before[ends[:-1] + 1] = -1
        queue = RankQueue(self.size)
        places = np.flatnonzero(pair >= 0)
        places = places[np.argsort(pair[places], kind="stable")]
        ranked = pair[places]
        cuts = np.flatnonzero(np.diff(ranked, prepend=-1)).tolist()
        for lo, hi in zip(cuts, [*cuts[1:], len(places)]):
            queue.fill(int(ranked[lo]), places[lo:hi].tolist())
        # Lists are faster, arrays smaller.
        hold = np.ndarray.tolist if n <= PIECE else lambda x: array("i", x.tobytes())
        found = hold(ids)
        self._run(data, queue, found, hold(pair), hold(follows), hold(before))
        found = np.array(found, np.int32)
        alive = found >= 0
        return np.split(found[alive], np.cumsum(alive)[ends[:-1]])

    def _run(self, data: bytes, queue: RankQueue, ids, pair, follows, before) -> None:
        """Merges until no pair has a rank.  ``ids`` has the id of the part that starts
        at a place, or -1; ``pair`` the rank of that part and the next, as it is now.
        What follows the place after a pre-token is 0."""
        get, buckets, fill, lowest = self.ranks.get, queue.buckets, queue.fill, queue.lowest
        while (rank := lowest()) is not None:
            bucket, least = buckets[rank], rank
            while bucket:
                i = heappop(bucket)
                if pair[i] != rank:
                    continue  # stale: merged away, or its neighbour changed
                gone = follows[i]
                after = follows[i] = follows[gone]
                ids[i], ids[gone], pair[gone] = rank, -1, -1
                new = -1
                if end := follows[after]:
                    before[after] = i
                    new = get(data[i:end], -1)
                    if new >= 0:
                        if new < least:
                            least = new
                        if (other := buckets.get(new)) is None:
                            fill(new, [i])
                        else:
                            heappush(other, i)
                pair[i] = new
                left = before[i]
                if left >= 0:
                    new = pair[left] = get(data[left:after], -1)
                    if new >= 0:
                        if new < least:
                            least = new
                        if (other := buckets.get(new)) is None:
                            fill(new, [left])
                        else:
                            heappush(other, left)
                if least < rank:
                    break  # a lower rank came up
            if not bucket:
                queue.drop(rank)

    def encode(self, texts: list[list[str]]) -> list[bytes]:
        """Ids (int32) of each list of pre-tokens, one after the other."""
        kept, older = self._kept, self._older
        found: dict[str, bytes] = {}
        new = {}
        for piece in set(chain.from_iterable(texts)):
            ids = kept.get(piece)
            if ids is None:
                ids = older.get(piece)
                if ids is None:
                    whole = self.ranks.get(data := piece.encode())
                    if whole is None:
                        new[piece] = data
                        continue
                    ids = whole.to_bytes(4, sys.byteorder)
                if len(piece) <= 32:
                    kept[piece] = ids
            found[piece] = ids
        if new:
            for piece, ids in zip(new, self.merge(list(new.values()))):
                found[piece] = ids = ids.tobytes()
                if len(piece) <= 32:
                    kept[piece] = ids
        if len(kept) >= CACHE:
            self._kept, self._older = {}, kept
        return [b"".join([found[piece] for piece in pieces]) for pieces in texts]

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join([self.pieces[i] for i in ids.tolist()])


def new_code_points(text: str, kind: Callable[[str], str]) -> dict[int, str]:
    """Stand-ins for the code points that this Python's Unicode tables lack."""
    if text.isascii():
        return {}
    return {ord(c): kind(c) for c in set(text) if c >= "Ͱ" and unicodedata.category(c) == "Cn"}


def code_point_kind(char: str, _kept: dict[str, str] = {}) -> str:  # noqa: B006 - one table a process
    """A letter, digit or sign that tiktoken's patterns treat like ``char``."""
    if char not in _kept:
        import tiktoken

        tries = {n: (like + char) for n, like in enumerate("a1")}
        ranks = {bytes([i]): i for i in range(256)} | {t.encode(): 256 + n for n, t in tries.items()}
        probe = tiktoken.Encoding("kinds", pat_str=r"\p{L}+|\p{N}+|[^\p{L}\p{N}]+", mergeable_ranks=ranks, special_tokens={})
        _kept[char] = next((t[0] for t in tries.values() if len(probe.encode_ordinary(t)) == 1), "!")
    return _kept[char]


class Splitter:
    def __init__(self, pattern: str):
        import regex

        compiled = regex.compile(pattern)
        self.find, self.find_all = compiled.finditer, compiled.findall

    def __call__(self, text: str) -> Iterator[list[str]]:
        """The text's pre-tokens in order, some thousands at a time."""
        stand_ins = new_code_points(text, code_point_kind)
        if not stand_ins and len(text) <= PIECE:
            yield self.find_all(text)
            return
        if stand_ins:
            found = (text[m.start() : m.end()] for m in self.find(text.translate(stand_ins)))
        else:
            found = (m.group() for m in self.find(text))
        while part := list(islice(found, _PIECES)):
            yield part


def _vocabulary(shared: _Shared, _kept: dict = {}) -> Vocabulary:  # noqa: B006 - one a process
    if shared.id not in _kept:
        _kept.clear()
        _kept[shared.id] = Vocabulary.read(shared.value)
    return _kept[shared.id]


class _Shared:
    """A broadcast rank file with a key that tells one from another in a worker."""

    def __init__(self, spark: SparkSession, rank_file: str):
        with open(rank_file, "rb") as file:
            lines = file.read()
        self.id, self._lines = hashlib.sha256(lines).hexdigest(), spark.sparkContext.broadcast(lines)

    @property
    def value(self) -> bytes:
        return self._lines.value


def encode_texts(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, ids array<int>)``: the ids of every row's whole text."""
    shared = _Shared(docs.sparkSession, rank_file)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, split = _vocabulary(shared), Splitter(pattern)
        for batch in batches:
            for first, texts in _some(batch.column(1), split):
                ids = vocabulary.encode([pieces for _, pieces in texts])
                sizes = np.zeros(texts[-1][0] + 2 - first, np.int64)
                np.add.at(sizes, [row + 1 - first for row, _ in texts], [len(x) // 4 for x in ids])
                yield _lists(batch.column(0).slice(first, len(sizes) - 1), b"".join(ids), np.cumsum(sizes))

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(encode, "doc_id long, ids array<int>")


def _some(column: pa.Array, split: Splitter) -> Iterator[tuple[int, list[tuple[int, list[str]]]]]:
    """(first row, lists of pre-tokens by row) of consecutive texts with about
    ``SLICE`` pre-tokens; a longer text comes alone."""
    first, held, n = 0, [], 0
    for row, text in enumerate(column):
        if n >= SLICE:
            yield first, held
            first, held, n = row, [], 0
        held.append((row, []))
        for pieces in split(text.as_py() or ""):
            held.append((row, pieces))
            n += len(pieces)
    if held:
        yield first, held


def _lists(keys: pa.Array, ids: bytes, bounds: np.ndarray) -> pa.RecordBatch:
    values = pa.array(np.frombuffer(ids, np.int32))
    return pa.RecordBatch.from_arrays([keys, pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), values)], names=["doc_id", "ids"])


def decode_ids(encoded: DataFrame, rank_file: str) -> DataFrame:
    """``encoded`` (doc_id, ids) with ``decoded``, the bytes that the ids stand for."""
    shared = _Shared(encoded.sparkSession, rank_file)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(shared)
        for batch in batches:
            ids = batch.column(1)
            for first in range(0, len(batch), 256):
                part = ids.slice(first, 256)
                texts = [vocabulary.decode(x.values.to_numpy(zero_copy_only=False)) if x.is_valid else b"" for x in part]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, 256), part, pa.array(texts, pa.binary())], names=["doc_id", "ids", "decoded"]
                )

    return encoded.select("doc_id", "ids").mapInArrow(decode, "doc_id long, ids array<int>, decoded binary")


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    rank_file = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = encode_texts(read_table(spark, sf_dir, "documents"), rank_file, public_tokenizers.PATTERN)
    return decode_ids(encoded, rank_file).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
