"""Words of whole texts as 64-bit hashes, computed over Arrow batches.

A batch's texts lie in one byte buffer; words, their bounds and a polynomial
hash of each come from a few array passes over it, in pieces of ``PIECE`` bytes
cut between words, so memory does not grow with the batch or the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
_M = np.uint64(0x9E3779B97F4A7C15)
_M_INVERSE = np.uint64(pow(int(_M), -1, 2**64))


def mix64(x: np.ndarray) -> np.ndarray:
    """A well spread 64-bit hash of 64-bit values."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def random64(n: int, seed: int) -> np.ndarray:
    """n fixed values that any process computes alike."""
    with np.errstate(over="ignore"):
        return mix64(np.arange(1, n + 1, dtype=np.uint64) * _M + np.uint64(seed))


def powers(n: int, inverse: bool = False, _kept: dict = {}) -> np.ndarray:  # noqa: B006 - one table a process
    table = _kept.get(inverse)
    if table is None or len(table) < n:
        # As long as the texts need: the driver, which reads short ones, holds little.
        table = np.full(max(n, min(PIECE, 1 << max(12, n.bit_length()))), _M_INVERSE if inverse else _M, dtype=np.uint64)
        table[0] = 1
        with np.errstate(over="ignore"):
            np.multiply.accumulate(table, out=table)
        _kept[inverse] = table
    return table[:n]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and each text's bounds in them; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)), bounds


@dataclass(frozen=True)
class WordHasher:
    """``is_word``: 256 flags, by byte after A-Z are lower-cased."""

    is_word: np.ndarray
    codes: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        flags = self.is_word.copy()
        codes = random64(256, 7)
        flags[65:91], codes[65:91] = flags[97:123], codes[97:123]
        codes[~flags] = 0
        object.__setattr__(self, "is_word", flags)
        object.__setattr__(self, "codes", codes)

    def _pieces(self, data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(text numbers, bounds) of pieces; a longer text is cut before a word."""
        texts, cuts, size = [], [int(bounds[0])], 0
        for i in range(len(bounds) - 1):
            lo, hi = int(bounds[i]), int(bounds[i + 1])
            while hi - lo > PIECE:
                gaps = np.flatnonzero(~self.is_word[data[lo + 1 : lo + PIECE]])
                end = lo + 2 + int(gaps[-1]) if len(gaps) else None
                if end is None:  # a word longer than a piece
                    gap = np.flatnonzero(~self.is_word[data[lo + PIECE : hi]])
                    end = lo + PIECE + 1 + int(gap[0]) if len(gap) else hi
                if texts:
                    yield np.array(texts), np.array(cuts)
                yield np.array([i]), np.array([lo, end])
                texts, cuts, size, lo = [], [end], 0, end
            if size and size + hi - lo > PIECE:
                yield np.array(texts), np.array(cuts)
                texts, cuts, size = [], [lo], 0
            texts.append(i)
            cuts.append(hi)
            size += hi - lo
        if texts:
            yield np.array(texts), np.array(cuts)

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all words of the column in order, and bounds: the words of
        text i are ``hashes[bounds[i]:bounds[i + 1]]``."""
        data, bounds = text_bytes(column)
        counts, found = np.zeros(len(bounds), np.int64), []
        for texts, cuts in self._pieces(data, bounds):
            hashes, of = self._hash(data, cuts)
            np.add.at(counts, texts[of] + 1, 1)
            found.append(hashes)
        return (np.concatenate(found) if found else np.empty(0, np.uint64)), np.cumsum(counts)

    def _hash(self, data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        base = int(cuts[0])
        part, inner = data[base : cuts[-1]], cuts[1:-1] - base
        n = len(part)
        word = np.zeros(n + 2, bool)
        word[1:-1] = self.is_word[part]
        edge = np.zeros(n + 1, bool)
        edge[inner] = True
        starts = np.flatnonzero(word[1:] & (~word[:-1] | edge))
        ends = np.flatnonzero(word[:-1] & (~word[1:] | edge))
        with np.errstate(over="ignore"):
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(self.codes[part] * powers(n), out=sums[1:])
            hashes = mix64((sums[ends] - sums[starts]) * powers(n, inverse=True)[starts])
        return hashes, np.searchsorted(cuts[1:] - base, starts, side="right")


def word_pieces(data: bytes, table: bytes | None = None, size: int = PIECE) -> Iterator[list[bytes]]:
    """The words of a text (UTF-8) between ASCII white space, some at a time;
    ``table`` replaces bytes first, as in ``bytes.translate``."""
    head: list[bytes] = []  # a word that the end of a piece cuts
    for start in range(0, len(data), size):
        piece = data[start : start + size] if len(data) > size else data
        if table is not None:
            piece = piece.translate(table)
        words = piece.split()
        if head and (not words or piece[:1].isspace()):
            yield [b"".join(head)]
            head = []
        if not words:
            continue
        cut = start + size < len(data) and not piece[-1:].isspace()
        if head:
            head.append(words[0])
            if cut and len(words) == 1:
                continue
            words[0] = b"".join(head)
            head = []
        if cut:
            head = [words.pop()]
        yield words
    if head:
        yield [b"".join(head)]


def _flags(separators: list[int]) -> np.ndarray:
    flags = np.ones(256, bool)
    flags[separators] = False
    return flags


#: Words between ASCII white space.
spaced = WordHasher(_flags([0x20, *range(0x09, 0x0E)]))
#: Words of letters, digits and non-ASCII characters.
plain = WordHasher(_flags([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of k consecutive words; of all words if there are fewer."""
    if len(words) == 0:
        return words
    k = min(k, len(words))
    with np.errstate(over="ignore"):
        total = np.zeros(len(words) - k + 1, np.uint64)
        for i in range(k):
            total = total * _M + words[i : len(words) - k + 1 + i]
    return np.unique(mix64(total + np.uint64(k)))
