"""Edit-aware token counts.

A text's pre-tokens (the pieces that a byte-pair tokenizer merges within) are
kept as the leaves of a segment tree: blocks of ``BLOCK`` pre-tokens, above them
the sums of characters and tokens of ever larger groups.  An edit finds its
place by character sums, splits text into pre-tokens again only from a safe
boundary before it until the boundaries agree with the old ones, encodes the
pre-tokens that are new, and updates the sums above the blocks it touched.

The tokenizer is a rank file in tiktoken's format and its split pattern; their
place is a parameter and must be readable by every executor.  Nothing is
trained.  A pre-token's count is cached, up to ``CACHE`` of them a worker.

Defined cases: a null text is empty (0 tokens, 0 pre-tokens); edits are applied
from the last to the first place in the old text and must not overlap; places
beyond the end are the end; a null list of edits is none; repeated rows each get
their row; an empty table gives no rows.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table

BLOCK = 64
CACHE = 200_000
RANK_FILE = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the split pattern that goes with the rank file.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def token_counter(rank_file: str, pattern: str, _kept: dict = {}) -> tuple[Callable[[str], int], object]:  # noqa: B006
    """(tokens of a pre-token, compiled split pattern), made once a process."""
    if (rank_file, pattern) not in _kept:
        import regex
        import tiktoken

        with open(rank_file, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        cache: dict[str, int] = {}

        def count(piece: str) -> int:
            n = cache.get(piece)
            if n is None:
                if len(cache) >= CACHE:
                    cache.clear()
                n = len(encoding.encode_ordinary(piece))
                if len(piece) <= 64:
                    cache[piece] = n
            return n

        _kept[rank_file, pattern] = count, regex.compile(pattern)
    return _kept[rank_file, pattern]


class TokenTree:
    """A text, its pre-tokens in blocks, and sums of characters and tokens over them."""

    def __init__(self, text: str, count: Callable[[str], int], split):
        self.text, self.count, self.split, self.encoded = text, count, split, 0
        sizes, tokens = self._cut(split.findall(text))
        self.blocks = [(sizes[i : i + BLOCK], tokens[i : i + BLOCK]) for i in range(0, len(sizes), BLOCK)] or [([], [])]
        self._grow()

    def _cut(self, pieces: list[str]) -> tuple[list[int], list[int]]:
        return [len(p) for p in pieces], [self.count(p) for p in pieces]

    def _grow(self) -> None:
        """Sums over all blocks: node 1 is the root, node n has children 2 n and 2 n + 1."""
        self.width = 1 << max(0, len(self.blocks) - 1).bit_length()
        self.chars, self.sums = [0] * (2 * self.width), [0] * (2 * self.width)
        for i, (sizes, tokens) in enumerate(self.blocks):
            self.chars[self.width + i], self.sums[self.width + i] = sum(sizes), sum(tokens)
        for n in range(self.width - 1, 0, -1):
            self._add_up(n)

    def _add_up(self, n: int) -> None:
        self.chars[n] = self.chars[2 * n] + self.chars[2 * n + 1]
        self.sums[n] = self.sums[2 * n] + self.sums[2 * n + 1]

    @property
    def tokens(self) -> int:
        return self.sums[1]

    @property
    def pre_tokens(self) -> int:
        return sum(len(sizes) for sizes, _ in self.blocks)

    def _find(self, place: int) -> tuple[int, int, int]:
        """(block, pre-token in it, its first character) of the pre-token that holds ``place`` or ends the text."""
        n, start = 1, 0
        while n < self.width:
            n *= 2
            if place >= start + self.chars[n] and self.chars[n + 1]:
                start += self.chars[n]
                n += 1
        sizes = self.blocks[n - self.width][0] if n - self.width < len(self.blocks) else []
        at = 0
        while at < len(sizes) - 1 and place >= start + sizes[at]:
            start += sizes[at]
            at += 1
        return n - self.width, at, start

    def _back(self, block: int, at: int, start: int) -> tuple[int, int, int] | None:
        """The pre-token before."""
        while at == 0:
            block -= 1
            if block < 0:
                return None
            at = len(self.blocks[block][0])
        return block, at - 1, start - self.blocks[block][0][at - 1]

    def replace(self, start: int, end: int, new: str) -> None:
        """Text[start:end] becomes ``new``."""
        size = len(self.text)
        start, end = min(start, size), min(max(start, end), size)
        old, self.text = self.text, self.text[:start] + new + self.text[end:]
        shift = len(new) - (end - start)
        # Context: one pre-token back, and on over white space, whose cut looks
        # ahead to the next word.
        here, back = self._find(max(0, start - 1)), True
        while back and (earlier := self._back(*here)) is not None:
            here = earlier
            back = old[here[2] : here[2] + self.blocks[here[0]][0][here[1]]].isspace()
        block, at, first = here
        # Forward: the old boundaries after the edit, until a new one falls on one.
        pieces, place = [], first
        last_block, last_at, bound = block, at, first
        for match in self.split.finditer(self.text, first):
            if place >= start + len(new):
                target = place - shift
                while bound < target and last_block < len(self.blocks):
                    if last_at >= len(self.blocks[last_block][0]):
                        last_block, last_at = last_block + 1, 0
                        continue
                    bound += self.blocks[last_block][0][last_at]
                    last_at += 1
                if bound == target and target >= end:
                    break
            pieces.append(match.group())
            place = match.end()
        else:
            last_block, last_at = len(self.blocks), 0
        self.encoded += len(pieces)
        sizes, tokens = self._cut(pieces)
        head_sizes, head_tokens = self.blocks[block]
        tail_sizes, tail_tokens = self.blocks[last_block] if last_block < len(self.blocks) else ([], [])
        self.blocks[block] = (head_sizes[:at] + sizes + tail_sizes[last_at:], head_tokens[:at] + tokens + tail_tokens[last_at:])
        for b in range(block + 1, min(last_block + 1, len(self.blocks))):
            self.blocks[b] = ([], [])
        if len(self.blocks[block][0]) > 8 * BLOCK:  # much new text: cut the block up
            sizes, tokens = self.blocks[block]
            self.blocks[block : block + 1] = [(sizes[i : i + BLOCK], tokens[i : i + BLOCK]) for i in range(0, len(sizes), BLOCK)]
            self._grow()
            return
        touched = range(block, min(last_block + 1, len(self.blocks)))
        for b in touched:
            self.chars[self.width + b], self.sums[self.width + b] = sum(self.blocks[b][0]), sum(self.blocks[b][1])
        nodes = {(self.width + b) // 2 for b in touched}
        while nodes:
            for n in nodes:
                if n:
                    self._add_up(n)
            nodes = {n // 2 for n in nodes if n > 1}


def count_tokens(
    docs: DataFrame, edits: Column, rank_file: str = RANK_FILE, pattern: str = PATTERN, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens and n_pretokens of its text,
    edited_tokens and edited_pretokens after ``edits`` (array of struct(start,
    end, new), characters of the old text), and reencoded: how many pre-tokens
    the edits made it encode again."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, split = token_counter(rank_file, pattern)
        for batch in batches:
            out: list[list[int]] = [[] for _ in range(5)]
            for text, changes in zip(batch.column("text"), batch.column("edits")):
                tree = TokenTree(text.as_py() or "", counter, split)
                before = tree.tokens, tree.pre_tokens
                for x in sorted(changes.as_py() or (), key=lambda x: -x["start"]):
                    tree.replace(x["start"], x["end"], x["new"] or "")
                for column, value in zip(out, (*before, tree.tokens, tree.pre_tokens, tree.encoded)):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in out)], names=names)

    names = ["doc_id", "n_tokens", "n_pretokens", "edited_tokens", "edited_pretokens", "reencoded"]
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), edits.alias("edits"))
    return rows.mapInArrow(count, ", ".join(f"{n} long" for n in names))


def sample_edits(text: Column) -> Column:
    """Three edits of every text: new words at the middle, a replaced stretch at
    a quarter, a deleted one at three quarters."""
    n = F.coalesce(F.length(text), F.lit(0))
    edit = lambda start, size, new: F.struct(
        start.cast("int").alias("start"), (start + size).cast("int").alias("end"), F.lit(new).alias("new")
    )
    return F.array(
        edit(F.floor(n / 4), F.least(F.lit(12), F.floor(n / 8)), " edited text"),
        edit(F.floor(n / 2), F.lit(0), " with 2 new words"),
        edit(F.floor(n * 3 / 4), F.least(F.lit(9), F.floor(n / 8)), ""),
    )


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return count_tokens(docs, sample_edits(F.col("text")))
