"""Language identification in two steps.

A text's hashed letter n-grams (2 and 3 bytes of lower-cased UTF-8) form a unit
vector.  First one-versus-rest linear support vector machines choose the
language family; then one-versus-one machines between that family's languages
vote (ties by summed margins).

Training uses at most ``SAMPLE_DOCS`` labelled documents (a documented bound),
chosen by a hash of the id and spread evenly over the languages; features are
computed by Spark, and only the vectors of that sample reach the driver.
Prediction reads the text alone and covers whole texts in bounded memory.

Defined cases: a null text or one without a letter is ``und`` with score 0;
without labelled documents every text is ``und``; with one learned language
every other text is that, score 1; repeated rows each get their row; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table
from .words import PIECE, text_bytes

UNKNOWN = "und"
DIMENSIONS = 2048
SAMPLE_DOCS = 2000
#: Texts whose vectors a worker holds at once.
TEXTS = 256
#: Below this score a text has no language that the pipeline would keep.
MIN_SCORE = 0.2
#: Families of related languages; any other is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "is", "af"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca"),
    "slavic": ("ru", "uk", "pl", "cs", "sk", "bg", "sr", "hr"),
}


def family_of(language: str) -> str:
    return next((family for family, members in FAMILIES.items() if language in members), language)


def slices(column: pa.Array) -> Iterator[pa.Array]:
    """``TEXTS`` texts at a time: their vectors take 2 MB, however long a batch is."""
    return (column.slice(i, TEXTS) for i in range(0, len(column), TEXTS))


def features(column: pa.Array) -> np.ndarray:
    """One unit vector of ``DIMENSIONS`` for each text."""
    data, bounds = text_bytes(pc.utf8_lower(column))
    letters = np.where((np.arange(256) >= 128) | ((np.arange(256) >= 97) & (np.arange(256) <= 122)), np.arange(256), 32)
    letters = letters.astype(np.uint32)
    result = np.zeros((len(bounds) - 1, DIMENSIONS), np.float32)
    shift = np.uint32(32 - DIMENSIONS.bit_length() + 1)
    for i, (lo, hi) in enumerate(zip(bounds[:-1], bounds[1:])):
        counts = np.zeros(DIMENSIONS, np.int64)
        for start in range(lo, hi, PIECE):
            part = letters[data[max(lo, start - 2) : min(hi, start + PIECE)]]
            padded = np.concatenate([part[:0] if start > lo else [np.uint32(32)], part, [np.uint32(32)] if start + PIECE >= hi else part[:0]])
            a, b, c = padded[:-2], padded[1:-1], padded[2:]
            with np.errstate(over="ignore"):
                three = ((a << np.uint32(16) | b << np.uint32(8) | c) * np.uint32(0x9E3779B1)) >> shift
                two = ((b << np.uint32(8) | c) * np.uint32(0x85EBCA77) + np.uint32(1)) >> shift
            counts += np.bincount(three[b != 32], minlength=DIMENSIONS)
            counts += np.bincount(two[(b != 32) | (c != 32)], minlength=DIMENSIONS)
        total = counts.sum()
        if total:
            result[i] = np.sqrt(counts / total)
    return result


def linear_svm(x: np.ndarray, positive: np.ndarray, penalty: float = 1e-4, rounds: int = 300) -> np.ndarray:
    """Weights and bias of a linear support vector machine (squared hinge,
    accelerated gradient); both classes weigh the same."""
    # Vectors stay float32 and are never copied: the driver holds the sample once.
    y = np.where(positive, 1, -1).astype(np.float32)
    share = np.where(positive, 0.5 / max(1, positive.sum()), 0.5 / max(1, (~positive).sum())).astype(np.float32)
    w = ahead = np.zeros(x.shape[1] + 1)
    for t in range(rounds):
        pull = share * y * np.maximum(0, 1 - y * (x @ ahead[:-1].astype(np.float32) + np.float32(ahead[-1])))
        step = ahead - 0.25 * (penalty * ahead - 2 * np.append(pull @ x, pull.sum()))
        ahead, w = step + t / (t + 3) * (step - w), step
    return w


@dataclass(frozen=True)
class LanguageModel:
    """``families``: (name, languages, weights); ``pairs``: (first, second, weights) by index of language."""

    languages: list[str]
    families: list[tuple[list[int], np.ndarray | None]]
    pairs: list[tuple[int, int, np.ndarray]]

    def machines(self) -> tuple[np.ndarray, np.ndarray]:
        """Weights (a column for each machine: families, then pairs) and biases, as float32."""
        all_weights = [w for _, w in self.families if w is not None] + [w for *_, w in self.pairs]
        if not all_weights:
            return np.zeros((DIMENSIONS, 0), np.float32), np.zeros(0, np.float32)
        stacked = np.stack(all_weights, axis=1).astype(np.float32)
        return np.ascontiguousarray(stacked[:-1]), stacked[-1]

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Language and score of each vector."""
        n = len(x)
        if not self.languages:
            return [UNKNOWN] * n, np.zeros(n)
        weights, biases = self.machines()
        all_margins = iter((x @ weights + biases).astype(np.float64).T)
        sure = lambda margin: 1 / (1 + np.exp(-3 * margin))
        if len(self.families) == 1:
            family, score = np.zeros(n, int), np.ones(n)
        else:
            margins = np.stack([next(all_margins) for _ in self.families], axis=1)
            family = margins.argmax(axis=1)
            score = sure(margins.max(axis=1))
        votes = np.full((n, len(self.languages)), -np.inf)
        for f, (members, _) in enumerate(self.families):
            votes[np.ix_(family == f, members)] = 0
        sums, least = np.zeros_like(votes), np.ones_like(votes)
        for a, b, _ in self.pairs:
            margin = next(all_margins)
            votes[:, a] += margin > 0
            votes[:, b] += margin <= 0
            sums[:, a] += np.tanh(margin)
            sums[:, b] -= np.tanh(margin)
            least[:, a] = np.minimum(least[:, a], sure(margin))
            least[:, b] = np.minimum(least[:, b], sure(-margin))
        chosen = (votes + sums / (1000.0 * len(self.languages))).argmax(axis=1)
        return [self.languages[i] for i in chosen], score * least[np.arange(n), chosen]


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def train(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_docs: int = SAMPLE_DOCS) -> LanguageModel:
    """A model from a bounded sample of the labelled documents."""
    rows = labelled.select(
        F.xxhash64(F.col(id_col).cast("string"), F.lit(5)).alias("h"), F.col(text_col).alias("t"), F.col(lang_col).alias("lang")
    ).where(F.col("lang").isNotNull() & has_letter(F.col("t")))
    counts = {r.lang: r["count"] for r in rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(sample_docs).collect()}
    if not counts:
        return LanguageModel([], [], [])
    each = max(1, sample_docs // len(counts))
    share = F.create_map(*[F.lit(v) for lang, n in counts.items() for v in (lang, min(1.0, 1.5 * each / n))])
    vector = F.arrow_udf(lambda column: pa.array([v.tobytes() for some in slices(column) for v in features(some)], pa.binary()), "binary")
    picked = rows.where((F.pmod("h", F.lit(1 << 20)) / (1 << 20)) < F.coalesce(share[F.col("lang")], F.lit(0.0)))
    sample = picked.select("h", "lang", vector("t").alias("x")).orderBy("h").limit(2 * sample_docs).collect()
    taken: dict[str, list[bytes]] = {}
    for r in sorted(sample, key=lambda r: (r.h, r.lang, r.x)):
        if len(own := taken.setdefault(r.lang, [])) < each:
            own.append(bytes(r.x))
    del sample
    languages = sorted(taken)
    y = np.repeat(np.arange(len(languages)), [len(taken[lang]) for lang in languages])
    x = np.empty((len(y), DIMENSIONS), np.float32)
    for i, vector_bytes in enumerate(v for lang in languages for v in taken.pop(lang)):
        x[i] = np.frombuffer(vector_bytes, np.float32)
    names = sorted({family_of(lang) for lang in languages})
    members = [[i for i, lang in enumerate(languages) if family_of(lang) == f] for f in names]
    families = [(m, linear_svm(x, np.isin(y, m)) if len(members) > 1 else None) for m in members]
    pairs = [(a, b, linear_svm(x[own := np.isin(y, (a, b))], y[own] == a)) for m in members for a, b in combinations(m, 2)]
    return LanguageModel(languages, families, pairs)


def predictor(spark: SparkSession, model: LanguageModel):
    """A column function: text -> struct(lang_pred, score).  The model is a few
    vectors of fixed length for each language pair, and is broadcast."""
    shared = spark.sparkContext.broadcast((model.languages, model.families, model.pairs))
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64())])

    def predict(column: pa.Array) -> pa.Array:
        model, languages, scores = LanguageModel(*shared.value), [], []
        for some in slices(column):
            found, sure = model.predict(features(some))
            languages += found
            scores.append(sure)
        told = pa.array(np.concatenate(scores) if scores else [], pa.float64())
        return pa.StructArray.from_arrays([pa.array(languages, pa.string()), told], fields=list(kind))

    guess = F.arrow_udf(predict, "struct<lang_pred: string, score: double>")

    def predicted(text: Column) -> Column:
        nothing = F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
        return F.when(has_letter(text), guess(F.coalesce(text, F.lit("")))).otherwise(nothing)

    return predicted


def held_out(id_col: str = "doc_id") -> Column:
    """The fifth of the documents that no model learns from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5, F.lit(0)) == 0


def with_language(docs: DataFrame, model: LanguageModel | None = None) -> DataFrame:
    """``docs`` with ``_language``, struct(lang_pred, score), by ``model``, or learned
    from its own labels outside the held-out fifth."""
    if model is None:
        model = train(docs.where(~held_out()))
    return docs.withColumn("_language", predictor(docs.sparkSession, model)(F.col("text")))


def identified(docs: DataFrame, wanted: Sequence[str] | None = None, min_score: float = MIN_SCORE) -> DataFrame:
    """The documents, as they are, whose predicted language is one of ``wanted`` (all
    that were learned, if None) with at least ``min_score``: a text that no machine
    claims goes.  Without any label nothing is learned or rejected but texts
    without a letter."""
    model = train(docs.where(~held_out()))
    if not model.languages:
        return docs.where(has_letter(F.col("text")))
    sure = F.col("_language.lang_pred").isin(list(model.languages if wanted is None else wanted)) & (F.col("_language.score") >= min_score)
    return with_language(docs, model).where(sure).drop("_language")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = with_language(docs.select("doc_id", "text", "lang"))
    return found.select("doc_id", held_out().alias("held_out"), "_language.lang_pred", "_language.score")
