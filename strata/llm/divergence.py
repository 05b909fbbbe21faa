"""How far the sources of each language differ in their words.

1. Duplicate-text collapse: the rows of one language and text become one text
   with a multiplicity for each source.  Counting rows shuffles digests; of the
   texts themselves every task sends each once.
2. Each collapsed text is cut into terms once; its counts and its document
   frequency weigh by the multiplicities.  A task adds up many texts before
   anything is shuffled, so what follows grows with the vocabulary.
3. A language keeps the terms of at least ``min_docs`` of its documents, each
   with the counts of the sources that have it (sparse).
4. Pairs of sources: the divergence over all kept terms is put together from
   those that both have (a join on the term), those that one has (by the few
   different counts it has, against the other's share of an absent term) and the
   number of terms that neither has.  Absent terms are never listed.

With p = 1 + floor(10^9 (count + 2) / (N + 2 V)), two shares of a term give
floor((p - q)^2 / (p + q)).  All arithmetic is on whole numbers.

Defined cases: null texts, languages and sources are ''; a text without a term
counts in its group, which exists even if it has none; with no kept term (V = 0)
pairs have value 0 and there are no term rows; a language of one source has no
pairs; ties rank by the item's UTF-8 bytes; repeated rows all count; an empty
table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut_lineage, read_table, written
from .words import text_bytes, word_pieces

MIN_DOCS = 10
TOP_TERMS = 10
SCALE = 1_000_000_000
#: Bytes of the table of (language, source) groups that may be broadcast; beyond, it is joined.
MAX_BROADCAST = 8 << 20
#: Counts that a task adds up before they leave it (50 MB).
HELD = 400_000
#: Letters and non-ASCII bytes stay, A-Z lower-cased; all else becomes a space.
_TERM_BYTES = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def text_terms(data: bytes) -> Counter:
    """How often each term occurs in a text (UTF-8)."""
    found: Counter = Counter()
    for words in word_pieces(data, _TERM_BYTES):
        found.update(words)
    return found


def _named(docs: DataFrame, *columns: str) -> DataFrame:
    return docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in columns))


def collapsed(docs: DataFrame) -> DataFrame:
    """``(lang, digest, text, sources)``: each language's different texts, with an
    array of (source, n rows)."""
    rows = _named(docs, "lang", "source", "text")
    rows = rows.withColumn("digest", F.unhex(F.md5(F.encode("text", "utf-8"))))
    per_source = rows.groupBy("lang", "digest", "source").agg(F.count("*").alias("n"))
    sources = per_source.groupBy("lang", "digest").agg(F.collect_list(F.struct("source", "n")).alias("sources"))
    texts = rows.groupBy("lang", "digest").agg(F.any_value("text").alias("text"))
    return texts.join(sources, ["lang", "digest"])


def term_counts(texts: DataFrame) -> DataFrame:
    """``(lang, term, docs, sources, counts)``: parts of each term's documents and of
    its occurrences by source, added up over some thousands of texts at a time."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, dict[bytes, list]] = {}

        def sent() -> pa.RecordBatch:
            langs, terms, docs, sources, counts, ends = [], [], [], [], [], [0]
            for lang, found in held.items():
                langs += [lang] * len(found)
                for term, (times, by_source) in found.items():
                    terms.append(term.decode())
                    docs.append(times)
                    sources += by_source
                    counts += by_source.values()
                    ends.append(len(sources))
            ends = pa.array(ends, pa.int32())
            lists = (pa.ListArray.from_arrays(ends, v) for v in (pa.array(sources, pa.string()), pa.array(counts, pa.int64())))
            return pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(terms, pa.string()), pa.array(docs, pa.int64()), *lists],
                names=["lang", "term", "docs", "sources", "counts"],
            )

        n_held = 0
        for batch in batches:
            data, bounds = text_bytes(batch.column(1))
            for i, (lang, sources) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2))):
                groups = [(g["source"], g["n"]) for g in sources.as_py()]
                times, found = sum(n for _, n in groups), held.setdefault(lang, {})
                terms = text_terms(data[bounds[i] : bounds[i + 1]].tobytes())
                for term, n in terms.items():
                    entry = found.get(term)
                    if entry is None:
                        entry = found[term] = [0, {}]
                    entry[0] += times
                    by_source = entry[1]
                    for source, rows in groups:
                        by_source[source] = by_source.get(source, 0) + n * rows
                n_held += len(terms) * len(groups)
                if n_held >= HELD:
                    yield sent()
                    held.clear()
                    n_held = 0
        if n_held:
            yield sent()

    kinds = "lang string, term string, docs long, sources array<string>, counts array<long>"
    return texts.select("lang", "text", "sources").mapInArrow(count, kinds)


def kept_counts(docs: DataFrame, min_docs: int) -> DataFrame:
    """``(lang, source, term, n, all_n)`` of the terms that a language keeps, where
    a source has them; one shuffle by (lang, term)."""
    parts = term_counts(collapsed(docs))
    of_term = Window.partitionBy("lang", "term")
    frequent = parts.withColumn("_docs", F.sum("docs").over(of_term)).where(F.col("_docs") >= min_docs)
    each = frequent.select("lang", "term", F.explode(F.arrays_zip("sources", "counts")).alias("x"))
    counts = each.groupBy("lang", "term", F.col("x.sources").alias("source")).agg(F.sum("x.counts").alias("n"))
    return counts.withColumn("all_n", F.sum("n").over(of_term)).select("lang", "source", "term", "n", "all_n")


def share(n: Column, total: Column, terms: Column) -> Column:
    """p of a term with ``n`` of ``total`` occurrences in a language of ``terms`` kept terms."""
    part = (n + 2).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    # Both are whole numbers beyond a long's range at scale: exact division.
    return F.call_function("div", part, (total + 2 * terms).cast("decimal(20,0)")) + 1


def gap(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _sized(df: DataFrame) -> DataFrame:
    """``df``, to be broadcast if its measured size allows."""
    width = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in ("lang", "source")), F.lit(80))
    return F.broadcast(df) if (df.agg(F.sum(width)).first()[0] or 0) <= MAX_BROADCAST else df


def source_divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: for each source of a language
    the others by divergence (part ``pair``) and the ``top_terms`` kept terms that
    it uses more than its language does (part ``term``)."""
    kept = written(kept_counts(docs, min_docs), "kept-terms")
    of_lang = kept.groupBy("lang").agg(F.count_distinct("term").alias("n_terms"), F.sum("n").alias("all_total"))
    of_group = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("own"))
    groups = _named(docs, "lang", "source").distinct().join(of_group, ["lang", "source"], "left").join(of_lang, "lang", "left")
    groups = groups.na.fill(0, ["total", "own", "n_terms", "all_total"])
    groups = _sized(cut_lineage(groups.withColumn("p0", F.when(F.col("n_terms") > 0, share(F.lit(0), F.col("total"), F.col("n_terms"))))))

    shares = kept.join(groups, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("total"), F.col("n_terms")))
    shares = shares.withColumn("q", share(F.col("all_n"), F.col("all_total"), F.col("n_terms")))
    shares = written(shares.select("lang", "source", "term", "p", "p0", "q"), "term-shares")

    other = groups.select(F.col("lang").alias("_lang"), F.col("source").alias("item"), F.col("own").alias("_own"), F.col("p0").alias("_p0"))
    differ = (F.col("lang") == F.col("_lang")) & (F.col("source") != F.col("item"))
    absent = F.when(F.col("n_terms") > 0, (F.col("n_terms") - F.col("own") - F.col("_own")) * gap(F.col("p0"), F.col("_p0"))).otherwise(0)
    neither = groups.join(other, differ).select("lang", "source", "item", absent.alias("value"))

    levels = shares.groupBy("lang", "source", "p").agg(F.count("*").alias("times"))
    against = levels.join(other, differ).groupBy("lang", "source", "item").agg(F.sum(F.col("times") * gap(F.col("p"), F.col("_p0"))).alias("value"))

    right = shares.select(F.col("lang").alias("_lang"), F.col("term").alias("_term"), F.col("source").alias("item"), F.col("p").alias("_p"), F.col("p0").alias("_p0"))
    same_term = (F.col("lang") == F.col("_lang")) & (F.col("term") == F.col("_term")) & (F.col("source") < F.col("item"))
    excess = gap(F.col("p"), F.col("_p")) - gap(F.col("p"), F.col("_p0")) - gap(F.col("p0"), F.col("_p")) + gap(F.col("p0"), F.col("_p0"))
    both = shares.join(right, same_term).groupBy("lang", "source", "item").agg(F.sum(excess).alias("value"))

    two_ways = F.explode(F.array(F.struct("lang", "source", "item", "value"), F.struct("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")))
    parts = neither.unionByName(against.unionByName(both).select(two_ways.alias("x")).select("x.*"))
    pairs = parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")).withColumn("part", F.lit("pair"))
    more = shares.where("p > q").select("lang", "source", F.col("term").alias("item"), gap(F.col("p"), F.col("q")).alias("value"), F.lit("term").alias("part"))

    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    ranked = pairs.withColumn("rank", place).unionByName(more.withColumn("rank", place).where(F.col("rank") <= top_terms))
    return ranked.select("lang", "source", "part", "item", "value", "rank")


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(read_table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
),
places AS (SELECT d, lang, source, unnest(w) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS all_n FROM places GROUP BY lang, term HAVING count(DISTINCT d) >= 10),
groups AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT lang, source, term, count(*) AS n FROM places GROUP BY lang, source, term),
grid AS (
  SELECT g.lang, g.source, k.term, k.all_n, coalesce(c.n, 0) AS n
  FROM groups g JOIN kept k ON g.lang = k.lang LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
),
totals AS (SELECT lang, source, count(*) AS v, sum(n) AS total, sum(all_n) AS all_total FROM grid GROUP BY lang, source),
shares AS (
  SELECT lang, source, term, n,
    (1 + (n + 2)::HUGEINT * 1000000000 // (total + 2 * v)::HUGEINT)::BIGINT AS p,
    (1 + (all_n + 2)::HUGEINT * 1000000000 // (all_total + 2 * v)::HUGEINT)::BIGINT AS q
  FROM grid JOIN totals USING (lang, source)
),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source
),
results AS (
  SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(p.value, 0)::BIGINT AS value
  FROM groups g JOIN groups h ON g.lang = h.lang AND g.source <> h.source
  LEFT JOIN pairs p ON p.lang = g.lang AND p.source = g.source AND p.item = h.source
  UNION ALL
  SELECT lang, source, 'term', term, (((p - q) * (p - q)) // (p + q))::BIGINT FROM shares WHERE n > 0 AND p > q
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM results)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""
