"""Licence scans by a positional rare-token index.

The index holds the words of all licence phrases and templates with their
inverse document frequency over the scanned documents.  A file's licence words
are looked up by the rarest words of each template, so many that a text without
any of them in place cannot reach ``MIN_SHARE``; a word's place less its place
in the template is where the template would start.  There, phrases must stand word for word, and longer templates must agree with ``MIN_SHARE`` of
their IDF weight and contain their mandatory key phrases.

Native: array expressions over each text's words; only the word counts are
shuffled (a row for each task and licence word).

Defined cases: a null text is empty; without words or licences n_base is 0, the
labels are "" and first_word and last_word null; repeated rows each get their
row; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import PLAIN_WORD, lower_ascii, read_table

#: Phrase, label.
PHRASES = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]
#: Label, template, mandatory key phrases.
TEMPLATES = [
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3", ["gnu general public license", "version 3"]),
    ("apache-2.0", "licensed under the apache license version 2 0", ["apache license version 2 0"]),
    ("cc-by-4.0", "licensed under cc by 4 0", ["cc by 4 0"]),
    ("cc-by-nc", "licensed under cc by nc 4 0", ["cc by nc"]),
    ("cc-by-sa", "licensed under cc by sa 4 0", ["cc by sa"]),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", ["permission is hereby granted", "free of charge"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", ["source and binary forms"]),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ["mozilla public license"]),
]
MIN_SHARE = 0.8
#: Rarest words by which a template is looked up, at least.
RARE_WORDS = 2


def word_idf(words: DataFrame, vocabulary: Sequence[str]) -> dict[str, float]:
    """ln(1 + documents / (1 + documents with the word)), over all documents of ``words`` (_words)."""
    own = F.array_distinct(F.filter("_words", lambda w: w.isin(list(vocabulary))))
    found = words.select(F.explode(own).alias("w")).groupBy("w").count().collect()
    n, counts = words.count(), {r["w"]: r["count"] for r in found}
    return {w: math.log(1 + n / (1 + counts.get(w, 0))) for w in vocabulary}


def _rarest(phrase: Sequence[str], idf: dict[str, float]) -> list[str]:
    return sorted(set(phrase), key=lambda w: (-idf[w], w))


def _lookup_words(template: Sequence[str], idf: dict[str, float]) -> list[str]:
    """The rarest words that together weigh more than what a match may lack."""
    rarest, total = _rarest(template, idf), sum(idf[w] for w in template)
    n = RARE_WORDS
    while n < len(rarest) and sum(idf[w] for w in template if w in rarest[:n]) <= (1 - MIN_SHARE + 1e-9) * total:
        n += 1
    return rarest[:n]


def _starts(word: str, place: int) -> Column:
    """Where a template with ``word`` at ``place`` would start."""
    return F.transform(F.filter("_posted", lambda x: x["w"] == word), lambda x: x["i"] - place)


def _phrase_at(start: Column, phrase: Sequence[str]) -> Column:
    wanted = F.array(*[F.lit(w) for w in phrase])
    return (start >= 0) & (F.slice("_words", F.greatest(start, F.lit(0)) + 1, len(phrase)) == wanted)


def _phrase_starts(phrase: Sequence[str], idf: dict[str, float]) -> Column:
    rare = _rarest(phrase, idf)[0]
    return F.filter(_starts(rare, list(phrase).index(rare)), lambda s: _phrase_at(s, phrase))


def _template_score(template: Sequence[str], keys: Sequence[Sequence[str]], idf: dict[str, float]) -> Column:
    """The best share of the template's IDF weight at any start where all key
    phrases stand nearby (within the template's length); 0 if there is none."""
    starts = F.array_distinct(F.concat(*[_starts(w, p) for w in _lookup_words(template, idf) for p, x in enumerate(template) if x == w]))
    total = sum(idf[w] for w in template)

    def share(s: Column) -> Column:
        hits = [F.when((s + p >= 0) & F.get("_words", s + p).eqNullSafe(F.lit(w)), idf[w]).otherwise(0.0) for p, w in enumerate(template)]
        region = F.concat(F.lit(" "), F.array_join(F.slice("_words", F.greatest(s, F.lit(0)) + 1, 2 * len(template)), " "), F.lit(" "))
        keyed = [F.contains(region, F.lit(f" {' '.join(k)} ")) for k in keys]
        agreed = sum(hits[1:], hits[0]) / F.lit(total)
        both = keyed[0]
        for k in keyed[1:]:
            both = both & k
        return F.when(both, agreed).otherwise(0.0)

    return F.coalesce(F.array_max(F.transform(starts, share)), F.lit(0.0))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_base, first_word,
    last_word, base_labels, labels, score."""
    phrases = [(p.split(), label) for p, label in PHRASES]
    templates = [(label, t.split(), [k.split() for k in keys]) for label, t, keys in TEMPLATES]
    vocabulary = sorted({w for p, _ in phrases for w in p} | {w for _, t, _ in templates for w in t})
    text = lower_ascii(F.coalesce(F.col(text_col), F.lit("")))
    words = docs.select(F.col(id_col).alias("doc_id"), F.regexp_extract_all(text, F.lit(PLAIN_WORD), F.lit(0)).alias("_words"))
    idf = word_idf(words, vocabulary)

    looked_up = sorted({_rarest(p, idf)[0] for p, _ in phrases} | {w for _, t, _ in templates for w in _lookup_words(t, idf)})
    posted = F.filter(F.transform("_words", lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda x: x["w"].isin(looked_up))
    none = F.array().cast("array<struct<w:string,i:int>>")
    rows = words.withColumn("_posted", F.when(F.arrays_overlap("_words", F.array(*[F.lit(w) for w in looked_up])), posted).otherwise(none))
    for i, (phrase, _) in enumerate(phrases):
        rows = rows.withColumn(f"_at_{i}", _phrase_starts(phrase, idf))
    for i, (_, template, keys) in enumerate(templates):
        rows = rows.withColumn(f"_share_{i}", _template_score(template, keys, idf))
    places = F.concat(*[F.col(f"_at_{i}") for i in range(len(phrases))])
    base = [F.when(F.size(f"_at_{i}") > 0, F.lit(label)) for i, (_, label) in enumerate(phrases)]
    own = [F.when(F.col(f"_share_{i}") >= MIN_SHARE, F.lit(label)) for i, (label, _, _) in enumerate(templates)]
    listed = lambda labels: F.array_join(F.array_sort(F.array_distinct(F.array_compact(F.array(*labels)))), ",")
    shares = F.greatest(*[F.col(f"_share_{i}") for i in range(len(templates))])
    return rows.withColumn("_places", places).select(
        "doc_id",
        F.size("_words").cast("long").alias("n_words"),
        F.size("_places").cast("long").alias("n_base"),
        F.array_min("_places").cast("long").alias("first_word"),
        F.array_max("_places").cast("long").alias("last_word"),
        listed(base).alias("base_labels"),
        listed([*base, *own]).alias("labels"),
        F.when(F.size("_places") > 0, 1.0).otherwise(F.least(F.lit(1.0), shares)).alias("score"),
    )


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read_table(spark, sf_dir, "documents"))
