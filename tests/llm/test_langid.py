from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from strata.llm import langid
from strata.llm.common import read_table
from . import brute
from ..conftest import SF_SMALL

DE = "der hund und die katze gehen in den garten weil es schön ist "
FR = "le chien et la chatte vont dans le jardin parce que c'est beau "


def test_held_out_accuracy_and_scores(spark):
    docs = read_table(spark, SF_SMALL, "documents")
    got = langid.op1_language_id(spark, SF_SMALL).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == docs.count()
    out = [r for r in got if r.held_out]
    assert len(out) > 20
    assert sum(r.lang_pred == r.lang for r in out) / len(out) > 0.95
    assert all(0 <= r.score <= 1 for r in got)


def test_labels_of_the_held_out_fifth_are_not_learned(spark):
    docs = read_table(spark, SF_SMALL, "documents")
    wrong = docs.withColumn("lang", F.when(langid.held_out(), F.lit("xx")).otherwise(F.col("lang")))
    a = {r.doc_id: r._language for r in langid.with_language(docs).select("doc_id", "_language").collect()}
    b = {r.doc_id: r._language for r in langid.with_language(wrong).select("doc_id", "_language").collect()}
    assert a == b


def test_odd_rows(spark):
    rows = [(i, DE * (i % 4 + 1), "de", "s") for i in range(30)] + [(100 + i, FR * (i % 3 + 1), "fr", None) for i in range(30)]
    rows += [(200, None, "de", None), (201, "", None, None), (202, "12 !? 34", "fr", None), (203, "ß", None, None), (None, DE, None, None), (204, DE * 30_000, None, None), (204, FR, None, None)]
    got = langid.with_language(brute.frame(spark, rows, clash=True)).select("doc_id", "text", "_language.*").collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id in (200, 201, 202):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        elif r.text and len(r.text) > 5:
            assert r.lang_pred == ("de" if r.text.startswith("der") else "fr")
    kept = langid.identified(brute.frame(spark, rows, clash=True), min_score=0.0)
    assert kept.count() == len(rows) - 3 and kept.columns == brute.frame(spark, [], clash=True).columns


def test_no_labels_one_label_no_rows(spark):
    unlabelled = brute.frame(spark, [(1, DE, None, None)])
    assert langid.with_language(unlabelled).first()._language.lang_pred == "und"
    one = brute.frame(spark, [(i, DE, "de", None) for i in range(10)])
    assert {(r._language.lang_pred, r._language.score) for r in langid.with_language(one).collect()} == {("de", 1.0)}
    assert langid.with_language(brute.frame(spark, [])).count() == 0


def test_the_stage_rejects_by_language_and_score(spark):
    rows = [(i, DE * (i % 4 + 1), "de", None) for i in range(30)] + [(100 + i, FR * (i % 3 + 1), "fr", None) for i in range(30)]
    odd = [(200, "zzq xkq 77 qqx jjk wq " * 5, None, None), (201, "12 34", None, None), (202, DE, None, None)]
    docs = brute.frame(spark, rows + odd, clash=True)
    scores = {r.doc_id: r._language for r in langid.with_language(docs).collect()}
    kept = lambda **how: {r.doc_id for r in langid.identified(docs, **how).collect()}
    assert kept(wanted=["de"]) == {*range(30), 202} | ({200} if scores[200].lang_pred == "de" and scores[200].score >= langid.MIN_SCORE else set())
    assert kept(min_score=scores[200].score + 1e-6) == {r[0] for r in rows} | {202}
    assert scores[200].score < min(scores[r[0]].score for r in rows)
    assert 201 not in kept()


def test_an_unlabelled_corpus_keeps_its_texts(spark):
    docs = brute.frame(spark, [(1, DE, None, None), (2, "12 !", None, None), (None, FR, None, "s"), (3, None, None, None)])
    assert {r.doc_id for r in langid.identified(docs).collect()} == {1, None}
    assert langid.identified(brute.frame(spark, [])).count() == 0


def plain_prediction(model, text):
    """Language and score of one text, feature by feature."""
    clean = [c if c >= 128 or 97 <= c <= 122 else 32 for c in (text or "").lower().encode()]
    padded, counts = [32, *clean, 32], [0] * langid.DIMENSIONS
    shift = 32 - langid.DIMENSIONS.bit_length() + 1
    for a, b, c in zip(padded, padded[1:], padded[2:]):
        if b != 32:
            counts[(((a << 16 | b << 8 | c) * 0x9E3779B1) % 2**32) >> shift] += 1
        if b != 32 or c != 32:
            counts[(((b << 8 | c) * 0x85EBCA77 + 1) % 2**32) >> shift] += 1
    if not any("a" <= ch.lower() <= "z" or ord(ch) > 127 for ch in text or ""):
        return "und", 0.0
    x = [(n / sum(counts)) ** 0.5 for n in counts] + [1.0]
    margin = lambda w: sum(a * b for a, b in zip(x, w.tolist()))
    sure = lambda m: 1 / (1 + np.exp(-3 * m))
    score, members = 1.0, model.families[0][0]
    if len(model.families) > 1:
        best = max(range(len(model.families)), key=lambda f: margin(model.families[f][1]))
        score, members = sure(margin(model.families[best][1])), model.families[best][0]
    votes, least = {m: 0.0 for m in members}, {m: 1.0 for m in members}
    for a, b, w in model.pairs:
        if a in votes:
            m = margin(w)
            votes[a if m > 0 else b] += 1
            votes[a] += np.tanh(m) / (1000 * len(model.languages))
            votes[b] -= np.tanh(m) / (1000 * len(model.languages))
            least[a], least[b] = min(least[a], sure(m)), min(least[b], sure(-m))
    chosen = max(votes, key=votes.get)
    return model.languages[chosen], score * least[chosen]


def test_predictions_equal_a_plain_version(spark):
    docs = read_table(spark, SF_SMALL, "documents")
    model = langid.train(docs.where(~langid.held_out()))
    assert len(model.families) == 2 and len(model.pairs) == 2
    rows = langid.with_language(docs, model).orderBy("doc_id").select("text", "_language").collect()
    for r in rows:
        if r.text is None or len(r.text) < 6000:
            want, score = plain_prediction(model, r.text)
            assert r._language.lang_pred == want and abs(r._language.score - score) < 1e-3


def test_a_worker_holds_few_vectors_at_once(monkeypatch):
    import tracemalloc

    column = pa.array([DE + str(i) for i in range(10_000)])
    tracemalloc.start()
    n = sum(len(langid.features(some)) for some in langid.slices(column))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 10_000 and peak < 20e6


def test_families_first_then_pairs():
    rnd = np.random.default_rng(1)
    centres = {"en": 0, "de": 20, "fr": 40, "es": 60}
    x = rnd.random((200, langid.DIMENSIONS)).astype(np.float32) * 0.1
    names = sorted(centres)
    y = np.arange(200) % 4
    for i, n in enumerate(names):
        x[y == i, centres[n] : centres[n] + 10] += 1
    families = [[names.index(n) for n in ("de", "en")], [names.index(n) for n in ("es", "fr")]]
    model = langid.LanguageModel(
        names,
        [(m, langid.linear_svm(x, np.isin(y, m))) for m in families],
        [(m[0], m[1], langid.linear_svm(x[np.isin(y, m)], y[np.isin(y, m)] == m[0])) for m in families],
    )
    assert model.predict(x)[0] == [names[i] for i in y]


def test_features_of_long_texts_do_not_depend_on_the_piece(monkeypatch):
    column = pa.array([DE * 50, FR, "", None])
    whole = langid.features(column)
    monkeypatch.setattr(langid, "PIECE", 64)
    assert np.abs(langid.features(column) - whole).max() < 1e-6
