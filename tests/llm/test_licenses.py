from __future__ import annotations

from strata.llm.common import read_table
from strata.llm.licenses import PHRASES, TEMPLATES, op5_license_scan, scan_licenses
from . import brute
from ..conftest import SF_SMALL


def _base(text):
    words, places, labels = brute.plain(text), [], set()
    for phrase, label in PHRASES:
        p = phrase.split()
        for s in range(len(words) - len(p) + 1):
            if words[s : s + len(p)] == p:
                places.append(s)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def _same(rows, got):
    want = {doc: _base(text) for doc, text in rows}
    for r in got:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == want[r.doc_id]
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert 0 <= r.score <= 1 and (r.score == 1.0 or not r.n_base)
        assert r.labels.split(",") == sorted(set(r.labels.split(",")))


def test_all_documents_of_the_table(spark):
    rows = [(r.doc_id, r.text) for r in read_table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()]
    got = op5_license_scan(spark, SF_SMALL).collect()
    assert len(got) == len(rows)
    _same(rows, got)


def test_odd_texts(spark):
    texts = [
        None, "", "mit", "MIT License", "mit-license, Mit\nLicense!", "cc by cc by cc", "gnu general public license gnu general public",
        "the apache license license", "mitlicense xmit license", "é mit license é", "license mit apache gnu by cc",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
        "Permission is hereby granted, free of charge, to each person obtaining a copy of that software",
        "permission is granted free of charge to any person obtaining a copy of this software",
        "w " * 200_000 + "cc by",
    ]
    rows = list(enumerate(texts))
    got = scan_licenses(brute.frame(spark, [(i, t, None, None) for i, t in rows] * 2, clash=True)).collect()
    assert len(got) == 2 * len(rows)
    _same(rows, got)
    labels = {r.doc_id: (r.labels, round(r.score, 2)) for r in got}
    assert labels[11] == ("mit", 1.0)
    assert labels[12][0] == "mit" and 0.8 <= labels[12][1] < 1
    assert labels[13] == ("", 0.0)  # a mandatory phrase is missing


def test_empty_table(spark):
    assert scan_licenses(brute.frame(spark, [])).count() == 0


def test_no_python_in_the_plan(spark):
    plan = op5_license_scan(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_templates_without_their_rarest_words_are_found(spark):
    changed = {label: t for label, t, _ in TEMPLATES}["mit"].replace("copy", "duplicate").replace("software", "program")
    rows = [(0, f"x {changed} y", None, None)] + [(i, "nothing", None, None) for i in range(1, 50)]
    got = {r.doc_id: r for r in scan_licenses(brute.frame(spark, rows)).collect()}
    assert got[0].labels == "mit" and 0.8 <= got[0].score < 1
    assert got[1].labels == ""
