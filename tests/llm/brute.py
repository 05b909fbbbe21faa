"""Plain single-process versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re

_LOWER = {i: i + 32 for i in range(65, 91)}
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns of the caller that clash with names used inside the operators.
CLASHING = ["_text", "size", "target", "taken", "copies", "row", "node", "component", "key", "item", "offset", "anchor", "piece", "words", "rule", "score"]


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(_LOWER))


def plain(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(_LOWER))


def shingles(text, k):
    w = spaced(text)
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def groups(texts, k, percent=80):
    """Smallest index reachable over links of similar texts."""
    sets = [shingles(t, k) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(texts))]


def removed(texts, length=100):
    """Per text (in order): n_bytes, n_removed, n_spans, sha256 of what is left."""
    seen, out = set(), []
    for text in texts:
        data = (text or "").encode()
        gone = [False] * len(data)
        for p in range(len(data) - length + 1):
            window = data[p : p + length]
            if window in seen:
                gone[p : p + length] = [True] * length
            seen.add(window)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def leaks(texts, items, window=10):
    """Per text: n_words, hit places, ids of items with occurring windows."""
    wins = {}
    for item_id, text in items:
        w = plain(text)
        if item_id is not None and w:
            k = min(window, len(w))
            for s in range(len(w) - k + 1):
                wins.setdefault(tuple(w[s : s + k]), set()).add(str(item_id))
    out = []
    for text in texts:
        w, hit, ids = plain(text), set(), set()
        for k in {len(x) for x in wins}:
            for s in range(len(w) - k + 1):
                if found := wins.get(tuple(w[s : s + k])):
                    hit |= set(range(s, s + k))
                    ids |= found
        out.append((len(w), sorted(hit), sorted(ids)))
    return out


def frame(spark, rows, clash=False):
    """Documents from (doc_id, text, lang, source) rows; with ``clash`` also the clashing columns."""
    names = CLASHING if clash else []
    schema = SCHEMA + "".join(f", {c} string" for c in names)
    return spark.createDataFrame([(*r, len(r[1] or "")) + ("x",) * len(names) for r in rows], schema)
