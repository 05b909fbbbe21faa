from __future__ import annotations

import hashlib
import random
from heapq import heappop

import numpy as np
import pytest

from strata.llm.bytebpe import RankQueue, Splitter, Vocabulary, decode_ids, encode_texts, op13_byte_bpe
from strata.llm.common import read_table
from . import brute
from ..conftest import SF_SMALL

tokenizers = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")
RANKS = tokenizers.path("byte_bpe_50k.tiktoken")
VOCABULARY = Vocabulary.read(open(RANKS, "rb").read())
PLAIN = tiktoken.Encoding("plain", pat_str=tokenizers.PATTERN, mergeable_ranks=VOCABULARY.ranks, special_tokens={})


def _digests(text):
    ids = PLAIN.encode_ordinary(text or "")
    return len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def merged(vocabulary, text):
    return vocabulary.merge([text.encode()])[0].tolist()


def test_the_queue_gives_ranks_and_places_in_order():
    rnd = random.Random(2)
    queue, kept = RankQueue(60_000), []
    for _ in range(4000):
        if rnd.random() < 0.6:
            entry = (rnd.choice([0, 63, 64, 4095, 4096, rnd.randrange(60_000)]), rnd.randrange(100))
            kept.append(entry)
            queue.push(*entry)
        elif kept:
            _pop(queue, kept)
    while kept:
        _pop(queue, kept)
    assert queue.lowest() is None and not queue.buckets and not any(queue.low) and not any(queue.middle)


def _pop(queue, kept):
    rank = queue.lowest()
    place = heappop(queue.buckets[rank])
    if not queue.buckets[rank]:
        queue.drop(rank)
    assert (rank, place) == min(kept)
    kept.remove(min(kept))


def test_merges_of_pre_tokens_equal_the_library():
    rnd = random.Random(3)
    pieces, ids = [], []
    alphabets = ["ab", "aA", "theing", "é日本ß", "=-", "0123456789", "aeiou \n"]
    for k in range(1500):
        piece = "".join(rnd.choice(alphabets[k % len(alphabets)]) for _ in range(rnd.choice([1, 2, 3, 7, 30, 300])))
        want = tiktoken.Encoding("one", pat_str=r"[\s\S]+", mergeable_ranks=VOCABULARY.ranks, special_tokens={}) if k == 0 else want
        pieces.append(piece)
        ids.append(want.encode_ordinary(piece))
        if len(ids[-1]) > 1:
            assert merged(VOCABULARY, piece) == ids[-1]
    assert VOCABULARY.encode([pieces, [], pieces[:9]]) == [np.array(sum(x, []), np.int32).tobytes() for x in (ids, [], ids[:9])]
    some = [(p, i) for p, i in zip(pieces, ids) if len(i) > 1]
    assert [m.tolist() for m in VOCABULARY.merge([p.encode() for p, _ in some])] == [i for _, i in some]


def test_a_vocabulary_whose_lower_ranks_appear_late():
    """Joined parts may rank below what was merged before; ties go to the left."""
    rnd = random.Random(4)
    for _ in range(300):
        ranks = {bytes([i]): i for i in range(256)}
        words = {"".join(rnd.choice("ab") for _ in range(rnd.randint(2, 5))) for _ in range(12)}
        for n, word in enumerate(rnd.sample(sorted(words), len(words))):
            ranks[word.encode()] = 256 + n
        text = "".join(rnd.choice("ab") for _ in range(40))
        plain = tiktoken.Encoding("odd", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
        other = "".join(rnd.choice("ab") for _ in range(9))
        got = Vocabulary(ranks).merge([text.encode(), other.encode(), text.encode(), b"a"])
        assert [g.tolist() for g in got] == [plain.encode_ordinary(t) for t in (text, other, text, "a")]


def test_a_very_long_pre_token_takes_steps_in_proportion():
    piece = "".join(random.Random(5).choice("abcdefgh") for _ in range(200_000))
    assert merged(VOCABULARY, piece) == PLAIN.encode_ordinary(piece)
    assert VOCABULARY.decode(VOCABULARY.merge([b"a" * 100_000])[0]) == b"a" * 100_000


def test_texts_are_cut_as_the_library_cuts_them():
    rnd, split = random.Random(6), Splitter(tokenizers.PATTERN)
    new = ["՘", "\U000323b0", "Ᲊ", "\U00010d40", "\U00011bf0", "͸"]
    parts = ["a", "Z", "'s", "'re", "'", " ", "  ", "\n", "\t", " ", "　", "\x1c", "\x85", "1", "½", "٣", "é", "日", "!", "..", "​", *new]
    for _ in range(4000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 12)))
        ids = np.frombuffer(b"".join(VOCABULARY.encode(list(split(text)))), np.int32).tolist()
        assert ids == PLAIN.encode_ordinary(text), ascii(text)


def test_what_is_kept_does_not_matter(monkeypatch):
    from strata.llm import bytebpe

    monkeypatch.setattr(bytebpe, "CACHE", 5)
    own, rnd = Vocabulary(VOCABULARY.ranks), random.Random(7)
    for _ in range(300):
        pieces = ["".join(rnd.choice("abcx") for _ in range(rnd.randint(1, 6))) for _ in range(rnd.randint(0, 9))]
        want = [i for p in pieces for i in PLAIN.encode_ordinary(p)]
        assert np.frombuffer(own.encode([pieces])[0], np.int32).tolist() == want
        assert len(own._kept) < 20 and len(own._older) < 20


def test_every_document_of_the_table(spark):
    texts = {r.doc_id: r.text for r in read_table(spark, SF_SMALL, "documents").collect()}
    got = op13_byte_bpe(spark, SF_SMALL).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == {d: _digests(t) for d, t in texts.items()}
    assert len(got) == len(texts)


def test_odd_texts(spark):
    texts = [None, "", "a", "a", " " * 70_000, "x" * 300_000, "日本\x00" * 50, "<|endoftext|>", "word " * 100_000, "՘\U000323b0"]
    docs = brute.frame(spark, [(i if i != 3 else 2, t, None, None) for i, t in enumerate(texts)] + [(None, "b", None, None)], clash=True)
    encoded = encode_texts(docs, RANKS, tokenizers.PATTERN)
    got = [(r.doc_id, r.ids, bytes(r.decoded)) for r in decode_ids(encoded, RANKS).collect()]
    want = [(i if i != 3 else 2, t or "") for i, t in enumerate(texts)] + [(None, "b")]
    key = lambda x: (x[0] is None, x[0] or 0)
    assert sorted(got, key=key) == sorted(((d, PLAIN.encode_ordinary(t), t.encode()) for d, t in want), key=key)
    assert encode_texts(docs.where("false"), RANKS, tokenizers.PATTERN).count() == 0
    assert decode_ids(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>"), RANKS).first().decoded == b""
