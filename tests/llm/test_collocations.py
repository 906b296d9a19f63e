"""Phrase collocations by prefix-free parsing (13), against brute force."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tremor.llm import collocations as co

FOLD = {c: c + 32 for c in range(65, 91)}
PIECE, WORD = re.compile("[.,;:!?\x0a-\x0d]"), re.compile("[^ \t]+")


def pieces(text):
    return [WORD.findall(p) for p in PIECE.split((text or "").translate(FOLD))]


def counted(texts):
    f = Counter()
    for text in texts:
        for words in pieces(text):
            for k in range(1, 6):
                f.update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    return f


def brute(rows, min_count, cover=100, top=2000):
    texts = defaultdict(list)
    for lang, text in rows:
        texts[lang or "und"].append(text)
    out = []
    for lang, own in texts.items():
        f = counted(own)
        n = sum(c for g, c in f.items() if len(g) == 1)
        frequent = {g: a for g, a in f.items() if len(g) >= 2 and a >= min_count}
        covers = Counter()
        for g, a in frequent.items():
            for k in range(2, len(g)):
                for i in range(len(g) - k + 1):
                    covers[g[i:i + k]] = max(covers[g[i:i + k]], a)
        kept = []
        for g, a in frequent.items():
            if g in covers and 100 * covers[g] >= cover * a:
                continue
            score, cut = min((1000 * a * n // (f[g[:c]] * f[g[c:]]), c) for c in range(1, len(g)))
            kept.append((-score, -a, " ".join(g).encode(), f[g[:cut]], f[g[cut:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, n, -s) for i, (s, a, p, left, right) in enumerate(sorted(kept)[:top])]
    return sorted(out)


def corpus(seed, docs, words=14):
    rng = np.random.default_rng(seed)
    vocabulary = [*"The a of é Straße x\x00y 日本 Zoo # don't u-v".split(), *[f"w{i}" for i in range(words)]]
    weights = 1 / np.arange(1, len(vocabulary) + 1)
    rows, stock = [], "It is of The a kind that a zoo of w1 w2 w3 w4 w5 w6 w7 keeps for the w1 w2 w3"
    for _ in range(docs):
        text = "".join(w + str(rng.choice([" ", "  ", "\t", ". ", ",", "\n", " ! "], p=[.7, .05, .05, .08, .04, .04, .04]))
                       for w in rng.choice(vocabulary, rng.integers(0, 60), p=weights / weights.sum()))
        rows.append((str(rng.choice(["aa", "bb"])), text + stock if rng.random() < 0.3 else text))
    return rows + rows[: docs // 4]


def mined(spark, rows, **how):
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    return sorted(tuple(r) for r in co.collocations(docs, **how).collect())


@pytest.mark.parametrize("modulus,cover,top", [(1, 100, 2000), (7, 60, 2000), (32, 100, 5)])
def test_like_brute_force(spark, modulus, cover, top):
    rows = corpus(modulus, 160)
    expected = brute(rows, 12, cover, top)
    assert len(expected) > 8
    assert mined(spark, rows, min_count=12, cover_percent=cover, top=top, modulus=modulus) == expected


def test_a_filter_that_passes_all_changes_nothing(spark, monkeypatch):
    rows = corpus(3, 120)
    monkeypatch.setattr(co.PhraseFilter, "__init__", lambda self, phrases, k: (
        setattr(self, "words", np.full(64, 2**64 - 1, dtype=np.uint64)), setattr(self, "slots", 64)) and None)
    assert mined(spark, rows, min_count=9, modulus=5) == brute(rows, 9)


def test_large_numbers_are_exact(spark):
    """The score's product passes 64 bits."""
    found = spark.createDataFrame(
        [("en", None, 4_000_000_000_001, 0), ("en", "a", 3_000_000_000_007, 1), ("en", "b", 2_999_999_999_999, 1),
         ("en", "a b", 2_999_999_999_998, 2)], "lang string, phrase string, f long, k int")
    original = co.frequent_phrases
    co.frequent_phrases = lambda *a: found
    try:
        row = co.collocations(None).first()
    finally:
        co.frequent_phrases = original
    assert row.score == 1000 * row.a * row.n // (row.l * row.r) == 1333


@settings(max_examples=80, deadline=None)
@given(st.lists(st.sampled_from(["a", "B", "c ", "d.", " ", "\t", "é", "\n", "e f"]), max_size=80).map("".join), st.integers(1, 9),
       st.sampled_from([1, 5, 1 << 20]))
def test_each_phrase_begins_in_one_chunk(text, modulus, stretch):
    before, co._STRETCH = co._STRETCH, stretch
    try:
        chunks = [c.split(b" ") for c in co.parse(text.encode(), modulus)]
    finally:
        co._STRETCH = before
    f = Counter()
    for chunk in chunks:
        for k in range(1, 6):
            f.update(g for i in range(len(chunk) - co.OVERLAP) if co.MARK not in (g := tuple(chunk[i:i + k])))
    assert {tuple(w.decode() for w in g): c for g, c in f.items()} == counted([text])
    for one, two in zip(chunks, chunks[1:]):  # neighbours share their trigger window
        assert one[-co.OVERLAP:] == two[:co.OVERLAP] and len(one) > co.OVERLAP


def test_chunks_are_prefix_free_and_copies_parse_alike(spark):
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in rng.integers(0, 400, 4000)]
    passage = " ".join(words)
    one, two = (list(co.parse(t.encode(), 16)) for t in (passage + " end", "some other words before " + passage + " tail of it"))
    assert len(set(one) & set(two)) > 0.9 * len(set(one))
    assert not any(a != b and b.startswith(a + b" ") for a in one for b in one[:200])
    docs = spark.createDataFrame([("en", passage)] * 50 + [("fr", passage)], "lang string, text string")
    held = co.chunk_dictionary(docs, modulus=16).collect()
    assert Counter(r.copies for r in held if r.lang == "fr").keys() == {1}
    assert len(held) == 2 * len({r.chunk for r in held}) and all(r.copies % 50 == 0 for r in held if r.lang == "en")


def test_messy(spark, messy):
    rows = [(r.lang, r.text) for r in messy.collect()]
    got = co.collocations(messy, min_count=2)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 2)
    assert co.collocations(messy.limit(0)).collect() == []
    assert co.collocations(messy, min_count=10**6).collect() == []
