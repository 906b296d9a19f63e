"""Source divergence audit (11), against brute force."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tremor.llm import divergence

FOLD = {c: c + 32 for c in range(65, 91)}
TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def brute(rows, min_docs, top=50):
    """Result rows for documents ``(lang, source, text)``."""
    count, held = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        terms = [t.translate(FOLD) for t in TERM.findall(text or "")]
        count[(lang or "", source or "")].update(terms)
        held[lang or ""].update(set(terms))
    out = []
    for lang in held:
        kept = [t for t, n in held[lang].items() if n >= min_docs]
        sources = [s for g, s in count if g == lang]

        def shares(counts):
            total = sum(counts[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 1_000_000_000 * (counts[t] + 5) // total for t in kept}

        p = {s: shares(count[(lang, s)]) for s in sources}
        q = shares(sum((count[(lang, s)] for s in sources), Counter()))
        for s in sources:
            parts = {
                "pair": [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s],
                "term": [(p[s][t] - q[t], t) for t in kept if count[(lang, s)][t] and p[s][t] > q[t]],
            }
            for part, values in parts.items():
                values.sort(key=lambda v: (-v[0], v[1].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(values)
                        if part == "pair" or i < top]
    return sorted(out)


def audit(spark, rows, **how):
    docs = spark.createDataFrame(rows, "lang string, source string, text string").repartition(4)
    return sorted(tuple(r) for r in divergence.audit_sources(docs, **how).collect())


def corpus(seed, sources, words, docs):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(docs):
        lang, s = rng.choice(["aa", "bb"]), int(rng.integers(sources) * rng.random())
        own = [f"{chr(97 + int(w) % 26)}{'xyzé'[int(w) // 26 % 4]}{'Q' * (int(w) % 3)}" for w in rng.integers(0, words, 30) + s]
        rows.append((str(lang), f"s{s}", "; ".join(own)))
    return rows


@pytest.mark.parametrize("sources,strip,block", [(3, 16, 512), (40, 32, 16), (25, 2048, 8)])
def test_like_brute_force(spark, sources, strip, block):
    rows = corpus(sources, sources, 120, 250)
    expected = brute(rows, 3)
    assert len(expected) > sources * 50
    assert audit(spark, rows, min_docs=3, strip_columns=strip, block_rows=block) == expected


def test_salted_groups(spark, monkeypatch):
    rows = corpus(5, 6, 60, 120)
    monkeypatch.setattr(divergence, "MAX_BROADCAST_ROWS", 0)
    assert audit(spark, rows, min_docs=2) == brute(rows, 2)


def test_no_kept_terms_groups_without_terms_and_nulls(spark):
    rows = [("en", "a", "one two"), ("en", "b", "123 .. "), ("en", None, None), (None, None, "é É ß One"), (None, "x", "one É"),
            ("fr", "only", "seul seul")]
    for min_docs in (1, 2, 30):
        assert audit(spark, rows, min_docs=min_docs) == brute(rows, min_docs)
    assert audit(spark, rows[:1], min_docs=1) == brute(rows[:1], 1)


def test_messy(spark, messy):
    rows = [(r.lang, r.source, r.text) for r in messy.collect()]
    got = divergence.audit_sources(messy, min_docs=1)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 1)
    assert divergence.audit_sources(messy.limit(0)).collect() == []


def test_flushed_counts_and_cut_texts(spark, monkeypatch):
    text = " ".join(f"Wört{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}" for i in range(700))
    for stretch in (1, 7, 100, 1 << 20):
        monkeypatch.setattr(divergence, "_STRETCH", stretch)
        cut = [t for part in divergence.text_terms(text.encode()) for t in part]
        assert [t.decode() for t in cut] == [t.translate(FOLD) for t in TERM.findall(text)]


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 40), st.integers(1, 30), st.integers(0, 70), st.floats(0, 1), st.integers(0, 10**6))
def test_trees_price_every_pair(n, m, width, density, seed):
    rng = np.random.default_rng(seed)
    size = 64 if width <= 64 else 128

    def side(rows):
        zero = rng.integers(1, 50, rows)
        filled = rng.random((rows, width)) < density * rng.random((rows, 1))
        r, c = np.nonzero(filled)
        values = rng.integers(50, 10**9, len(r))
        dense = np.repeat(zero[:, None], width, axis=1)
        dense[r, c] = values
        return divergence.K2Tree(r, c, values, zero, size), dense

    (a, da), (b, db) = side(n), side(m)
    got = divergence.row_distances(a, b, width, batch=7)[:n, :m]
    assert (got == np.abs(da[:, None, :] - db[None, :, :]).sum(axis=2)).all()
    own = divergence.row_distances(a, a, width)[:n, :n]
    assert (np.triu(own, 1) == np.triu(np.abs(da[:, None, :] - da[None, :, :]).sum(axis=2), 1)).all()


def test_zero_quadrants_are_never_opened():
    """Two groups with terms of their own: the walk opens no leaf that both leave empty."""
    one = divergence.K2Tree(np.zeros(8, int), np.arange(8), np.full(8, 9), np.array([2]), 4096)
    two = divergence.K2Tree(np.zeros(8, int), 4088 + np.arange(8), np.full(8, 7), np.array([3]), 4096)
    opened = []
    leaf = one.leaf
    one.leaf = lambda at, there, r: opened.append(len(r)) or leaf(at, there, r)
    assert divergence.row_distances(one, two, 4096)[0, 0] == 8 * 6 + 8 * 5 + 4080
    assert opened == [2]
