"""Line dedup (9), SimHash (10) and components, against brute force."""

from __future__ import annotations

import contextlib
import hashlib
import io
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tremor.llm import line_dedup, registry, simhash
from tremor.llm.graph import connected_components

SF = "/root/testdata/sf0.001"
SPACE = " \t\n\x0b\x0c\r"
FOLD = {c: c + 32 for c in range(65, 91)}


def brute_lines(rows):
    """Kept text per row for rows ``(id, text)``."""
    order = {d: i for i, d in enumerate(sorted({r[0] for r in rows}, key=lambda d: (d is None, d or 0)))}
    held = defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            held[line.strip(SPACE).translate(FOLD)].add(order[doc_id])
    return [(doc_id, [line for line in (text or "").split("\n")
                      if len(k := line.strip(SPACE).translate(FOLD)) < 10 or min(held[k]) == order[doc_id]],
             (text or "").count("\n") + 1) for doc_id, text in rows]


def as_rows(expected):
    return sorted((str(d), n, n - len(kept), "\n".join(kept)) for d, kept, n in expected)


@pytest.mark.parametrize("batches,fanout", [(1, 2), (4, 3), (7, 2)])
def test_line_dedup_batches_and_compaction(spark, batches, fanout):
    rng = np.random.default_rng(batches)
    pool = [f"shared line number {i} Of The Corpus" for i in range(40)] + ["short", "", "  tiny  "]
    rows = [(int(i), "\n".join(("  " * rng.integers(2)) + (line.upper() if rng.random() < 0.3 else line)
                               for line in rng.choice(pool, rng.integers(1, 12)))) for i in rng.permutation(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = line_dedup.drop_repeated_lines(docs, batches=batches, fanout=fanout).collect()
    assert sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.text) for r in got) == as_rows(brute_lines(rows))


def test_line_dedup_leaves_no_tables_and_scans_texts_twice(spark):
    docs = spark.createDataFrame([(i, f"a shared line of text\nline {i} of its own here") for i in range(60)], "doc_id long, text string")
    got = line_dedup.drop_repeated_lines(docs, batches=4, fanout=2)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("line_run_")]
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        got.explain("formatted")
    assert out.getvalue().split("\n\n")[0].count("Scan ExistingRDD") == 1  # the cut; the lines were written once before
    assert got.where("n_dropped = 1").count() == 59


def test_line_dedup_messy(spark, messy):
    rows = [(r.doc_id, r.text) for r in messy.collect()]
    got = line_dedup.drop_repeated_lines(messy, counts=False)
    assert got.columns == messy.columns
    assert sorted((str(r.doc_id), r.text) for r in got.collect()) == sorted((a, d) for a, _, _, d in as_rows(brute_lines(rows)))
    counted = line_dedup.drop_repeated_lines(messy).collect()
    assert sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.text) for r in counted) == as_rows(brute_lines(rows))
    assert line_dedup.drop_repeated_lines(messy.limit(0)).count() == 0


def test_one_very_common_line_and_a_long_text(spark):
    many = "\n".join(f"the line with number {i}" for i in range(20000))
    rows = [(i, "a line that every document has") for i in range(300)] + [(1000, many), (1001, many + "\nnew words only here")]
    got = line_dedup.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    by_id = {r.doc_id: r for r in got}
    assert [by_id[i].text for i in (0, 1, 299)] == ["a line that every document has", "", ""]
    assert (by_id[1000].n_dropped, by_id[1001].n_dropped, by_id[1001].text) == (0, 20000, "new words only here")


# --- SimHash -------------------------------------------------------------------------------

def brute_fingerprint(text, k=4):
    words = [w for w in "".join(" " if c in SPACE else c for c in (text or "").translate(FOLD)).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_roots(fps, radius):
    """Smallest index reachable, per fingerprint."""
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    values = np.array(fps, dtype=np.uint64)
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1:] ^ values[i]) <= radius) + i + 1:
            a, b = find(i), find(int(j))
            parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet=st.sampled_from("aBcé \n\t\x0b"), max_size=80))
def test_fingerprint_equals_brute_force(text):
    assert simhash.fingerprint(text, 4) == brute_fingerprint(text)


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_simhash_query(spark, sf):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    fps = [brute_fingerprint(t) for _, t in docs] if sf == SF else [simhash.fingerprint(t, 4) for _, t in docs]
    roots = brute_roots(fps, 4)
    want = {d: (f"{fp:016x}", docs[root][0]) for (d, _), fp, root in zip(docs, fps, roots)}
    rows = registry.op10_simhash(spark, sf).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == want and len(rows) == len(want)


@pytest.mark.parametrize("radius,spare,bucket_rows", [(4, 2, 4096), (4, 2, 16), (3, 1, 8), (7, 3, 64), (0, 1, 4096)])
def test_links_connect_what_brute_force_connects(spark, radius, spare, bucket_rows):
    rng = np.random.default_rng(radius * 10 + bucket_rows)
    base = rng.integers(0, 1 << 63, size=40, dtype=np.uint64)
    rows = [base]
    for _ in range(12):  # chains of growing distance, and one dense ball
        rows.append(rows[-1] ^ (np.uint64(1) << rng.integers(0, 64, size=40).astype(np.uint64))
                    ^ (np.uint64(1) << rng.integers(0, 64, size=40).astype(np.uint64)))
    ball = base[0] ^ (np.uint64(1) << rng.integers(0, 64, size=150).astype(np.uint64))
    fps = np.unique(np.concatenate([*rows, ball, [np.uint64(0)]]))
    frame = spark.createDataFrame([(int(v),) for v in fps.view(np.int64)], "fp long")
    links = simhash.fingerprint_links(frame, radius, spare, bucket_rows)
    pairs = [(r.a, r.b) for r in links.collect()]
    assert all(bin((a ^ b) & (1 << 64) - 1).count("1") <= radius for a, b in pairs)
    number = {int(v): i for i, v in enumerate(fps.view(np.int64))}
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        x, y = find(number[a]), find(number[b])
        parent[max(x, y)] = min(x, y)
    assert [find(i) for i in range(len(fps))] == brute_roots(fps.tolist(), radius)


def reach_of(near):
    """All pairs that lie in one component."""
    of = {}
    for a, b in near:
        merged = of.get(a, {a}) | of.get(b, {b})
        for x in merged:
            of[x] = merged
    return {(a, b) for group in of.values() for a in group for b in group if a < b}


def test_bucket_comparisons_agree_with_brute_force():
    rng = np.random.default_rng(2)
    for n in (2, 40, 64, 500):
        base = rng.integers(0, 1 << 63, size=n, dtype=np.uint64)
        fps = np.unique(np.concatenate([base, base ^ (np.uint64(3) << rng.integers(0, 60, size=n).astype(np.uint64))]))
        near = {(i, int(j)) for i in range(len(fps))
                for j in np.flatnonzero(np.bitwise_count(fps[i + 1:] ^ fps[i]) <= 4) + i + 1}
        if len(fps) <= simhash.SMALL_BUCKET:
            i, j = simhash.links_side_by_side(np.zeros(len(fps), int), fps, 4)
            assert set(zip(i.tolist(), j.tolist())) == near
        i, j = simhash.links_in_bucket(fps, 4)
        assert {(min(p), max(p)) for p in zip(i.tolist(), j.tolist())} <= reach_of(near)


def test_simhash_messy(spark, messy):
    rows = simhash.near_duplicate_classes(messy).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(r.doc_id) for r in messy.collect())
    of = defaultdict(set)
    for r in rows:
        of[r.doc_id].add(r.component_id)
    assert of[2] == {1} and of[3] == of[4] == of[5] == {3}
    kept = simhash.keep_one_of_each(messy)
    assert kept.columns == messy.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(
        {str(c) for v in of.values() for c in v if c is not None} | ({"None"} if {None} & of[None] else set()))
    assert simhash.keep_one_of_each(messy.limit(0)).count() == 0


def test_one_row_stays_of_nameless_copies(spark):
    rows = [(None, "only without an id, but a few times over", 1), (None, "only without an id, but a few times over", 2),
            (None, "with a copy that has an id of its own here", 3), (4, "with a copy that has an id of its own here", 4),
            (4, "with a copy that has an id of its own here", 5)]
    kept = simhash.keep_one_of_each(spark.createDataFrame(rows, "doc_id long, text string, fp int")).collect()
    assert sorted(str(r.doc_id) for r in kept) == ["4", "None"]
    assert {r.fp for r in kept if r.doc_id is None} <= {1, 2}


def test_components_of_a_chain_a_star_and_noise(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, i) for i in range(1001, 1400)] + [(7, 7), (2000, 1999), (2000, 1999)]
    rows = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {(r.node, r.root) for r in rows} == {(i, 0) for i in range(1, 61)} | {(i, 1000) for i in range(1001, 1400)} | {
        (2000, 1999)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_digest_is_of_the_kept_text(spark):
    rows = registry.op9_line_dedup(spark, SF).collect()
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = {d: (n, n - len(k), hashlib.sha256("\n".join(k).encode()).hexdigest()) for d, k, n in brute_lines(docs)}
    assert {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in rows} == want

