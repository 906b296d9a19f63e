"""Packing (4) and token files (6): exact round trips against the tokenizers library."""

from __future__ import annotations

import contextlib
import io
import subprocess
import sys
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tremor.llm import packing, registry, token_files, tokens
from tremor.llm.tokens import TextEncoder

PATH = public_tokenizers.path(registry.TOKENIZER)
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return lambda text: np.array([*t.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")


@pytest.fixture(scope="module")
def fast():
    return TextEncoder(PATH)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("abcXYZ éñ日\n\t\r\x0b\u00a0\u2003.,'’sdrevml0123#!|<>_-😀"), max_size=60))
def test_word_cache_equals_the_library(plain, fast, text):
    assert fast.encode(text) == plain(text)[:-1].tobytes()


@pytest.mark.parametrize("text", [" a", "a ", "a  b", "a\n\nb", "a\n b", "it's 's don't\n's x", "  x", "a\x1cb c",
                                  "<|endoftext|> x", "x\u0300 y", "١٢ a", "", None])
def test_odd_texts(plain, fast, text):
    assert fast.encode(text) == plain(text)[:-1].tobytes()


def check_pieces(rows, texts, plain, seq_len=1024):
    """Every id once, sequences gapless from 0; returns padding and tokens."""
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    for doc_id, text in texts.items():
        ids, at = plain(text), 0
        for r in sorted(by_doc.pop(doc_id), key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    padding = total = 0
    for rows in by_seq.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= seq_len
        total += at
        padding += 0 if at & (at - 1) == 0 else seq_len - at
    return by_doc, padding, total


def test_packing_round_trip(spark, plain):
    rows = registry.op4_packing(spark, SF).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    left, padding, total = check_pieces(rows, texts, plain)
    assert not left and padding < 0.02 * total


def test_packing_messy(spark, plain, messy):
    rows = packing.piece_digest(packing.pack_documents(messy, PATH, window_tokens=5000)).collect()
    texts = {r.doc_id: r.text for r in messy.collect() if r.doc_id not in (2, None)}
    left, _, total = check_pieces([r for r in rows], texts | {}, plain)
    assert set(left) == {2, None}
    assert total == sum(len(plain(r.text)) for r in messy.collect())
    assert packing.pack_documents(messy.limit(0), PATH).count() == 0


def test_balance_takes_the_cheapest_sequence_with_room():
    placed, cost = packing.balance([600, 500, 400, 300, 200], 1024, 1.0, 1 / 2048)
    assert [p[:4] for p in placed] == [(0, 0, 600, 0), (1, 0, 500, 1), (2, 0, 400, 1), (3, 0, 300, 0), (4, 0, 124, 1),
                                       (4, 124, 76, 0)]
    assert cost == pytest.approx([600 + 300 + 76 + (600**2 + 300**2 + 76**2) / 2048,
                                  500 + 400 + 124 + (500**2 + 400**2 + 124**2) / 2048])


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 63), max_size=60))
def test_balance_places_everything_without_waste(lengths):
    placed, cost = packing.balance(lengths, 64, 1.0, 0.01)
    assert len(cost) == -(-sum(lengths) // 64)
    used = defaultdict(int)
    for piece, start, length, seq, offset in placed:
        assert offset == used[seq]
        used[seq] += length
    assert all(v <= 64 for v in used.values())
    assert sum(used.values()) == sum(lengths)


def test_files_round_trip(spark, plain):
    rows = registry.op6_token_files(spark, SF).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got, start, want = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in rows}, 0, {}
    for doc_id in sorted(texts):
        ids = plain(texts[doc_id])
        want[doc_id] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert got == want and len(rows) == len(want)


def test_files_messy(spark, plain, messy, tmp_dir):
    token_files.write_token_files(messy, f"{tmp_dir}/t", PATH, shard_tokens=50, partitions=3)
    rows = token_files.read_token_files(spark, f"{tmp_dir}/t").collect()
    want = sorted((r.doc_id is not None, r.doc_id or 0, len(plain(r.text)), plain(r.text).tobytes())
                  for r in messy.collect())
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens, bytes(r.ids)) for r in rows) == want
    at = 0
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    assert [r.doc_id or 0 for r in sorted(rows, key=lambda r: r.start)] == [w[1] for w in want]
    found = token_files.find_documents(spark, f"{tmp_dir}/t", [2, 6, 77, -1]).collect()
    assert sorted(r.doc_id for r in found) == [2, 2, 6]
    assert all(bytes(r.ids) == plain(next(m.text for m in messy.collect() if m.doc_id == r.doc_id)).tobytes()
               for r in found)


def test_files_of_an_empty_table(spark, messy, tmp_dir):
    token_files.write_token_files(messy.limit(0), f"{tmp_dir}/t", PATH)
    assert token_files.read_token_files(spark, f"{tmp_dir}/t").count() == 0


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(-2**63, 2**63 - 1), min_size=1, max_size=300))
def test_perfect_hash_is_minimal_and_tells_foreign_keys(ids):
    keys = np.stack([np.array(sorted(ids), dtype="<i8"), np.zeros(len(ids), dtype="<i8")], 1)
    ends = np.cumsum(np.arange(1, len(ids) + 1))
    seeds, slots = token_files.build_index(keys, ends)
    begin, end = token_files.lookup(keys, seeds, slots, keys)
    assert len(slots) == len(ids) and (end == ends).all() and (begin == np.concatenate([[0], ends[:-1]])).all()
    foreign = np.stack([keys[:, 0], keys[:, 1] + 1], 1)
    assert (token_files.lookup(foreign, seeds, slots, keys)[0] == -1).all()
    slots["mark"] = token_files._mark(token_files._key_hash(foreign))[slots["number"]]  # a foreign key with a stored fingerprint
    assert (token_files.lookup(foreign, seeds, slots, keys)[0] == -1).all()


def test_find_documents_prunes_shards(spark, tmp_dir, plain):
    docs = spark.range(0, 4000, 2).selectExpr("id AS doc_id", "concat('text number ', id) AS text")
    token_files.write_token_files(docs, f"{tmp_dir}/t", PATH, shard_tokens=200, partitions=3)
    for wanted in ([], [1, 3], [8, 1998, 3001], list(range(0, 4000, 20))):
        found = token_files.find_documents(spark, f"{tmp_dir}/t", wanted)
        rows = found.collect()
        assert sorted(r.doc_id for r in rows) == [k for k in wanted if k % 2 == 0]
        assert all(bytes(r.ids) == plain(f"text number {r.doc_id}").tobytes() for r in rows)
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        token_files.find_documents(spark, f"{tmp_dir}/t", [8, 1998]).explain("formatted")
    assert "LessThanOrEqual(min_id,8)" in out.getvalue() and "GreaterThanOrEqual(max_id,1998)" in out.getvalue()


def test_the_word_cache_is_bounded_in_bytes():
    cache = TextEncoder(PATH, cache_bytes=64 << 10)
    texts = [" ".join(f"w{i * 7919 + k}q" for k in range(400)) for i in range(40)]
    wide = TextEncoder(PATH)
    for text in texts + texts:
        assert cache.encode(text) == wide.encode(text)
        for words in (cache._first, cache._later):
            held = sum(len(w) + len(ids) for half in (words.young, words.old) for w, ids in half.items())
            assert held <= 2 * words.half


@settings(max_examples=60, deadline=None)
@given(st.lists(st.none() | st.text(alphabet=st.sampled_from("abcé日 \n\t\u00a0.,'’s1#!"), max_size=20), max_size=20),
       st.sampled_from([1, 30, 1 << 20]))
def test_texts_encoded_together_equal_the_library(plain, texts, slice_bytes):
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(tokens, "SLICE_BYTES", slice_bytes)
        patch.setattr(tokens, "_GATHERED", 3)
        tiny = TextEncoder(PATH, cache_bytes=300)  # words are forgotten all the time
        for kind in (pa.string(), pa.large_string()):
            padded = pa.array(["left out", *texts, "left out"], kind)
            assert list(tiny.encode_all(padded.slice(1, len(texts)))) == [plain(t)[:-1].tobytes() for t in texts]


def test_each_word_of_a_slice_is_encoded_once():
    encoder, met = TextEncoder(PATH), []
    tokenize = encoder._tokenize
    encoder._tokenize = lambda part: met.append(part) or tokenize(part)
    words = [f"w{chr(97 + k)}x" for k in range(20)]
    texts = pa.array([" ".join(words[k % 20:] + words[:k % 20]) for k in range(200)])
    for _ in range(2):  # the second time all are remembered
        assert len(list(encoder.encode_all(texts))) == 200
    assert len(met) == len(set(met)) == 40  # at the start of a line, and behind a space


def test_remembered_words_cost_what_is_counted():
    """Two workers of an executor share what its heap leaves of 3000 MB."""
    encoder = TextEncoder(PATH, cache_bytes=1 << 20)
    for k in range(30):
        list(encoder.encode_all(pa.array([" ".join(f"{k}q{i}" for i in range(3000))])))
        kept = encoder._later
        held = kept.words.nbytes + kept.ends.nbytes + kept.ids.nbytes + kept.used.nbytes
        assert held <= 1 << 20 and len(kept.ends) == len(kept.words) + 1 == len(kept.used) + 1
    assert tokens.CACHE_BYTES <= 32 << 20


#: Prints the MB that a worker keeps beside its vocabulary after tasks of three batches.
TASKS = r"""
import sys
import pyarrow as pa
from tremor.llm import packing
from tremor.llm.tokens import encoder

def held():
    return int(open("/proc/self/status").read().split("RssAnon:")[1].split()[0]) >> 10

class Docs:  # hands over what the operator runs on its batches
    sparkSession = None
    def select(self, *_): return self
    def mapInArrow(self, run, _): return run

class Task:
    def partitionId(self): return 0

packing.let_workers_import = lambda _: None
packing.TaskContext.get = lambda: Task()
packing.F.col = lambda _: type("Col", (), {"cast": lambda s, _: s, "alias": lambda s, _: s})()
run = packing.pack_documents(Docs(), sys.argv[1])

def batches(n, docs):
    for k in range(n):
        texts = [" ".join(f"word{(i * 7 + k) % 3000}" for i in range(j, j + 4000)) for j in range(docs)]
        yield pa.RecordBatch.from_arrays([pa.array(range(docs)), pa.array(texts)], names=["doc_id", "text"])

print(sum(b.num_rows for b in run(batches(1, 1))))
before = held()
print(sum(b.num_rows for b in run(batches(3, 400))))
print(held() - before)
"""


def test_a_task_gives_back_the_memory_it_took():
    """A worker lives on beside the heap of later stages; its allocators keep what is freed."""
    root = str(Path(tokens.__file__).resolve().parents[2])
    done = subprocess.run([sys.executable, "-c", TASKS, PATH], cwd=root, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    first, then, kept = map(int, done.stdout.split())
    assert first and then > 1200 and kept < 40, done.stdout
