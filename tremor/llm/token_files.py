"""Token-id files with a minimal perfect hash index.

A table of shards, each one row: the raw ids of consecutive documents and an
index over their keys. Shards are written by Spark's own committer, so a lost
executor means a retried task and never a half-written shard, and they can live
in any store that Spark reaches.

Format of a shard (all integers little-endian):

* ``payload``: the ids of its documents, unsigned 32-bit, each document followed
  by the end id 0, in ascending key order with no gaps;
* ``keys``: the keys (``doc_id``, occurrence) in file order, two signed 64-bit each;
* ``seeds``: one signed 32-bit number per bucket of the minimal perfect hash;
* ``slots``: per slot of the hash, fingerprint, the document's first and last id
  position in the payload, and its number in ``keys`` (unsigned 32-bit each).

A key hashes to a bucket, its seed gives the slot; the slot's fingerprint turns
nearly all foreign keys away, and the stored key decides: constant time, no search.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tremor.llm.common import let_workers_import, shuffle_partitions
from tremor.llm.tokens import encoder

END_ID = 0
ID_BYTES = 4
KEYS_PER_BUCKET = 4
#: A null doc_id is stored as this with the occurrence counted from -1 down.
NULL_ID = 0
SHARD_SCHEMA = ("part int, shard long, part_start long, n_docs long, n_tokens long, min_id long, max_id long, "
                "keys binary, seeds binary, slots binary, payload binary")
_ARROW = pa.schema([("part", pa.int32()), ("shard", pa.int64()), ("part_start", pa.int64()), ("n_docs", pa.int64()),
                    ("n_tokens", pa.int64()), ("min_id", pa.int64()), ("max_id", pa.int64()), ("keys", pa.binary()),
                    ("seeds", pa.binary()), ("slots", pa.binary()), ("payload", pa.binary())])
_SLOT = np.dtype([("mark", "<u4"), ("begin", "<u4"), ("end", "<u4"), ("number", "<u4")])
#: Up to so many wanted ids each prune by a filter of their own that reaches the file's page statistics.
_PUSHED_IDS = 64


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = x.astype(np.uint64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def _key_hash(keys: np.ndarray) -> np.ndarray:
    """Hash of ``[n, 2]`` signed keys."""
    flat = np.ascontiguousarray(keys, dtype="<i8").view("<u8").reshape(-1, 2)
    return _mix(_mix(flat[:, 0] + np.uint64(0x9E3779B97F4A7C15)) + flat[:, 1])


def _position(h: np.ndarray, seed, n: int) -> np.ndarray:
    return (_mix(h + np.asarray(seed, dtype=np.uint64)) % np.uint64(n)).astype(np.int64)


def _bucket(h: np.ndarray, n_buckets: int) -> np.ndarray:
    return ((h >> np.uint64(32)) % np.uint64(n_buckets)).astype(np.int64)


def _mark(h: np.ndarray) -> np.ndarray:
    return (h & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def build_index(keys: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Minimal perfect hash of distinct ``[n, 2]`` keys by hash and displace.

    Buckets, largest first, try seeds 0, 1, … until all their keys meet free
    slots; a bucket of one key takes a free slot outright and stores it as
    ``-1 - slot``. ``ends[i]`` is the id position after document ``i``.
    Returns ``(seeds, slots)``.
    """
    n = len(keys)
    h = _key_hash(keys)
    n_buckets = -(-n // KEYS_PER_BUCKET)
    bucket = _bucket(h, n_buckets)
    seeds = np.zeros(n_buckets, dtype="<i4")
    order = np.argsort(bucket, kind="stable")
    sizes = np.bincount(bucket, minlength=n_buckets)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    taken = np.zeros(n, dtype=bool)
    slot_of = np.empty(n, dtype=np.int64)
    by_size = np.argsort(-sizes, kind="stable")
    for b in by_size[:int((sizes > 1).sum())]:
        own = order[starts[b]:starts[b + 1]]
        seed, step = 0, 16
        while True:  # the last buckets meet few free slots: twice as many seeds at once each time
            tries = np.arange(seed, seed + step)
            at = _position(h[own][None, :], tries[:, None], n)
            able = np.flatnonzero(~taken[at].any(axis=1))
            at_sorted = np.sort(at[able], axis=1)
            apart = np.flatnonzero((at_sorted[:, 1:] != at_sorted[:, :-1]).all(axis=1))
            if len(apart):
                k = int(able[apart[0]])
                break
            seed, step = seed + step, min(2 * step, 1 << 14)
        seeds[b] = tries[k]
        slot_of[own] = at[k]
        taken[at[k]] = True
    single = by_size[(sizes[by_size] == 1)]
    spare = np.flatnonzero(~taken)[:len(single)]
    seeds[single] = -1 - spare
    slot_of[order[starts[single]]] = spare
    slots = np.empty(n, dtype=_SLOT)
    begins = np.concatenate([[0], ends[:-1]])
    slots["mark"][slot_of], slots["begin"][slot_of], slots["end"][slot_of] = _mark(h), begins, ends
    slots["number"][slot_of] = np.arange(n)
    return seeds, slots


def lookup(keys: np.ndarray, seeds: np.ndarray, slots: np.ndarray, stored: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Id positions ``(begin, end)`` of ``[n, 2]`` keys; ``(-1, -1)`` where a key
    is not among the shard's ``stored`` ones."""
    h = _key_hash(keys)
    seed = seeds[_bucket(h, len(seeds))].astype(np.int64)
    at = np.where(seed < 0, -1 - seed, _position(h, np.maximum(seed, 0), len(slots)))
    got = slots[at]
    known = got["mark"] == _mark(h)
    known &= (stored[got["number"]] == keys).all(axis=1)
    return np.where(known, got["begin"].astype(np.int64), -1), np.where(known, got["end"].astype(np.int64), -1)


class _Shard:
    def __init__(self):
        self.keys: list[tuple[int, int]] = []
        self.ends: list[int] = []
        self.parts: list[bytes] = []
        self.tokens = 0

    def add(self, key, ids: bytes) -> None:
        self.keys.append(key)
        self.tokens += len(ids) // ID_BYTES
        self.ends.append(self.tokens)
        self.parts.append(ids)

    def row(self, part: int, number: int, part_start: int) -> tuple:
        keys = np.array(self.keys, dtype="<i8").reshape(-1, 2)
        seeds, slots = build_index(keys, np.array(self.ends, dtype=np.int64))
        known = keys[keys[:, 1] >= 0, 0]
        low, high = (int(known[0]), int(known[-1])) if len(known) else (None, None)
        return (part, number, part_start, len(keys), self.tokens, low, high, keys.tobytes(), seeds.tobytes(),
                slots.tobytes(), b"".join(self.parts))


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, id_col: str = "doc_id",
                      text_col: str = "text", shard_tokens: int = 65_536, partitions: int | None = None) -> None:
    """Encode every text and write the shards under ``path`` in ascending id order.

    One range shuffle of ``(id, text)``; each task then streams its sorted rows
    and holds one shard at a time. A document is never split over shards, so a
    shard may exceed ``shard_tokens`` by one document.

    Null and empty texts are the end id alone. Rows of one id are adjacent and
    told apart by an occurrence number within their shard; the range bounds
    carry a random salt, so many rows of one id spread over tasks. Null ids come
    first. An empty table writes an empty table. Other columns are not read.
    """
    let_workers_import(docs.sparkSession)
    n = partitions or shuffle_partitions(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_all = encoder(tokenizer_path).encode_all
        end = END_ID.to_bytes(ID_BYTES, "little")
        part, number, written, shard, last, seen = TaskContext.get().partitionId(), 0, 0, _Shard(), object(), 0

        def out():
            row = shard.row(part, number, written)
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, _ARROW.types)], schema=_ARROW)

        for batch in batches:
            ids, texts = batch.columns
            for doc_id, encoded in zip(ids.to_pylist(), encode_all(texts)):
                if shard.tokens >= shard_tokens:
                    yield out()
                    number, written, shard, last = number + 1, written + shard.tokens, _Shard(), object()
                seen, last = (seen + 1, last) if doc_id == last else (0, doc_id)
                shard.add((NULL_ID, -1 - seen) if doc_id is None else (doc_id, seen), encoded + end)
        if shard.keys:
            yield out()

    (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
     .withColumn("salt", F.rand(7))
     .repartitionByRange(n, "doc_id", "salt")
     .sortWithinPartitions("doc_id", "salt")
     .select("doc_id", "text")
     .mapInArrow(run, SHARD_SCHEMA)
     .write.parquet(path))


def _part_bases(shards: DataFrame) -> DataFrame:
    """Ids before each part; one row per part of the range shuffle."""
    totals = shards.groupBy("part").agg(F.sum("n_tokens").alias("tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("part_base"))


def read_token_files(spark: SparkSession, path: str, checksums: bool = False) -> DataFrame:
    """Every document of the files: ``doc_id, start`` (ids before it in the whole
    output), ``n_tokens, ids``. Each is found through the index by its key. With
    ``checksums``, ``ids_crc32`` of the ids read stands for them."""
    let_workers_import(spark)
    shards = spark.read.parquet(path)

    def run(batches):
        last = ("ids_crc32", pa.int64()) if checksums else ("ids", pa.binary())
        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), last])
        for batch in batches:
            for i in range(batch.num_rows):
                start, keys, seeds, slots, payload = (c[i].as_py() for c in batch.columns)
                keys = np.frombuffer(keys, dtype="<i8").reshape(-1, 2)
                begin, end = lookup(keys, np.frombuffer(seeds, dtype="<i4"), np.frombuffer(slots, dtype=_SLOT), keys)
                ids = [None if seen < 0 else key for key, seen in keys.tolist()]
                cut = [payload[b * ID_BYTES:e * ID_BYTES] for b, e in zip(begin.tolist(), end.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(begin + start), pa.array(end - begin),
                     pa.array(list(map(crc32, cut)) if checksums else cut, schema.types[3])], schema=schema)

    return (shards.join(F.broadcast(_part_bases(shards)), "part")
            .select((F.col("part_base") + F.col("part_start")).alias("start"), "keys", "seeds", "slots", "payload")
            .mapInArrow(run, f"doc_id long, start long, n_tokens long, {'ids_crc32 long' if checksums else 'ids binary'}"))


def find_documents(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """Keyed access: ``doc_id, occurrence, ids`` of the given ids.

    Only shards whose id range holds a wanted id are kept, by filters that reach
    the files' statistics; of those each key costs one probe, checked against
    the stored key. Ids that are not stored give no row, an empty list no rows.
    Rows of one id all come back; their occurrence counts within a shard, so it
    starts again where they go on in the next. Documents with a null id have no
    key to be asked for (``read_token_files`` returns them).
    """
    let_workers_import(spark)
    wanted = sorted(set(doc_ids))

    def run(batches):
        schema = pa.schema([("doc_id", pa.int64()), ("occurrence", pa.int64()), ("ids", pa.binary())])
        for batch in batches:
            for i in range(batch.num_rows):
                low, high, stored, seeds, slots, payload = (c[i].as_py() for c in batch.columns)
                stored = np.frombuffer(stored, dtype="<i8").reshape(-1, 2)
                seeds, slots = np.frombuffer(seeds, dtype="<i4"), np.frombuffer(slots, dtype=_SLOT)
                rows, seen = [], 0
                keys = np.array(wanted[bisect_left(wanted, low):bisect_right(wanted, high)], dtype=np.int64)
                while len(keys):
                    begin, end = lookup(np.stack([keys, np.full(len(keys), seen)], 1), seeds, slots, stored)
                    hit = begin >= 0
                    rows += [(k, seen, payload[b * ID_BYTES:e * ID_BYTES]) for k, b, e in
                             zip(keys[hit].tolist(), begin[hit].tolist(), end[hit].tolist())]
                    keys, seen = keys[hit], seen + 1
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)],
                                                     schema=schema)

    near = F.lit(False)
    if len(wanted) <= _PUSHED_IDS:
        for k in wanted:
            near = near | ((F.col("min_id") <= k) & (F.col("max_id") >= k))
    else:
        ids = F.array(*map(F.lit, wanted)).cast("array<bigint>")
        near = ((F.col("min_id") <= wanted[-1]) & (F.col("max_id") >= wanted[0])
                & F.exists(ids, lambda k: (F.col("min_id") <= k) & (F.col("max_id") >= k)))
    return (spark.read.parquet(path).where(near).select("min_id", "max_id", "keys", "seeds", "slots", "payload")
            .mapInArrow(run, "doc_id long, occurrence long, ids binary"))
