"""SimHash near-duplicates with bit-sliced comparison.

Fingerprints of ``bits`` bits link at ``radius`` or fewer differing bits. The
bits are cut into ``radius + spare`` blocks: two linked fingerprints agree on at
least ``spare`` whole blocks, so every choice of ``spare`` blocks is a table of
buckets, and all links lie inside buckets.

A task streams its sorted buckets. Fingerprints lie vertically, one machine word
per bit position holding that bit of 64 of them; comparing XORs bit planes and
adds them into carry-save bitwise counters, 64 distances per word operation, and
words whose 64 distances all exceed the radius are abandoned. Buckets above
``bucket_rows`` are dealt in chunks, and each pair of chunks is a bucket of its
own, so no task holds an unbounded bucket and no pair is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremor.llm.common import releasing, shuffle_partitions, stored
from tremor.llm.graph import connected_components

BITS = 64
SEED = 42
#: Buckets up to this size are compared side by side, larger ones row against bucket.
SMALL_BUCKET = 64
#: Bit planes added between two looks for words to abandon.
PLANES_PER_LOOK = 8
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: str | None, shingle_words: int) -> int:
    """Unsigned fingerprint: a bit is 1 if set in over half the shingle hashes.

    A-Z are lower-cased, words split at ASCII white space, shingles joined by a
    space and counted with repeats; a text of fewer words is one shingle, one
    of no words has fingerprint zero."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle_words:
        shingles = [joined]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
        begins = [0, *(ends[:-shingle_words] + 1).tolist()]
        shingles = [joined[s:e] for s, e in zip(begins, ends[shingle_words - 1:].tolist())]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), dtype="<u8", count=len(shingles))
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at:at + (1 << 14)]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle_words: int = 4) -> DataFrame:
    """``doc_id, fp`` of every row; ``fp`` is the fingerprint as a signed long."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def run(batches):
        for batch in batches:
            fps = np.fromiter((fingerprint(t.as_py(), shingle_words) for t in batch.column(1)), dtype="<u8",
                              count=batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view("<i8"))], schema=schema)

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(
        releasing(run), "doc_id long, fp long")


def block_masks(radius: int, spare: int, bits: int = BITS) -> list[int]:
    """Bit masks of the bucket tables: every choice of ``spare`` of the blocks."""
    n = radius + spare
    edges = [bits * i // n for i in range(n + 1)]
    blocks = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in combinations(blocks, spare)]


def _planes(fps: np.ndarray) -> np.ndarray:
    """``[64, words]``: bit ``j`` of word ``w`` of plane ``b`` is bit ``b`` of fingerprint ``64 w + j``."""
    padded = np.zeros(-(-len(fps) // 64) * 64, dtype="<u8")
    padded[:len(fps)] = fps
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8")


def _words(flags: np.ndarray) -> np.ndarray:
    padded = np.zeros(-(-len(flags) // 64) * 64, dtype=bool)
    padded[:len(flags)] = flags
    return np.packbits(padded, bitorder="little").view("<u8")


class _Counters:
    """Carry-save counters of many distances, saturating above ``radius``."""

    def __init__(self, n_words: int, radius: int):
        self.radius = radius
        self.bits = [np.zeros(n_words, dtype=np.uint64) for _ in range(max(1, radius.bit_length()))]
        self.over = np.zeros(n_words, dtype=np.uint64)

    def add(self, carry: np.ndarray) -> None:
        for i, held in enumerate(self.bits):
            self.bits[i], carry = held ^ carry, held & carry
        self.over |= carry

    def within(self) -> np.ndarray:
        above, equal = self.over, np.full_like(self.over, _ALL)
        for i in range(len(self.bits) - 1, -1, -1):
            if self.radius >> i & 1:
                equal = equal & self.bits[i]
            else:
                above = above | equal & self.bits[i]
                equal = equal & ~self.bits[i]
        return ~above

    def keep(self, at: np.ndarray) -> None:
        self.bits = [b[at] for b in self.bits]
        self.over = self.over[at]


def _near(plane_xor, wanted: np.ndarray, words: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Words that still hold a distance within the radius, and those lanes.

    ``plane_xor(b, words)`` gives plane ``b`` of the differences, ``wanted`` the
    lanes to compare in each of ``words``."""
    counters = _Counters(len(words), radius)
    for b in range(BITS):
        counters.add(plane_xor(b, words))
        if b % PLANES_PER_LOOK == PLANES_PER_LOOK - 1:
            alive = counters.within() & wanted
            at = np.flatnonzero(alive)
            if len(at) < len(words):  # abandon the words whose distances all exceed the radius
                words, wanted, alive = words[at], wanted[at], alive[at]
                counters.keep(at)
                if not len(words):
                    break
    return words, counters.within() & wanted


def _lanes(words: np.ndarray, alive: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(alive.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    row, lane = np.nonzero(bits)
    return words[row] * 64 + lane


def links_side_by_side(group: np.ndarray, fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows ``(i, j)`` of one group within the radius, for groups of up to 64
    adjacent rows: all rows are compared to the row ``lag`` further at once."""
    planes = _planes(fps)
    planes = np.concatenate([planes, np.zeros((BITS, 1), dtype=np.uint64)], axis=1)
    left, right = [], []
    for lag in range(1, len(fps)):
        same = group[lag:] == group[:-lag]
        if not same.any():
            break
        wanted = _words(same)
        words = np.flatnonzero(wanted)
        low, high = np.uint64(lag), np.uint64(64 - lag)

        def differing(b, at, low=low, high=high):
            here = planes[b]
            return here[at] ^ (here[at] >> low | here[at + 1] << high)

        i = _lanes(*_near(differing, wanted[words], words, radius))
        left.append(i)
        right.append(i + lag)
    return (np.concatenate(left), np.concatenate(right)) if left else (np.empty(0, int), np.empty(0, int))


def links_in_bucket(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links ``(root, member)`` of a large bucket: rows reached so far
    are compared, one at a time, with those that nothing has reached yet."""
    planes, n = _planes(fps), len(fps)
    free = np.ones(n, dtype=bool)
    left, right = [], []
    for root in range(n):
        if not free[root]:
            continue
        free[root] = False
        reached = [root]
        while reached and free.any():
            at = reached.pop()
            wanted = _words(free)
            words = np.flatnonzero(wanted)
            own = [_ALL if int(fps[at]) >> b & 1 else np.uint64(0) for b in range(BITS)]
            hits = _lanes(*_near(lambda b, w, own=own: planes[b][w] ^ own[b], wanted[words], words, radius))
            free[hits] = False
            reached += hits.tolist()
            left.append(np.full(len(hits), root))
            right.append(hits)
        if not free.any():
            break
    return (np.concatenate(left), np.concatenate(right)) if left else (np.empty(0, int), np.empty(0, int))


def _bucket_links(group: np.ndarray, fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among whole sorted buckets."""
    border = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    sizes = np.diff(np.append(border, len(group)))
    of_row = np.repeat(sizes, sizes)
    rows = np.flatnonzero((of_row > 1) & (of_row <= SMALL_BUCKET))
    i, j = links_side_by_side(group[rows], fps[rows], radius) if len(rows) else (rows, rows)
    ends = [(fps[rows[i]], fps[rows[j]])]
    for at, size in zip(border[sizes > SMALL_BUCKET].tolist(), sizes[sizes > SMALL_BUCKET].tolist()):
        own = fps[at:at + size]
        i, j = links_in_bucket(own, radius)
        ends.append((own[i], own[j]))
    return np.concatenate([e[0] for e in ends]), np.concatenate([e[1] for e in ends])


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def fingerprint_links(fps: DataFrame, radius: int = 4, spare: int = 2, bucket_rows: int = 4096) -> DataFrame:
    """Links ``(a, b)`` that connect all distinct ``fp`` within ``radius`` bits.

    Every pair of fingerprints within the radius is joined by a chain of the
    links returned, and every link is within the radius."""
    n = shuffle_partitions(fps.sparkSession)
    tables = [F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
              for i, m in enumerate(block_masks(radius, spare))]
    keyed = fps.select("fp").distinct().select("fp", F.explode(F.array(*tables)).alias("k")).select("fp", "k.t", "k.key")
    large = (keyed.groupBy("t", "key").agg(F.count("*").alias("rows")).where(F.col("rows") > bucket_rows)
             .select("t", "key", F.ceil(F.col("rows") / bucket_rows).cast("int").alias("chunks")))
    dealt = keyed.join(large, ["t", "key"], "left").withColumn(
        "own", F.when(F.col("chunks").isNotNull(), F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")))
    other: Column = F.when(F.col("chunks").isNull(), F.array(F.lit(-1))).otherwise(
        F.filter(F.sequence(F.lit(0), F.coalesce(F.col("chunks"), F.lit(1)) - 1), lambda c: c != F.col("own")))
    buckets = (dealt.select("fp", "t", "key", "own", F.explode(other).alias("other"))
               .select(F.xxhash64("t", "key", F.least("own", "other"), F.greatest("own", "other")).alias("bucket"), "fp"))
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def links(group, own):
        a, b = _bucket_links(group, own.view("<u8"), radius)
        return pa.RecordBatch.from_arrays([pa.array(a.view("<i8")), pa.array(b.view("<i8"))], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, own = np.empty(0, dtype="<i8"), np.empty(0, dtype="<i8")
        for batch in batches:
            group = np.concatenate([group, batch.column(0).to_numpy()])
            own = np.concatenate([own, batch.column(1).to_numpy()])
            cut = int(np.searchsorted(group, group[-1])) if len(group) else 0
            if cut:
                yield links(group[:cut], own[:cut])
                group, own = group[cut:], own[cut:]
        if len(group):
            yield links(group, own)

    return (buckets.repartition(n, "bucket").sortWithinPartitions("bucket", "fp")
            .mapInArrow(releasing(run), "a long, b long").distinct())


def _classes(docs: DataFrame, id_col: str, text_col: str, shingle_words: int, radius: int, spare: int,
             bucket_rows: int) -> DataFrame:
    """``doc_id, fp, root, component_id`` per row; ``root`` is the component's smallest fingerprint."""
    fps = stored(fingerprints(docs, id_col, text_col, shingle_words), "fingerprints")
    roots = connected_components(fingerprint_links(fps, radius, spare, bucket_rows))
    nodes = (fps.groupBy("fp").agg(F.min("doc_id").alias("least_id"))
             .join(roots.withColumnRenamed("node", "fp"), "fp", "left")
             .select("fp", "least_id", F.coalesce("root", "fp").alias("root")))
    ids = nodes.groupBy("root").agg(F.min("least_id").alias("component_id"))
    classes = stored(nodes.join(ids, "root").select("fp", "root", "component_id"), "classes")
    return fps.join(classes, "fp").select("doc_id", "fp", "root", "component_id")


def near_duplicate_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 4,
                           radius: int = 4, spare: int = 2, bucket_rows: int = 4096) -> DataFrame:
    """``doc_id, fp, component_id`` per row: the smallest id reachable over links
    of ``radius`` or fewer differing bits.

    Null, empty and blank texts have fingerprint zero and link like any other.
    Equal fingerprints are one node, so copies are never compared in pairs.
    Repeated rows each get their row; a null id is kept and never smallest, and
    a component of null ids only has a null id. An empty table gives no rows.
    Other columns are not read.
    """
    return _classes(docs, id_col, text_col, shingle_words, radius, spare, bucket_rows).drop("root")


def fingerprint_hex(c: Column) -> Column:
    return F.lower(F.lpad(F.hex(c), 16, "0"))


def _of_fingerprints(docs: DataFrame, wanted: DataFrame, text_col: str, shingle_words: int) -> DataFrame:
    """One row of ``docs`` for each fingerprint in ``wanted``."""
    rows = docs.select(F.struct("*").alias("row"), F.col(text_col).cast("string").alias("text"))
    schema = rows.select("row").withColumn("fp", F.lit(0).cast("long")).schema

    def run(batches):
        for batch in batches:
            fps = np.fromiter((fingerprint(t.as_py(), shingle_words) for t in batch.column(1)), dtype="<u8",
                              count=batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view("<i8"))], names=["row", "fp"])

    return rows.mapInArrow(releasing(run), schema).join(wanted, "fp", "left_semi").dropDuplicates(["fp"]).select("row.*")


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 4,
                     radius: int = 4, spare: int = 2, bucket_rows: int = 4096) -> DataFrame:
    """One row of ``docs`` for each component: that of its smallest id, columns as they are.

    Of repeated rows of that id one stays. Rows without an id go where their
    component has a document with one; else one of them stays.
    """
    classes = _classes(docs, id_col, text_col, shingle_words, radius, spare, bucket_rows)
    kept = classes.select(F.col("component_id").alias("_kept")).where(F.col("_kept").isNotNull()).distinct()
    named = docs.join(kept, docs[id_col] == kept["_kept"], "left_semi").dropDuplicates([id_col])
    nameless = classes.where(F.col("component_id").isNull() & (F.col("fp") == F.col("root"))).select("fp").distinct()
    return named.unionByName(_of_fingerprints(docs.where(F.col(id_col).isNull()), nameless, text_col, shingle_words))
