"""Source divergence audit over a k²-tree of the group–term count matrix.

Groups are the sources of a language, terms its words. Rows of the matrix are
groups, columns are terms, entries are exact shares; most entries are those of
count zero, which are the same along a row. The matrix is cut into strips of
columns and blocks of rows. Each strip of two row blocks becomes a pair of
k²-trees (k = 2: a node's four quadrants, kept only where a count is not zero),
and both trees are walked together over the same columns:

* where both quadrants are all zero, every pair of their rows differs by the
  same amount in each column: one product prices the quadrant;
* else the walk goes down, and at the leaves the entries are compared.

Within a strip columns are ordered by the group that uses the term most, so the
zeros of the others lie together.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tremor.llm.common import let_workers_import, shuffle_partitions, stored

#: Bytes that belong to no term (of UTF-8; bytes from 0x80 on are parts of letters).
_GAPS = [*range(0x00, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
_FOLD = bytes(0x20 if b in _GAPS else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
#: Bytes of a text that are split at once.
_STRETCH = 1 << 20
#: Terms a task holds before it passes their counts on.
HELD_TERMS = 200_000
STRIP_COLUMNS, BLOCK_ROWS, LEAF = 2048, 512, 8
#: Group rows are broadcast up to so many; beyond, they are dealt over salts.
MAX_BROADCAST_ROWS = 100_000

_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("count", pa.int64()),
                     ("docs", pa.int64())])


def text_terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text in order, A-Z lower-cased, a stretch at a time."""
    start = 0
    while start < len(text):
        end = start + _STRETCH
        if end < len(text):  # on to the next gap
            while end < len(text) and text[end] not in _GAPS:
                end += 1
        yield text[start:end].translate(_FOLD).split()
        start = end


def term_counts(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``lang, source, term, count, docs``: occurrences and documents of each term
    in each group; a row with a null term for each group."""
    def run(batches):
        held: dict[tuple, tuple[Counter, Counter]] = {}
        size = 0

        def out():
            for (lang, source), (count, docs) in held.items():
                terms = list(count)
                n = len(terms) + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * n, pa.string()), pa.array([source] * n, pa.string()), pa.array([*terms, None], pa.string()),
                     pa.array([*count.values(), 0], pa.int64()), pa.array([*(docs[t] for t in terms), 0], pa.int64())],
                    schema=_COUNTS)

        for batch in batches:
            for lang, source, text in zip(*(c.to_pylist() for c in batch.columns)):
                count, in_docs = held.setdefault((lang, source), (Counter(), Counter()))
                before, seen = len(count), set()
                for terms in text_terms(text):
                    count.update(terms)
                    seen.update(terms)
                in_docs.update(seen)
                size += len(count) - before
                if size >= HELD_TERMS:
                    yield from out()
                    held, size = {}, 0
        yield from out()

    def read(name):
        return F.coalesce(F.col(name).cast("string"), F.lit(""))

    parts = (docs.select(read(lang_col).alias("lang"), read(source_col).alias("source"), read(text_col).cast("binary").alias("text"))
             .mapInArrow(run, "lang string, source string, term string, count long, docs long"))
    return parts.groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))


def kept_counts(counts: DataFrame, min_docs: int) -> DataFrame:
    """The counts of the terms that at least ``min_docs`` documents of the
    language hold, with the language's ``lang_count``, the group that uses the
    term most (``most``) and a mark ``first`` on one row per term; and the group rows."""
    term = Window.partitionBy("lang", "term")
    ranked = term.orderBy(F.col("count").desc(), "source")
    return (counts.withColumns({
        "lang_docs": F.sum("docs").over(term), "lang_count": F.sum("count").over(term),
        "most": F.first("source").over(ranked), "first": (F.row_number().over(ranked) == 1) & F.col("term").isNotNull()})
        .where(F.col("term").isNull() | (F.col("lang_docs") >= min_docs))
        .select("lang", "source", "term", "count", "lang_count", "most", "first"))


def share(count: Column, total: Column, terms: Column, prior: int, scale: int) -> Column:
    """``1 + floor(scale * (count + prior) / (total + prior * terms))``, exactly."""
    def big(c):
        return c.cast("decimal(19,0)")

    return F.lit(1) + F.call_function("div", big(F.lit(scale)) * big(count + prior), big(total + prior * terms))


def group_rows(kept: DataFrame, prior: int, scale: int) -> DataFrame:
    """Per group: its row number ``r`` in the language (by source), ``total`` of
    its counts, the language's number of ``terms`` and ``lang_total``, and the
    share ``zero`` of a term that it does not hold."""
    lang = Window.partitionBy("lang")
    groups = kept.groupBy("lang", "source").agg(F.sum("count").alias("total"), F.count_if("first").alias("firsts"))
    groups = groups.select("lang", "source", (F.row_number().over(lang.orderBy("source")) - 1).alias("r"), "total",
                           F.sum("firsts").over(lang).alias("terms"), F.sum("total").over(lang).alias("lang_total"),
                           F.count(F.lit(1)).over(lang).alias("groups"))
    zero = F.when(F.col("terms") > 0, share(F.lit(0), F.col("total"), F.col("terms"), prior, scale))
    return groups.withColumn("zero", zero)


def _with_group(cells: DataFrame, groups: DataFrame) -> DataFrame:
    """Each cell beside its group; a group may hold any share of the cells."""
    if groups.count() <= MAX_BROADCAST_ROWS:
        return cells.join(F.broadcast(groups), ["lang", "source"])
    salts = shuffle_partitions(cells.sparkSession)
    dealt = groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return cells.withColumn("salt", F.pmod(F.xxhash64("term"), F.lit(salts)).cast("int")).join(
        dealt, ["lang", "source", "salt"]).drop("salt")


class K2Tree:
    """Quadtree over the nonzero entries ``(row, column, value)`` of a matrix of
    ``size`` columns (a power of two) and at most as many rows. ``levels[s]``
    holds the nonzero quadrants of side ``s`` as sorted codes; leaves have side
    ``LEAF``, their zero entries filled with the row's ``zero`` value."""

    def __init__(self, rows: np.ndarray, cols: np.ndarray, values: np.ndarray, zero: np.ndarray, size: int):
        self.size, self.zero = size, np.zeros(-(-max(len(zero), 1) // LEAF) * LEAF, dtype=np.int64)
        self.zero[:len(zero)] = zero
        self.rows = len(zero)
        self.levels: dict[int, np.ndarray] = {}
        side, r, c = LEAF, rows // LEAF, cols // LEAF
        while side <= size:
            codes = np.unique(self.code(r, c, side))
            self.levels[side] = codes
            r, c, side = codes // (size // side) // 2, codes % (size // side) // 2, side * 2
        codes = self.levels[LEAF]
        leaf_row = codes // (size // LEAF)
        self.leaves = np.repeat(self.zero.reshape(-1, LEAF)[leaf_row][:, :, None], LEAF, axis=2)
        at = np.searchsorted(codes, self.code(rows // LEAF, cols // LEAF, LEAF))
        self.leaves[at, rows % LEAF, cols % LEAF] = values

    def code(self, r, c, side: int):
        return r * (self.size // side) + c

    def find(self, r, c, side: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of quadrants among the nonzero ones of a level, and which are there."""
        codes, level = self.code(r, c, side), self.levels[side]
        if not len(level):
            return np.zeros(len(codes), dtype=np.int64), np.zeros(len(codes), dtype=bool)
        at = np.minimum(np.searchsorted(level, codes), len(level) - 1)
        return at, level[at] == codes

    def leaf(self, at, there, r) -> np.ndarray:
        got = np.repeat(self.zero.reshape(-1, LEAF)[r][:, :, None], LEAF, axis=2)
        got[there] = self.leaves[at[there]]
        return got


def row_distances(a: K2Tree, b: K2Tree, width: int, batch: int = 2048) -> np.ndarray:
    """``out[i, j]``: sum over the first ``width`` columns of ``|a[i] - b[j]|``.
    With ``a is b`` only the pairs of a leaf row and those after it are filled."""
    side = a.size
    ra = rb = c = np.zeros(1, dtype=np.int64)
    out = np.zeros((len(a.zero), len(b.zero)), dtype=np.int64)
    apart = np.abs(a.zero[:, None] - b.zero[None, :])
    while True:
        in_range = (ra * side < a.rows) & (rb * side < b.rows) & (c * side < width)
        if a is b:
            in_range &= ra <= rb
        ra, rb, c = ra[in_range], rb[in_range], c[in_range]
        (at_a, in_a), (at_b, in_b) = a.find(ra, c, side), b.find(rb, c, side)
        blank = ~(in_a | in_b)
        if blank.any():
            cols = np.zeros((-(-len(a.zero) // side), -(-len(b.zero) // side)), dtype=np.int64)
            np.add.at(cols, (ra[blank], rb[blank]), np.minimum(side, width - c[blank] * side))
            out += np.repeat(np.repeat(cols, side, 0)[:len(a.zero)], side, 1)[:, :len(b.zero)] * apart
        live = ~blank
        ra, rb, c = ra[live], rb[live], c[live]
        if side == LEAF:
            at_a, in_a, at_b, in_b = at_a[live], in_a[live], at_b[live], in_b[live]
            break
        side //= 2
        ra, rb, c = ((x[:, None] * 2 + np.array(bit)[None, :]).ravel() for x, bit in (
            (ra, (0, 0, 0, 0, 1, 1, 1, 1)), (rb, (0, 0, 1, 1, 0, 0, 1, 1)), (c, (0, 1, 0, 1, 0, 1, 0, 1))))
    tiles = out.reshape(len(a.zero) // LEAF, LEAF, len(b.zero) // LEAF, LEAF).transpose(0, 2, 1, 3)
    for k in range(0, len(c), batch):
        s = slice(k, k + batch)
        one, two = a.leaf(at_a[s], in_a[s], ra[s]), b.leaf(at_b[s], in_b[s], rb[s])
        real = (c[s, None] * LEAF + np.arange(LEAF)[None, :]) < width
        diff = np.abs(one[:, :, None, :] - two[:, None, :, :]) * real[:, None, None, :]
        np.add.at(tiles, (ra[s], rb[s]), diff.sum(axis=3))
    return out


def _strip_sums(key: tuple, strip: pa.Table, block_rows: int) -> pa.Table:
    """Sums over the columns of one strip for all pairs of two blocks of rows."""
    lang, _, block_a, block_b = (k.as_py() for k in key)
    r, value = strip["r"].to_numpy(), strip["value"].to_numpy()
    is_cell = strip["term"].is_valid().to_numpy()
    # Columns by the group that uses the term most, then by term.
    coded = strip["term"].combine_chunks().dictionary_encode()
    at = coded.indices.drop_null().to_numpy()
    width = len(coded.dictionary)
    most = strip["most"].combine_chunks().drop_null().take(pa.array(np.unique(at, return_index=True)[1]))
    order = pc.sort_indices(pa.table({"most": most, "term": coded.dictionary}),
                            sort_keys=[("most", "ascending"), ("term", "ascending")]).to_numpy()
    place = np.empty(width, dtype=np.int64)
    place[order] = np.arange(width)
    columns = place[at]
    size = LEAF
    while size < max(width, min(block_rows, int(r.max()) + 1)):
        size *= 2

    def tree(block):
        own = (r // block_rows == block)
        zeros = own & ~is_cell
        zero = np.zeros(int(r[own].max()) - block * block_rows + 1, dtype=np.int64)
        zero[r[zeros] - block * block_rows] = value[zeros]
        cells = own[is_cell]
        return K2Tree(r[is_cell][cells] - block * block_rows, columns[cells], value[is_cell][cells], zero, size)

    one = tree(block_a)
    two = one if block_a == block_b else tree(block_b)
    sums = row_distances(one, two, width)[:one.rows, :two.rows]
    i, j = np.nonzero(np.triu(np.ones(sums.shape, dtype=bool), 1)) if one is two else (x.ravel() for x in np.indices(sums.shape))
    return pa.table({"lang": pa.array([lang] * len(i), pa.string()), "i": pa.array(i + block_a * block_rows, pa.int64()),
                     "j": pa.array(j + block_b * block_rows, pa.int64()), "value": pa.array(sums[i, j], pa.int64()),
                     "columns": pa.array(np.full(len(i), width), pa.int64())})


def group_distances(shares: DataFrame, groups: DataFrame, strip_columns: int = STRIP_COLUMNS,
                    block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``lang, source, item, value``: for each group and each other of its
    language the sum over all terms of the difference of their shares.

    ``shares`` are the cells with a count: ``lang, source, r, groups, terms, term,
    most, value``. Strips hold about ``strip_columns`` terms, chosen by hash; a
    row block meets every row block of its language in each strip. What a task
    holds is bounded by two blocks of rows times one strip of columns, and it
    sends sums, not differences. Two rows for each pair of groups are the result
    itself; nothing else grows with the pairs.
    """
    strips = F.ceil(F.col("terms") / F.lit(strip_columns)).cast("int")
    cells = shares.select("lang", "r", "value", "groups", "most", "term",
                          F.pmod(F.xxhash64("term"), strips).cast("int").alias("strip"))
    zeros = groups.where(F.col("terms") > 0).select(
        "lang", "r", F.col("zero").alias("value"), "groups", F.lit(None).cast("string").alias("most"),
        F.lit(None).cast("string").alias("term"), F.explode(F.sequence(F.lit(0), strips - 1)).alias("strip"))
    own = F.floor(F.col("r") / F.lit(block_rows)).cast("int")
    last = F.floor((F.col("groups") - 1) / F.lit(block_rows)).cast("int")
    dealt = (cells.unionByName(zeros).withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), last)))
             .select("lang", "strip", F.least("own", "other").alias("block_a"), F.greatest("own", "other").alias("block_b"),
                     "r", "value", "most", "term"))

    def sums_of(key, strip):
        return _strip_sums(key, strip, block_rows)

    sums = (dealt.groupBy("lang", "strip", "block_a", "block_b")
            .applyInArrow(sums_of, "lang string, i long, j long, value long, columns long")
            .groupBy("lang", "i", "j").agg(F.sum("value").alias("value"), F.sum("columns").alias("columns")))
    one = groups.select("lang", F.col("source"), F.col("r").alias("r"), F.col("zero").alias("zero"), "terms")
    two = groups.select("lang", F.col("source").alias("item"), F.col("r").alias("item_r"), F.col("zero").alias("item_zero"))
    pairs = one.join(two, "lang").where(F.col("r") != F.col("item_r")).select(
        "*", F.least("r", "item_r").cast("long").alias("i"), F.greatest("r", "item_r").cast("long").alias("j"))
    # Columns in no strip of either block are one quadrant of zeros.
    rest = (F.col("terms") - F.coalesce("columns", F.lit(0))) * F.abs(F.col("zero") - F.col("item_zero"))
    return pairs.join(sums, ["lang", "i", "j"], "left").select(
        "lang", "source", "item", (F.coalesce("value", F.lit(0)) + F.coalesce(rest, F.lit(0))).cast("long").alias("value"))


def audit_sources(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
                  min_docs: int = 30, prior: int = 5, scale: int = 1_000_000_000, top_terms: int = 50,
                  strip_columns: int = STRIP_COLUMNS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``lang, source, part, item, value, rank`` for every group of documents.

    Part ``pair``: each other source of the language by the distance of the
    groups' term shares, all ranks. Part ``term``: the ``top_terms`` terms whose
    share in the group exceeds the language's most. All numbers are exact.

    A document is a row; null languages, sources and texts are empty ones, and
    rows of one id count each. Ties go by the item in UTF-8 order. Groups
    without terms have pairs and no terms; a language that keeps no term has
    distances 0. Texts of any length are read whole, a stretch at a time. An
    empty table gives no rows. Other columns, whatever their names, are not read.
    """
    let_workers_import(docs.sparkSession)
    kept = stored(kept_counts(term_counts(docs, lang_col, source_col, text_col), min_docs), "term-counts")
    groups = stored(group_rows(kept, prior, scale), "term-groups")
    cells = _with_group(kept.where(F.col("term").isNotNull() & (F.col("count") > 0)), groups)
    own = share(F.col("count"), F.col("total"), F.col("terms"), prior, scale)
    whole = share(F.col("lang_count"), F.col("lang_total"), F.col("terms"), prior, scale)
    shares = cells.select("lang", "source", "r", "groups", "terms", "term", "most", own.alias("value"),
                          (own - whole).alias("excess"))
    by_group = Window.partitionBy("lang", "source")
    order = [F.col("value").desc(), F.col("item")]
    terms = (shares.where(F.col("excess") > 0).select("lang", "source", F.col("term").alias("item"), F.col("excess").alias("value"))
             .withColumn("rank", F.row_number().over(by_group.orderBy(*order))).where(F.col("rank") <= top_terms))
    pairs = group_distances(shares, groups, strip_columns, block_rows).withColumn("rank", F.row_number().over(by_group.orderBy(*order)))
    columns = ["item", "value", F.col("rank").cast("int").alias("rank")]
    return pairs.select("lang", "source", F.lit("pair").alias("part"), *columns).unionByName(
        terms.select("lang", "source", F.lit("term").alias("part"), *columns))


#: Equivalent result over the given table.
ORACLE = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text
  FROM documents),
words AS (
  SELECT row, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM docs),
kept AS (SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT row) >= 30),
groups AS (SELECT DISTINCT lang, source FROM docs),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
cells AS (SELECT lang, source, term, count(*) AS c FROM words JOIN kept USING (lang, term) GROUP BY ALL),
totals AS (SELECT lang, source, coalesce(sum(c), 0) AS n FROM groups LEFT JOIN cells USING (lang, source) GROUP BY ALL),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c, 0) AS c,
    1 + (1000000000::HUGEINT * (coalesce(c, 0) + 5)) // (n + 5 * v) AS p
  FROM totals g JOIN kept k USING (lang) JOIN sizes USING (lang) LEFT JOIN cells USING (lang, source, term)),
whole AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(c) + 5)) // (any_value(n) + 5 * any_value(v)) AS q
  FROM cells JOIN (SELECT lang, sum(n) AS n FROM totals GROUP BY lang) USING (lang) JOIN sizes USING (lang) GROUP BY lang, term),
distances AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN distances d ON d.lang = a.lang AND d.source = a.source AND d.item = b.source),
terms AS (
  SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM shares JOIN whole USING (lang, term) WHERE c > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (FROM pairs UNION ALL FROM terms))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 50
"""
