"""Line deduplication over levelled sorted runs of line hashes.

A run is a table of line hashes, bucketed and sorted by hash. A new batch of
documents merge-anti-joins the runs: the runs are read in their stored order
and only the batch's own hashes are shuffled. What the runs do not hold becomes
the batch's run. When a level has ``fanout`` runs they are compacted into one
run of the next level, so a batch meets few runs, however many batches came
before. Hashes are 128 bits, two independent 64-bit ones.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tremor.llm.common import SPACE_CHARS, ascii_lower, shuffle_partitions, stored
from tremor.session import scratch_path

MIN_KEY_CHARS = 10
_HASH = ["h1", "h2"]


def text_lines(text: Column) -> Column:
    """Lines of a text; null and empty texts have one empty line."""
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return ascii_lower(F.trim(line, F.lit(SPACE_CHARS)))


class LineRuns:
    """Hashes of all lines seen so far, in levelled sorted runs.

    ``buckets`` is fixed for the life of the runs (default: the session's
    shuffle partitions); ``fanout`` runs of a level are compacted into one.
    """

    def __init__(self, spark: SparkSession, buckets: int | None = None, fanout: int = 3):
        self.spark, self.fanout = spark, fanout
        self.buckets = buckets or shuffle_partitions(spark)
        self.levels: list[list[tuple[str, str]]] = []  # per level: (table, path)

    def _write(self, rows: DataFrame) -> tuple[str, str]:
        name = f"line_run_{uuid.uuid4().hex}"
        path = scratch_path(self.spark, name)
        (rows.write.bucketBy(self.buckets, *_HASH).sortBy(*_HASH).option("path", path).format("parquet")
         .saveAsTable(name))
        return name, path

    def close(self) -> None:
        """Take the runs out of the session's catalog; their files are the scratch owner's."""
        for name, _ in (run for level in self.levels for run in level):
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.levels = []

    def _push(self, run: tuple[str, str], level: int = 0) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fanout:
            parts = [self.spark.table(name).where(~F.col("seen")) for name, _ in self.levels[level]]
            merged = parts[0]
            for part in parts[1:]:  # disjoint: each batch added only what no run held
                merged = merged.union(part)
            compacted = self._write(merged.repartition(self.buckets, *_HASH).sortWithinPartitions(*_HASH))
            for name, _ in self.levels[level]:
                self.spark.sql(f"DROP TABLE {name}")
            self.levels[level] = []
            self._push(compacted, level + 1)

    def add_batch(self, lines: DataFrame) -> DataFrame:
        """Take in the lines ``(doc, h1, h2, …)`` of new documents; returns the
        hashes to drop as ``h1, h2, owner``: all their lines but those in document
        ``owner`` (null: all, an earlier batch has them)."""
        keys = lines.groupBy(*_HASH).agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
        keys = keys.withColumn("seen", F.lit(False))
        for name, _ in (run for level in self.levels for run in level):
            run = self.spark.table(name).where(~F.col("seen")).select(*_HASH, F.lit(True).alias("hit"))
            keys = (keys.join(run.hint("merge"), _HASH, "left")
                    .withColumn("seen", F.col("seen") | F.coalesce("hit", F.lit(False))).drop("hit"))
        run = self._write(keys.repartition(self.buckets, *_HASH).sortWithinPartitions(*_HASH))
        found = self.spark.read.schema(keys.schema).parquet(run[1])
        self._push(run)
        repeated = found.where(F.col("seen") | (F.col("first") != F.col("last")))
        return repeated.select(*_HASH, F.when(~F.col("seen"), F.col("first")).alias("owner"))


def _batch_bounds(docs: DataFrame, batches: int) -> list[int]:
    """Ids that cut the documents into about equal batches."""
    if batches < 2:
        return []
    cuts = docs.where(F.col("doc") < _LAST).stat.approxQuantile("doc", [i / batches for i in range(1, batches)], 0.001)
    return sorted({int(c) for c in cuts})


#: Stands for a null id: such rows are one document, after all others.
_LAST = (1 << 63) - 1


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batches: int = 4,
                        fanout: int = 3, counts: bool = True) -> DataFrame:
    """``docs`` with the text cut to the kept lines and, with ``counts``, the
    columns ``n_lines`` and ``n_dropped``.

    A line's key is the line without white space at both ends, A-Z lower-cased.
    Keys of ten or more code points found in two or more documents lose all
    their lines except in the document of smallest id; a document keeps its own
    repeats. Documents are taken in as batches of ascending id.

    Null and empty texts are one empty line, and come back empty. Rows of one id
    are one document, each row cut by itself; rows with a null id are together
    one document, behind all others. Texts of any length are read whole. An
    empty table gives no rows. Other columns come back as they are, whatever
    their names; with ``counts``, input columns of those two names are replaced.
    """
    spark = docs.sparkSession
    text = F.col(text_col)
    own = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("doc"), text.alias("text"))
    bounds = _batch_bounds(own.select("doc"), batches)
    number = sum(((F.col("doc") > bound).cast("int") for bound in bounds), F.lit(0))
    lines = (own.select("doc", F.xxhash64("text").alias("body"), F.posexplode(text_lines(F.col("text"))))
             .withColumn("key", line_key(F.col("col"))).where(F.length("key") >= MIN_KEY_CHARS)
             .select("doc", "body", "pos", F.xxhash64("key").alias("h1"),
                     F.xxhash64(F.lit(1), F.col("key")).alias("h2"), number.alias("batch")))
    lines = stored(lines, "lines", "batch")  # one scan of the texts, a folder for each batch
    runs, dropped = LineRuns(spark, fanout=fanout), None
    try:
        for batch in range(len(bounds) + 1):
            new = lines.where(F.col("batch") == batch).drop("batch")
            repeated = runs.add_batch(new)
            out = (new.join(repeated, _HASH).where(F.col("owner").isNull() | (F.col("doc") != F.col("owner")))
                   .select("doc", "body", "pos"))
            dropped = out if dropped is None else dropped.unionByName(out)
    finally:
        runs.close()
    drops = dropped.groupBy("doc", "body").agg(F.collect_set("pos").alias("drops"))
    names = [c for c in docs.columns if not counts or c not in ("n_lines", "n_dropped")]
    marked = docs.select(F.struct(*names).alias("row"), F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("doc"),
                         F.xxhash64(text).alias("body"))
    joined = marked.join(drops, ["doc", "body"], "left")
    all_lines = text_lines(F.col("row")[text_col])
    every = F.sequence(F.lit(0), F.size(all_lines) - 1)
    stay = F.transform(F.array_except(every, F.col("drops")), lambda i: F.get(all_lines, i))
    cut = F.when(F.col("drops").isNull(), F.coalesce(F.col("row")[text_col], F.lit(""))).otherwise(
        F.array_join(stay, "\n"))
    numbers = [F.size(all_lines).cast("long").alias("n_lines"),
               F.coalesce(F.size("drops"), F.lit(0)).cast("long").alias("n_dropped")]
    return joined.select(*[cut.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in names],
                         *(numbers if counts else []))


#: Equivalent result over the given table.
ORACLE = r"""
WITH lines AS (
  SELECT doc_id, pos, line,
    translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
          generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents)),
owners AS (
  SELECT key, min(doc_id) AS owner FROM lines WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1),
marked AS (
  SELECT l.*, o.owner IS NOT NULL AND o.owner <> l.doc_id AS dropped FROM lines l LEFT JOIN owners o USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def dedup_digest(kept: DataFrame) -> DataFrame:
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
