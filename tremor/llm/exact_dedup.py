"""Exact deduplication by content-defined chunk recipes.

A text is cut where its content says so: after ``min_chunk`` characters, at the
first line break or the first sentence end before one of a few letters. So equal
passages give equal chunks wherever they stand, and after an edit the cuts soon
fall together again. Distinct chunks form a dictionary, in which each chunk's hash is
verified against the chunk itself: if two contents share a hash they get
different numbers. A text is then its recipe, the ordered list of verified chunk
identifiers, and equal recipes are equal texts.

A chunk's characters are moved once per map task that holds it, into the
dictionary; after that only recipes move, however long the documents.

Spark expressions only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tremor.llm.common import ascii_lower, shuffle_partitions, stored

MIN_CHUNK, MAX_CHUNK = 128, 4096
#: Where a chunk may end. Letters stand in both cases, so case does not move a cut.
_CUT = r"\n|[.!?]\s(?=[aAeEiIsStT])|[。！？]"


def fold(text: Column) -> Column:
    """A-Z lower-cased; the built-in ``lower`` where nothing but ASCII could change."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(ascii_lower(text))


def chunks(text: Column, min_chunk: int = MIN_CHUNK, max_chunk: int = MAX_CHUNK) -> Column:
    """The chunks of a text in order, case-folded; joined they are the folded text.
    Null and empty texts have none."""
    pattern = rf"(?s).{{{min_chunk},{max_chunk}}}?(?:{_CUT})|.{{1,{max_chunk}}}"
    return F.transform(F.regexp_extract_all(F.coalesce(text.cast("string"), F.lit("")), F.lit(pattern), F.lit(0)), fold)


class Recipes:
    """Chunk dictionary and recipes of one table of documents.

    ``chunk_hash`` names a chunk before verification. Any deterministic function
    gives the same classes; a poor one only makes more contents share a hash.
    """

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chunk: int = MIN_CHUNK,
                 max_chunk: int = MAX_CHUNK, chunk_hash: Callable[[Column], Column] = F.xxhash64):
        self.hash = chunk_hash
        self._cut = docs.select(F.col(id_col).alias("doc_id"), chunks(F.col(text_col), min_chunk, max_chunk).alias("chunks"))
        self._rivals: DataFrame | None = None
        self._verified = False

    def _named(self) -> DataFrame:
        """One row per distinct chunk and its hash ``h``, with the number of its ``copies``."""
        each = self._cut.select(F.explode("chunks").alias("chunk"))
        return each.groupBy(self.hash(F.col("chunk")).alias("h"), "chunk").agg(F.count(F.lit(1)).alias("copies"))

    def rivals(self) -> DataFrame | None:
        """``h, chunk, k``: the chunks that share their hash with another, numbered
        from 0 within it. None if no two do, as 64 random bits make likely."""
        if not self._verified:
            shared = stored(self._named().groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
                            .select("h"), "chunk-hashes")
            if not shared.isEmpty():
                number = F.row_number().over(Window.partitionBy("h").orderBy("chunk")) - 1
                self._rivals = stored(self._named().join(shared, "h", "left_semi").select("h", "chunk", number.alias("k")),
                                      "chunk-rivals")
            self._verified = True
        return self._rivals

    def dictionary(self) -> DataFrame:
        """``h, k, chunk, copies``: every distinct chunk under its verified identifier ``(h, k)``."""
        named, rivals = self._named(), self.rivals()
        if rivals is None:
            return named.select("h", F.lit(0).alias("k"), "chunk", "copies")
        return named.join(rivals, ["h", "chunk"], "left").select("h", F.coalesce("k", F.lit(0)).alias("k"), "chunk", "copies")

    def recipes(self) -> DataFrame:
        """Per row of the documents: ``doc_id, row`` (a number of its own),
        ``text_sha256`` of the folded text and its ``recipe``, an array of ``(h, k)``."""
        rows = self._cut.select("doc_id", F.monotonically_increasing_id().alias("row"),
                                F.sha2(F.array_join("chunks", ""), 256).alias("text_sha256"), "chunks")
        rivals = self.rivals()
        if rivals is None:
            return rows.select("doc_id", "row", "text_sha256", F.transform("chunks", lambda c: F.struct(
                self.hash(c).alias("h"), F.lit(0).alias("k"))).alias("recipe"))
        each = rows.select("doc_id", "row", "text_sha256", F.posexplode_outer("chunks").alias("at", "chunk"))
        numbered = each.withColumn("h", self.hash(F.col("chunk"))).join(rivals, ["h", "chunk"], "left")
        step = F.when(F.col("at").isNotNull(), F.struct("at", "h", F.coalesce("k", F.lit(0)).alias("k")))
        return numbered.groupBy("doc_id", "row", "text_sha256").agg(F.array_sort(F.collect_list(step)).alias("steps")).select(
            "doc_id", "row", "text_sha256",
            F.transform("steps", lambda s: F.struct(s["h"].alias("h"), s["k"].alias("k"))).alias("recipe"))


def exact_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chunk: int = MIN_CHUNK,
                  max_chunk: int = MAX_CHUNK, chunk_hash: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id`` (the largest id among
    equal texts), ``group_size, kept, text_sha256``.

    Texts are equal if they are identical after lower-casing A-Z. Null texts
    count as empty. Of rows with the same text and the same largest id exactly
    one is kept. A null id is below all others, so it is kept only in a group of
    null ids (``keep_id`` null). Texts of any length are compared whole. An
    empty table gives no rows. Other columns, whatever their names, are not read.

    A class may hold any share of the rows: its rows are dealt over salts,
    counted per salt, and meet the class's totals salt by salt.
    """
    salts = shuffle_partitions(docs.sparkSession)
    rows = stored(Recipes(docs, id_col, text_col, min_chunk, max_chunk, chunk_hash).recipes(), "recipes")
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(salts)).cast("int"))
    dealt = rows.groupBy("recipe", "salt").agg(F.max(F.struct("doc_id", "row")).alias("last"), F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("recipe")
    totals = dealt.select("recipe", "salt", F.max("last").over(whole).alias("last"), F.sum("n").over(whole).alias("group_size"))
    return rows.join(totals, ["recipe", "salt"]).select(
        "doc_id", F.col("last.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("last.row")).alias("kept"),
        "text_sha256")


#: Equivalent result over the given table (with distinct ids).
ORACLE = """
WITH folded AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body
  FROM documents),
classes AS (SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM folded GROUP BY body)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256
FROM folded JOIN classes USING (body)
"""
