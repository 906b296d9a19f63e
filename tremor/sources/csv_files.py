"""Header CSV files: one read for files of different headers, in splits where
lines are records.

One pass over the text tells, per file split, the first line and how many lines
hold an odd number of quotes, after which a quoted field may go on over the line
break. Files are then grouped by header and by the way they can be read, and
the groups united by column name:

* ``split``: no field crosses a line, so a file of any size is read by many tasks;
* ``join``: fields cross lines in a file of several splits. Which lines belong
  together follows from the number of such lines before each, summed by split;
  only lines of records that cross are put together, the others are read as
  they stand;
* ``whole``: one task per file, by the CSV reader itself. For files of one
  split (a single task anyway) and for irregular quoting.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPLIT, JOIN, WHOLE = "split", "join", "whole"
#: A quote that touches no separator, line end or other quote stands inside a plain field.
_STRAY_QUOTE = r'[^",]"[^",\r]'
#: What is left of a line behind its last complete field when a quoted field stays open.
_PLAIN, _QUOTED = r'[^",]*+', r'"[^"]*+(?:""[^"]*+)*+"'
_OPENING = rf'^(?:(?:{_QUOTED}|{_PLAIN}),)*+"[^"]*+(?:""[^"]*+)*+$'
_CLOSING = rf'^[^"]*+(?:""[^"]*+)*+"(?:,(?:{_QUOTED}|{_PLAIN}))*+\r?$'


class BrokenCsvError(ValueError):
    """A CSV record spans lines where it must not."""


def _odd(line: Column) -> Column:
    """Whether a line holds an odd number of quotes."""
    quotes = F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))
    return F.contains(line, F.lit('"')) & (quotes % 2 == 1)


def _lines(spark: SparkSession, paths) -> DataFrame:
    """``file, block`` (where the split begins), ``id`` (ascending within a split)
    and ``line``, with the carriage return of its line end."""
    return spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"), F.col("value").alias("line"))


def split_profile(spark: SparkSession, paths) -> DataFrame:
    """Per ``file, block``: its first line, how many lines are ``odd``, have a
    ``stray`` quote, or a carriage return (``cr``) inside, which also ends lines."""
    line = F.col("line")
    return _lines(spark, paths).groupBy("file", "block").agg(
        F.min_by("line", "id").alias("first"), F.count_if(_odd(line)).alias("odd"),
        F.count_if(line.rlike(_STRAY_QUOTE)).alias("stray"), F.count_if(line.rlike(r"\r.")).alias("cr"))


def file_ways(profile: DataFrame) -> DataFrame:
    """Per file: its ``header`` line and the ``way`` to read it."""
    files = profile.groupBy("file").agg(
        F.min_by("first", "block").alias("header"), F.count(F.lit(1)).alias("splits"),
        F.sum("odd").alias("odd"), F.sum("stray").alias("stray"), F.sum("cr").alias("cr"))
    way = (F.when((F.col("odd") == 0) & (F.col("stray") == 0) & (F.col("cr") == 0), SPLIT)
           .when((F.col("splits") == 1) | (F.col("cr") > 0), WHOLE)
           .when(F.col("odd") == 0, SPLIT)
           .when((F.col("stray") == 0) & ~_odd(F.col("header")), JOIN)
           .otherwise(WHOLE))
    return files.select("file", F.regexp_replace("header", r"\r$", "").alias("header"), "odd", way.alias("way"))


def _as_path(uri: str) -> str:
    """A file's URI as a path to read: decoded, with glob characters escaped."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(uri))


def _options(multi_line: bool) -> dict:
    return {"header": True, "mode": "PERMISSIVE", "escape": '"', "multiLine": multi_line, "inferSchema": False}


def _read(spark: SparkSession, paths, multi_line: bool, schema: T.StructType | None, base: str | None) -> DataFrame:
    def reader():
        r = spark.read.options(**_options(multi_line))
        return r.option("basePath", base) if base else r

    found = reader().csv(paths)
    if schema is None:
        return found
    given = {f.name: f for f in schema.fields}
    own = T.StructType([given.get(name, T.StructField(name, T.StringType())) for name in found.columns])
    return reader().schema(own).csv(paths)


def _read_joined(spark: SparkSession, paths, schema: T.StructType) -> DataFrame:
    """Records of files in which fields cross lines, read in splits."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = split_profile(spark, paths).select("file", "block", F.coalesce(F.sum("odd").over(before), F.lit(0)).alias("odd_before"))
    in_split = Window.partitionBy("file", "block").orderBy("id")
    lines = _lines(spark, paths).join(starts, ["file", "block"])
    odd = _odd(F.col("line"))
    lines = lines.withColumns({"odd": odd, "number": F.row_number().over(in_split),
                               "behind": F.col("odd_before") + F.sum(odd.cast("int")).over(
                                   in_split.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - odd.cast("int")})
    inside = F.col("behind") % 2 == 1
    regular = F.when(F.col("odd"), F.when(inside, F.col("line").rlike(_CLOSING)).otherwise(F.col("line").rlike(_OPENING))).otherwise(True)
    broken = F.raise_error(F.concat(F.lit("irregular quotes in "), F.col("file"), F.lit(", read it with multi_line=True: "),
                                    F.substring("line", 1, 200)))
    lines = lines.where((F.col("block") > 0) | (F.col("number") > 1)).withColumn(
        "line", F.when(regular, F.col("line")).otherwise(broken))
    crossing = lines.where(inside | F.col("odd"))
    record = F.floor(F.col("behind") / 2)  # the opening line and those up to the closing one share it
    parts = F.array_sort(F.collect_list(F.struct("block", "id", "line")))
    joined = crossing.groupBy("file", record.alias("record")).agg(F.array_join(F.transform(parts, lambda p: p["line"]), "\n").alias("line"))
    text = lines.where(~inside & ~F.col("odd")).select("line").unionByName(joined.select("line"))
    text = text.select(F.regexp_replace("line", r"\r$", "").alias("line")).where(F.trim("line") != "")
    options = {k: str(v).lower() for k, v in _options(True).items() if k not in ("header", "inferSchema")}
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
    return text.select(F.from_csv("line", ddl, options).alias("row")).select("row.*")


def _unite(parts: Sequence[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole


def read_csv_text(spark: SparkSession, path: str, multi_line: bool | None = None,
                  schema: T.StructType | None = None) -> DataFrame:
    """The columns of header CSV files as they stand (text, or as ``schema`` types them).

    ``path`` is a file, a folder or a glob. Each file is read by its own header:
    files whose headers differ, in names or in order, are united by name, and a
    column that a file lacks is null there. Short rows have nulls in the missing
    fields; fields beyond the header are dropped; empty lines are skipped.

    ``multi_line``: ``None`` reads each file in splits where that gives the same
    records and joins those that cross lines; ``True`` reads every file in one
    task; ``False`` reads in splits and raises :class:`BrokenCsvError` if a
    quoted field may cross a line. All three scan the text once beforehand.

    Irregular quotes (inside a plain field) are left to the CSV reader, one task
    per file; if they show only while lines are joined, the read fails and asks
    for ``multi_line=True``. No part of a record ever passes for a row.
    """
    ways = file_ways(split_profile(spark, path))
    if multi_line is False:
        broken = ways.where(F.col("odd") > 0).limit(1).collect()
        if broken:
            raise BrokenCsvError(f"a quoted field may cross a line in {broken[0]['file']}, read it with multi_line=True")
    if multi_line is not None:
        ways = ways.withColumn("way", F.lit(WHOLE if multi_line else SPLIT))
    # One row per distinct header and way; the names of files are what Spark's own listing holds.
    groups = ways.groupBy("header", "way").agg(F.array_sort(F.collect_list("file")).alias("files")).orderBy("way", "header").collect()
    if not groups:  # no file holds a line
        return _read(spark, path, True, schema, None)
    if len(groups) == 1 and groups[0]["way"] != JOIN:
        return _read(spark, path, groups[0]["way"] == WHOLE, schema, None)
    base = path if not re.search(r"[\[{*?]", path) and len({f for g in groups for f in g["files"]}) > 1 else None
    parts = []
    for group in groups:
        files = [_as_path(f) for f in group["files"]]
        if group["way"] == JOIN:
            # The header only: the names of the columns, and their types.
            named = _read(spark, files[:1], False, schema, None)
            parts.append(_read_joined(spark, files, named.schema))
        else:
            parts.append(_read(spark, files, group["way"] == WHOLE, schema, base))
    return _unite(parts)
