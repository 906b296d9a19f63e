"""Comma-separated event lines: decode (stream source side) and encode (replay side).

Line layout: the eight catalog fields in catalog order, separated by commas,
empty text for a missing value. Encoding blanks commas and line breaks inside
a field, so ``place`` text loses its commas on this path only.

Both functions are pure projections (plus one filter for decode) and work on
batch and streaming frames alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremor.config import CATALOG_COLUMNS, LINE_BLANKED_CHARS, LINE_SEPARATOR
from tremor.functions.numeric import nan_to_null, to_double
from tremor.functions.time import line_time_text, parse_utc_time, utc_wallclock

_NUMERIC = ("latitude", "longitude", "depth", "mag")

#: Reasons for which a line is not decoded, in the order they are tested.
REJECT_REASONS = ("null line", "empty line", "too few fields", "no magnitude", "unreadable magnitude")

# Characters stripped from both ends of an encoded field: every character Python
# counts as whitespace (``str.strip()`` with no argument), derived by rule.
_WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def decode_lines(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Split each line into typed catalog columns.

    * fields are trimmed; numbers use ``try_cast`` (bad text → null, no error);
    * a missing trailing field is null (``get`` rather than ``getItem``, which
      raises under ANSI mode);
    * ``time`` is parsed to UTC TIMESTAMP_NTZ and the text is kept as
      ``time_raw``, so a row with a bad clock is still delivered;
    * rows without a magnitude are dropped.

    Other input columns (e.g. a Kafka key or timestamp) pass through, except
    ones named like a decoded column, which the decoded value replaces.
    """
    produced = set(CATALOG_COLUMNS) | {"time_raw"}
    keep = [c for c in df.columns if c != value_col and c not in produced]
    typed = _typed_fields(value_col)
    decoded = df.select(*keep, *[expr.alias(name) for name, expr in typed.items()], _field(value_col, 0).alias("time_raw"))
    return decoded.filter(F.col("time_raw").isNotNull() & F.col("mag").isNotNull())


def _fields(value_col: str) -> Column:
    return F.split(F.col(value_col), LINE_SEPARATOR, -1)


def _field(value_col: str, i: int) -> Column:
    return F.trim(F.get(_fields(value_col), i))


def _typed_fields(value_col: str) -> dict[str, Column]:
    typed = {}
    for i, name in enumerate(CATALOG_COLUMNS):
        field = _field(value_col, i)
        typed[name] = parse_utc_time(field) if name == "time" else to_double(field) if name in _NUMERIC else field
    return typed


def reject_reason(value_col: str = "value") -> Column:
    """Why :func:`decode_lines` drops a line (one of ``REJECT_REASONS``); null
    for a line that it keeps."""
    at = CATALOG_COLUMNS.index("mag")
    line, mag = F.col(value_col), _field(value_col, at)
    null, empty, short, missing, unreadable = REJECT_REASONS
    return (F.when(line.isNull(), null).when(to_double(mag).isNotNull(), F.lit(None).cast("string"))
            .when(F.trim(line) == "", empty).when(F.size(_fields(value_col)) <= at, short)
            .when(mag == "", missing).otherwise(unreadable))


def rejected_lines(df: DataFrame, value_col: str = "value") -> DataFrame:
    """The lines that :func:`decode_lines` drops, as they stand: ``value, reason,
    n_fields, time_raw`` and the other input columns (not those of these names).

    With the decoded lines they are the whole input: no line is in both or in
    neither. Works on batch and streaming frames alike."""
    produced = {value_col, "reason", "n_fields", "time_raw"}
    return df.select(*[c for c in df.columns if c not in produced], F.col(value_col), reject_reason(value_col).alias("reason"),
                     F.size(_fields(value_col)).alias("n_fields"), _field(value_col, 0).alias("time_raw")).filter(
        F.col("reason").isNotNull())


def reject_counts(rejects: DataFrame) -> DataFrame:
    """``reason, count`` of rejected lines, most frequent first (at most one row per reason)."""
    counts = rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("count"))
    return counts.coalesce(1).sortWithinPartitions(F.col("count").desc(), "reason")


def _field_text(df: DataFrame, name: str) -> Column:
    if name not in df.columns:
        return F.lit("")
    dtype = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dtype, T.TimestampNTZType):
        text = line_time_text(c)
    elif isinstance(dtype, T.TimestampType):
        text = line_time_text(utc_wallclock(c))
    elif isinstance(dtype, (T.DoubleType, T.FloatType)):
        text = nan_to_null(c.cast("double")).cast("string")
    else:
        text = c.cast("string")
    if isinstance(dtype, (T.TimestampNTZType, T.TimestampType, T.NumericType)):
        return F.coalesce(text, F.lit(""))  # holds no separator and no blank
    blanked = F.translate(F.coalesce(text, F.lit("")), LINE_BLANKED_CHARS, " " * len(LINE_BLANKED_CHARS))
    return F.trim(blanked, F.lit(_WHITESPACE))


def encode_lines(df: DataFrame, value_col: str = "value") -> DataFrame:
    """One text column ``value``: the catalog fields joined by commas."""
    return df.select(F.concat_ws(LINE_SEPARATOR, *[_field_text(df, c) for c in CATALOG_COLUMNS]).alias(value_col))
