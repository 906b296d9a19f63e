"""Event-time coercion and ISO-8601 rendering.

Catalog times are UTC wall-clock values of type TIMESTAMP_NTZ. Every function
here gives the same answer whatever ``spark.sql.session.timeZone`` is.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A date, an optional time of day, and nothing else: taken as UTC.
_NAIVE = r"\d{4}(?:-\d{1,2}(?:-\d{1,2}(?:[T ]\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?)?)?)?"
# A date and a time of day, then Z, or an offset of hours and optional minutes
# (after UTC or GMT if need be).
_ZONED = (r"^(\d{4}-\d{1,2}-\d{1,2}[T ]\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?)\s*"
          r"(?:[zZ]|(UTC|GMT)?([+-])(\d{1,2})(?::?([0-5]\d))?|UTC|GMT)$")


def utc_wallclock(ts: Column) -> Column:
    """A zoned TIMESTAMP as its UTC wall clock (TIMESTAMP_NTZ).

    Built as epoch + elapsed microseconds, which involves no time zone; going
    through the session zone's local time would be ambiguous in the hour a
    daylight-saving change repeats.
    """
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(ts), epoch)


def parse_utc_time(text: Column) -> Column:
    """Lenient text → UTC TIMESTAMP_NTZ. Unparseable or empty text → null.

    Text with an offset (``...Z``, ``...+05:00``, ``... UTC+5``) is moved to
    UTC; text without one is taken to be UTC already. ``GMT+5`` is five hours
    behind UTC, as the POSIX zone of that name is. Named zones, offsets with
    seconds and times without a date are unreadable, so no answer depends on
    the session or on today.
    """
    t = F.trim(text.cast("string"))
    # A fraction is read to the microsecond; further digits are cut.
    naive = F.when(t.rlike(f"^{_NAIVE}$"), t.try_cast("timestamp_ntz"))
    wall = F.regexp_extract(t, _ZONED, 1).try_cast("timestamp_ntz")
    hours = F.regexp_extract(t, _ZONED, 4).try_cast("int")
    minutes = F.coalesce(F.regexp_extract(t, _ZONED, 5).try_cast("int"), F.lit(0))
    ahead = (F.regexp_extract(t, _ZONED, 3) == "+") != (F.regexp_extract(t, _ZONED, 2) == "GMT")
    offset = F.when(hours.isNull(), 0).when(hours < 24, F.when(ahead, 1).otherwise(-1) * (hours * 60 + minutes))
    return F.coalesce(naive, F.when(t.rlike(_ZONED), F.timestamp_add("MINUTE", -offset, wall)))


def to_utc_time(value: Column, source_type: T.DataType | None) -> Column:
    """Coerce a column of any type to UTC TIMESTAMP_NTZ."""
    if isinstance(source_type, T.TimestampNTZType):
        return value
    if isinstance(source_type, T.TimestampType):
        return utc_wallclock(value)
    if isinstance(source_type, T.DateType):
        return value.cast("timestamp_ntz")
    return parse_utc_time(value)


def _wallclock_parts(ts: Column) -> tuple[Column, Column]:
    """``yyyy-MM-ddTHH:mm:ss`` and the fraction digits (possibly empty) of a
    TIMESTAMP_NTZ, from its zone-free text form (``cast`` to string involves
    no time zone, unlike ``date_format``, which goes through the session zone
    and would move a wall-clock time that falls in a daylight-saving gap)."""
    text = ts.cast("string")  # yyyy-MM-dd HH:mm:ss[.f…] with trailing zeros dropped
    seconds = F.concat(F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 8))
    fraction = F.substring(text, 21, 6)
    return seconds, fraction


def iso_utc(ts: Column) -> Column:
    """``YYYY-MM-DDTHH:MM:SS[.ffffff]+00:00`` for a UTC TIMESTAMP_NTZ, like
    Python's ``datetime.isoformat`` on an aware UTC value: the fraction is
    printed (six digits) only when it is not zero. Null stays null."""
    seconds, fraction = _wallclock_parts(ts)
    return F.when(F.length(fraction) == 0, F.concat(seconds, F.lit("+00:00"))).otherwise(
        F.concat(seconds, F.lit("."), F.rpad(fraction, 6, "0"), F.lit("+00:00"))
    )


def line_time_text(ts: Column) -> Column:
    """Fixed-width UTC text used by the line codec (six fraction digits always)."""
    seconds, fraction = _wallclock_parts(ts)
    return F.concat(seconds, F.lit("."), F.rpad(fraction, 6, "0"), F.lit("Z"))
