"""Text to number, timestamp and date, giving NULL instead of an error.

Ids: FN-1, FN-2, FN-3, FN-7, FN-8, PRJ-9.

With ANSI mode on the plain parsers raise on the first mismatch, so a
``coalesce`` of them never reaches its second pattern.  The ``try_`` family
returns NULL, but a failed attempt costs an exception per row.  The accepted
text shapes exclude each other, so the shape is looked at first: every row is
parsed once at most, and text of no known shape not at all.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Accepted text patterns. The quoted Z is a literal, not a zone:
# "2026-05-09T23:30:00Z" is 23:30 in the session's own zone.
FRACTION_Z = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
SECOND_Z = "yyyy-MM-dd'T'HH:mm:ss'Z'"
SPACED = "yyyy-MM-dd HH:mm:ss"
DAY = "yyyy-MM-dd"

# What text must look like to have a chance with each pattern. Spark's parser
# ignores case and takes one to six fraction digits.
_DATE_SHAPE = r"^[+-]?\d{4,}-\d\d-\d\d"
_CLOCK_SHAPE = r"\d\d:\d\d:\d\d"
_SHAPES = {
    FRACTION_Z: _DATE_SHAPE + "[Tt]" + _CLOCK_SHAPE + r"\.\d{1,6}[Zz]$",
    SECOND_Z: _DATE_SHAPE + "[Tt]" + _CLOCK_SHAPE + "[Zz]$",
    SPACED: _DATE_SHAPE + " " + _CLOCK_SHAPE + "$",
    DAY: _DATE_SHAPE + "$",
}

# Columns a record's calendar day may come from, best first.
DAY_CANDIDATES = ("PartitionDate", "BestUtcDateTime", "timeutc", "datetimeutc")

# Event-time columns, best first.
EVENT_TIME_CANDIDATES = (
    "LocalDateTime",
    "BestLocalDateTime",
    "BestUtcDateTime",
    "UploadLocalDateTime",
)


def _as_column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def bigint_or_null(value: str | Column) -> Column:
    """Trimmed text as bigint; blank, fractional or oversized text is NULL."""
    return F.trim(_as_column(value).cast("string")).try_cast("bigint")


def numeric_suffix(value: str | Column) -> Column:
    """Digits at the very end of a name as bigint, NULL without any."""
    text = _as_column(value).cast("string")
    return bigint_or_null(F.regexp_extract(text, r"(\d+)$", 1))


def normalize_identifier(value: str | Column) -> Column:
    """Strip brackets and whitespace from both ends; the inside stays."""
    text = _as_column(value).cast("string")
    return F.regexp_replace(text, r"^[\[\]\s]+|[\[\]\s]+$", "")


def _by_shape(text: Column, *patterns: str) -> Column:
    """Timestamp by the one pattern whose shape the text has, else NULL."""
    parsed = F.lit(None).cast("timestamp")
    for pattern in patterns[::-1]:
        parsed = F.when(
            text.rlike(_SHAPES[pattern]),
            F.try_to_timestamp(text, F.lit(pattern)).cast("timestamp"),
        ).otherwise(parsed)
    return parsed


def text_to_timestamp(value: str | Column) -> Column:
    """Parse the three timestamp shapes; anything else is NULL."""
    return _by_shape(_as_column(value), FRACTION_Z, SECOND_Z, SPACED)


def text_to_date(value: str | Column) -> Column:
    """Parse a bare day or a whole-second Z timestamp as a date."""
    return F.to_date(_by_shape(_as_column(value), DAY, SECOND_Z))


def text_to_event_date(value: str | Column) -> Column:
    """Day of a fractional Z timestamp, a spaced timestamp or a bare day."""
    return F.to_date(_by_shape(_as_column(value), FRACTION_Z, SPACED, DAY))


def day_of(value: Column, dtype: T.DataType) -> Column | None:
    """Calendar day of a candidate column, None for types that hold no day.

    A zone-free timestamp keeps its own calendar day.
    """
    if isinstance(dtype, T.StringType):
        return text_to_event_date(value)
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.to_date(value)
    return None


def event_day(schema: T.StructType) -> Column:
    """First non-NULL day among the candidate columns present in ``schema``."""
    types = {field.name: field.dataType for field in schema.fields}
    days = [
        day
        for name in DAY_CANDIDATES
        if name in types and (day := day_of(F.col(name), types[name])) is not None
    ]
    return F.coalesce(*days) if days else F.lit(None).cast("date")


def event_time_column(columns: list[str]) -> str:
    """Name of the event-time column: by name, at plan time (PRJ-8)."""
    for name in EVENT_TIME_CANDIDATES:
        if name in columns:
            return name
    raise ValueError(f"no event-time column; expected one of {EVENT_TIME_CANDIDATES}")


def epoch_micros(value: Column, dtype: T.DataType) -> Column:
    """Microseconds on a scale that orders like the timestamp itself.

    A zone-free timestamp is measured on its own calendar: going through the
    session zone would reorder times inside a clock change.
    """
    if isinstance(dtype, T.TimestampNTZType):
        seconds = (
            F.unix_date(F.to_date(value)).cast("bigint") * 86400
            + F.hour(value) * 3600
            + F.minute(value) * 60
        )
        return seconds * 1_000_000 + (
            F.extract(F.lit("SECOND"), value) * 1_000_000
        ).cast("bigint")
    if isinstance(dtype, T.StringType):
        # Text of another shape that still casts to a day must have a place too.
        usual = text_to_timestamp(value)
        return F.unix_micros(F.coalesce(usual, value.try_cast("timestamp")))
    return F.unix_micros(value.cast("timestamp"))
