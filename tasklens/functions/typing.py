"""Turning loosely typed source columns into typed ones."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EMPTY_STRINGS = "array<string>"


def blank_to_null(c: Column | str) -> Column:
    """Text of the column, with the empty string read as NULL."""
    return F.nullif(_col(c).cast("string"), F.lit(""))


def safe_long(c: Column | str) -> Column:
    return _col(c).try_cast("bigint")


def safe_bool(text: Column | str) -> Column:
    """Only the words true and false count; '1', 'y' and so on give NULL."""
    word = F.lower(_col(text).cast("string"))
    return F.when(word == "true", F.lit(True)).when(word == "false", F.lit(False))


def safe_timestamp(c: Column | str) -> Column:
    """Instant from ISO text (offsets Z, +hh:mm and +hhmm) or a timestamp; NULL when unreadable.

    Text without an offset is read in the session time zone.
    """
    return _col(c).try_cast("timestamp")


def to_local_datetime(ts: Column | str, tz: str) -> Column:
    """Wall-clock time (no zone) of an instant in the given zone, whatever the session zone is.

    In a UTC session a shift of the instant says the same and is faster, as it looks the zone up once and not per row.
    The session zone is a constant to Catalyst, so only one branch is left in the plan.
    """
    instant = _col(ts).cast("timestamp")
    general = F.convert_timezone(F.current_timezone(), F.lit(tz), instant.cast("timestamp_ntz"))
    shifted = F.from_utc_timestamp(instant, tz).cast("timestamp_ntz")
    return F.when(F.current_timezone().isin("UTC", "Etc/UTC"), shifted).otherwise(general)


def utc_to_local_datetime(ts: Column | str, tz: str) -> Column:
    """As to_local_datetime, for a zone-less column known to hold UTC."""
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), _col(ts).cast("timestamp_ntz"))


def clean_string_array(c: Column | str) -> Column:
    """Array without blank items; NULL becomes the empty array."""
    filled = F.coalesce(_col(c), F.array().cast(EMPTY_STRINGS))
    return F.filter(filled, lambda item: F.trim(item) != "")


def parse_malformed_array(c: Column | str, quoted: bool = False) -> Column:
    """Array out of text like [a,b], or ['a','b'] when quoted. Items are not trimmed."""
    brackets = r"^\[|\]$"
    bare = F.regexp_replace(_col(c), brackets + "|'" if quoted else brackets, "")
    return clean_string_array(F.split(bare, ","))


def flag_from_int_or_json(value: Column | str, json_text: Column) -> Column:
    """1 means true when there is a number, otherwise the JSON boolean decides."""
    number = safe_long(value)
    return F.when(number.isNotNull(), number == 1).otherwise(safe_bool(json_text))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
