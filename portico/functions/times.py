"""Times: strict and lenient parsing, text forms, quarter hours and calendar cells, all in UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

QUARTER = 900
#: A visit without an exit ends after so many seconds.
LONGEST_VISIT = 4 * 3600
FRAME_NAME = r"([0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}-[0-9]{2}-[0-9]{2}\.[0-9]{1,6}Z)\.jpg$"


def frame_time(name: Column) -> Column:
    """Capture time in an object's base name (`2024-01-30T12-07-30.5Z.jpg`, 1 to 6 fraction digits), else null."""
    base = F.substring_index(name, "/", -1)
    stamp = F.regexp_extract(base, "^" + FRAME_NAME, 1)
    padded = F.concat(F.rpad(F.regexp_replace(stamp, "Z$", ""), 26, "0"), F.lit("Z"))
    return F.when(stamp != "", F.try_to_timestamp(padded, F.lit("yyyy-MM-dd'T'HH-mm-ss.SSSSSSX")))


def strict_time(text: Column) -> Column:
    """A time from its millisecond text; anything else is an error."""
    got = F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSSSS][.SSSS][.SSS][.SS][.S]X"))
    return F.when(text.isNotNull() & got.isNull(), F.raise_error(F.concat(F.lit("not a time: "), text))).otherwise(got)


def milli_text(time: Column) -> Column:
    """Millisecond text of a time; the rest is cut off."""
    return F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def second_text(seconds: Column) -> Column:
    return F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def quarter(seconds: Column) -> Column:
    """The begin of a second's quarter hour."""
    return (F.floor(seconds / QUARTER) * QUARTER).cast("long")


def day_of(seconds: Column) -> Column:
    return F.floor(seconds / 86400).cast("long")


def week_of(seconds: Column) -> Column:
    """Whole ISO weeks (from Monday) since the one of 1970-01-01."""
    return F.floor((F.floor(seconds / 86400) + 3) / 7).cast("long")


def weekday(seconds: Column) -> Column:
    """Monday 0 to Sunday 6."""
    return F.pmod(F.floor(seconds / 86400) + 3, F.lit(7)).cast("int")


def hour_of(seconds: Column) -> Column:
    return F.pmod(F.floor(seconds / 3600), F.lit(24)).cast("int")


def month_of(seconds: Column) -> Column:
    return F.month(F.timestamp_seconds(seconds)).cast("int")


def year_of(seconds: Column) -> Column:
    return F.year(F.timestamp_seconds(seconds)).cast("int")
