"""Date and time expressions.

Wall clocks are TIMESTAMP_NTZ, instants are TIMESTAMP. No expression depends on
the session time zone: zones are always arguments.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Day zero of spreadsheet serial numbers.
SERIAL_ORIGIN = "1899-12-30"
SERIAL_TEXT = "^[0-9]{5}"
PACIFIC = "America/Los_Angeles"

_YMD_HMS = (
    r"^\s*(\d{4})[^0-9]+(\d{1,2})[^0-9]+(\d{1,2})[^0-9]+(\d{1,2})[^0-9]+(\d{1,2})[^0-9]+(\d{1,2}(?:\.\d+)?)[^0-9]*$"
)


def parse_wall_clock(col: Column) -> Column:
    """Year-month-day-hour-minute-second text with any separators; other text gives NULL."""
    tidy = F.regexp_replace(col, _YMD_HMS, "$1-$2-$3 $4:$5:$6")
    return F.when(col.rlike(_YMD_HMS), tidy).try_cast("timestamp_ntz")


def parse_iso_clock(col: Column) -> Column:
    """As ``parse_wall_clock``, and ISO dates with hours and minutes, or without any time: midnight."""
    iso = col.rlike(r"^\s*\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2})?\s*$")
    return F.coalesce(parse_wall_clock(col), F.when(iso, F.trim(col)).try_cast("timestamp_ntz"))


def serial_to_timestamp(col: Column) -> Column:
    """Days since the spreadsheet origin (number or numeric text) to a wall clock, to the second."""
    seconds = F.round(col.try_cast("double") * 86400).cast("bigint")
    return F.timestamp_add("SECOND", seconds, F.lit(SERIAL_ORIGIN).cast("timestamp_ntz"))


def serial_to_date(col: Column) -> Column:
    days = F.floor(col.try_cast("double")).cast("int")
    return F.date_add(F.lit(SERIAL_ORIGIN).cast("date"), days)


def serial_or_text(col: Column, parse) -> Column:
    """Serial numbers are recognised by five leading digits; the rest goes to ``parse``."""
    return F.when(col.rlike(SERIAL_TEXT), serial_to_timestamp(col)).otherwise(parse(col))


def hours_between(start: Column, end: Column) -> Column:
    """end − start in hours, to the microsecond."""
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(3.6e9)


def add_seconds(ts: Column, seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds.cast("bigint"), ts)


def to_instant(utc_clock: Column) -> Column:
    """A UTC wall clock as an instant."""
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), utc_clock)
    return F.timestamp_micros(micros)


def utc_clock(instant: Column) -> Column:
    """An instant as a UTC wall clock."""
    micros = F.unix_micros(instant)
    return F.timestamp_add("MICROSECOND", micros, F.lit("1970-01-01").cast("timestamp_ntz"))


def in_zone(clock: Column, zone: str) -> Column:
    """A UTC wall clock read in another zone (same instant)."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), clock)


def force_zone(clock: Column, zone: str) -> Column:
    """UTC wall clock of a local wall clock; NULL for local times a DST gap skips.

    Spark moves gap times forward, so a time that does not survive the round trip
    never existed. Of a doubled hour the first pass is taken.
    """
    there = F.convert_timezone(F.lit(zone), F.lit("UTC"), clock)
    return F.when(in_zone(there, zone) == clock, there)


def date_plus_clock(day: Column, seconds_of_day: Column) -> Column:
    """A date and a time of day; times in hour 0 belong to the end of the shift day."""
    start = F.date_trunc("DAY", day.cast("timestamp_ntz")).cast("timestamp_ntz")
    late = F.when(seconds_of_day < 3600, seconds_of_day + 86400).otherwise(seconds_of_day)
    return F.timestamp_add("SECOND", late.cast("bigint"), start)


def seconds_of_day(clock: Column) -> Column:
    return F.hour(clock) * 3600 + F.minute(clock) * 60 + F.second(clock)


def seconds_of_clock_text(col: Column) -> Column:
    """``HH:MM:SS`` text to seconds of day; other text gives NULL."""
    part = lambda i: F.regexp_extract(col, r"^\s*(\d{1,2}):(\d{1,2}):(\d{1,2})\s*$", i).try_cast("int")
    return part(1) * 3600 + part(2) * 60 + part(3)


def hour_minute(clock: Column) -> Column:
    return F.date_format(clock, "HH:mm")


def ceil_hour(clock: Column) -> Column:
    floor = F.date_trunc("HOUR", clock).cast("timestamp_ntz")
    return F.when(floor == clock, clock).otherwise(floor + F.expr("INTERVAL 1 HOUR"))


def floor_hour(clock: Column) -> Column:
    return F.date_trunc("HOUR", clock).cast("timestamp_ntz")


def shift_hours(start: Column, end: Column) -> Column:
    """Length of a shift in hours; a reversed shift counts by its absolute length."""
    return F.abs(hours_between(start, end))
