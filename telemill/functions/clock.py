"""Clock rules, all independent of the session time zone.

A clock is a TIMESTAMP_NTZ column: what a clock on the wall shows in the zone
that the log type asks for. NULL means that the text is no valid time.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Year 1 to 9999, no zone, no fraction; padding of the other parts is optional.
WALL_CLOCK_PATTERN = r"^(?!0000)\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}\z"

# 0001-01-01 00:00:00 and 10000-01-01 00:00:00 as seconds since 1970.
FIRST_SECOND = -62135596800.0
END_SECOND = 253402300800.0

# Partition keys and the Spark functions that take them from a clock.
PARTS = {"y": "year", "m": "month", "d": "day", "h": "hour"}


def _epoch_start() -> Column:
    return F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00"))


def _shift(clock: Column, source: str, target: str) -> Column:
    if source == target:
        return clock
    return F.convert_timezone(F.lit(source), F.lit(target), clock)


def wall_clock(text: Column) -> Column:
    """`2018-07-01 01:02:03` read as it stands."""
    return F.when(text.rlike(WALL_CLOCK_PATTERN), text.try_cast("timestamp_ntz"))


def epoch_clock(seconds: Column, tz: str = "UTC") -> Column:
    """Clock in `tz` of epoch seconds (double), rounded to microseconds."""
    inside = (seconds >= FIRST_SECOND) & (seconds < END_SECOND)
    micros = F.when(inside, F.rint(seconds * 1e6).try_cast("bigint"))
    return _shift(F.timestamp_add("MICROSECOND", micros, _epoch_start()), "UTC", tz)


def instant_clock(instant: Column) -> Column:
    """UTC clock of a TIMESTAMP column."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), _epoch_start())


def epoch_of(clock: Column, tz: str = "UTC") -> Column:
    """Epoch seconds of a clock that hangs in `tz`."""
    utc = _shift(clock, tz, "UTC")
    days = F.unix_date(utc.cast("date")).cast("bigint")
    return days * 86400 + F.hour(utc) * 3600 + F.minute(utc) * 60 + F.second(utc)


def whole_seconds(seconds: Column) -> Column:
    """Epoch seconds (double) cut to a whole number, toward zero."""
    return seconds.try_cast("bigint")


def minute_label(instant: Column) -> Column:
    """`YYYYmmddHHMM` of an instant in UTC."""
    digits = F.translate(instant_clock(instant).cast("string"), "- :", "")
    return F.substring(digits, 1, 12)
