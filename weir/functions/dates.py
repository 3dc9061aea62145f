"""Epoch milliseconds to and from calendar text, with an explicit zone.

The session time zone is never used: values go through TIMESTAMP_NTZ and
``convert_timezone``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The zone days are counted in, and the offset calendar text is read with.
ZONE = "Asia/Shanghai"
OFFSET = "+08:00"

DAY_MS = 86_400_000
# Spark timestamps are microseconds in a BIGINT; two days of slack leave room for zone and day shifts.
_LIMIT_MS = (2**63 - 1) // 1000 - 2 * DAY_MS


def epoch_ms(time: Column) -> Column:
    """TIMESTAMP_NTZ, read as UTC, to epoch milliseconds, rounded down."""
    since = (time - _epoch()).cast("interval second").cast("decimal(20,6)")
    return F.floor(since * 1000).cast("bigint")


def _epoch() -> Column:
    return F.expr("timestamp_ntz'1970-01-01 00:00:00'")


def _local_time(ms: Column, zone: str) -> Column:
    utc = F.timestamp_add("MILLISECOND", ms, _epoch())
    return F.when(
        ms.between(-_LIMIT_MS, _LIMIT_MS),
        F.convert_timezone(F.lit("UTC"), F.lit(zone), utc),
    )


def is_dated(ms: Column) -> Column:
    """True when both the day and the previous day of an instant can be told."""
    return F.coalesce(ms.between(DAY_MS - _LIMIT_MS, _LIMIT_MS - DAY_MS), F.lit(False))


def day(ms: Column, zone: str = ZONE) -> Column:
    """Calendar day of an instant as DATE; NULL when Spark cannot represent the instant."""
    return _local_time(ms, zone).cast("date")


def previous_day(ms: Column, zone: str = ZONE) -> Column:
    """Calendar day 24 hours earlier."""
    return day(F.try_subtract(ms, F.lit(DAY_MS)), zone)


def to_date(ms: Column, zone: str = ZONE) -> Column:
    """``yyyy-MM-dd``"""
    return day(ms, zone).cast("string")


def to_date_time(ms: Column, zone: str = ZONE) -> Column:
    """``yyyy-MM-dd HH:mm:ss``"""
    # date_format would read the local time in the session's zone.
    return F.substring_index(_local_time(ms, zone).cast("string"), ".", 1)


def to_ms(date_text: Column, full: bool = False, zone: str = OFFSET) -> Column:
    """``yyyy-MM-dd`` (or ``yyyy-MM-dd HH:mm:ss`` when ``full``) to epoch milliseconds.

    A day past the end of its month counts as the last day of that month, ``24:00:00`` as
    midnight of the next day, and any other malformed text gives NULL.
    """
    whole = date_text if full else F.concat(date_text, F.lit(" 00:00:00"))
    shape = r"^\d{4}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01]) (([01]\d|2[0-3]):[0-5]\d:[0-5]\d|24:00:00)$"

    def number(start: int, length: int) -> Column:
        return F.substring(whole, start, length).try_cast("int")

    first_of_month = F.concat(F.substring(whole, 1, 8), F.lit("01")).try_cast("date")
    date = F.date_add(first_of_month, F.least(number(9, 2), F.dayofmonth(F.last_day(first_of_month))) - 1)
    midnight = F.concat(date.cast("string"), F.lit(" 00:00:00")).try_cast("timestamp_ntz")
    seconds = number(12, 2) * 3600 + number(15, 2) * 60 + number(18, 2)
    local = F.timestamp_add("SECOND", seconds, midnight)
    utc = F.convert_timezone(F.lit(zone), F.lit("UTC"), local)
    return F.when(whole.rlike(shape), epoch_ms(utc))
