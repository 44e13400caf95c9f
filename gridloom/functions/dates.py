"""Timestamps are wall-clock times without a zone (``timestamp_ntz``).

``date_format`` and ``date_trunc`` would first move such a value through the
session time zone, which shifts times inside a daylight-saving gap. The text
parts here are cut from the zone-free text form instead.
"""

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridloom.constants import DAY_PERIODS


def wall_clock(moment: datetime) -> Column:
    """A Python date-time as a literal that no session time zone shifts."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def parse_timestamp(text: Column) -> Column:
    """Text to wall-clock timestamp; unreadable text becomes null."""
    return text.try_cast("timestamp_ntz")


def wall_clock_text(ts: Column) -> Column:
    return ts.cast("timestamp_ntz").cast("string")


def year_month(ts: Column) -> Column:
    """``yyyy-MM``"""
    return F.substring(wall_clock_text(ts), 1, 7)


def hour_minute(ts: Column) -> Column:
    """``HH:mm``"""
    return F.substring(wall_clock_text(ts), 12, 5)


def hour_bucket(ts: Column) -> Column:
    """``yyyy-MM-dd HH``"""
    return F.substring(wall_clock_text(ts), 1, 13)


def date_text(day: Column) -> Column:
    """``yyyy-MM-dd``"""
    return F.to_date(day).cast("string")


def truncate_fraction(instant: Column) -> Column:
    """Instant text without its fraction of a second."""
    return F.substring_index(instant, ".", 1)


def iso_date(instant: Column) -> Column:
    """The part of an ISO instant before its ``T``."""
    return F.nullif(F.split_part(instant, F.lit("T"), F.lit(1)), F.lit(""))


def iso_time(instant: Column) -> Column:
    """``HH:mm:ss`` of an ISO instant; null when there is no ``T``."""
    time = F.substring(F.split_part(instant, F.lit("T"), F.lit(2)), 1, 8)
    return F.nullif(time, F.lit(""))


def iso_date_time(instant: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss``; null when either part is missing."""
    return F.concat(iso_date(instant), F.lit(" "), iso_time(instant))


def compose_timestamp_text(day: Column, hour_and_minute: Column) -> Column:
    """Date text and ``HH:mm`` text as one full timestamp text."""
    return F.concat(day, F.lit(" "), hour_and_minute, F.lit(":00.00000"))


def year_month_key(year: Column, month: Column) -> Column:
    """Two integers as ``yyyy-MM``."""
    return F.concat(
        year.cast("string"), F.lit("-"), F.lpad(month.cast("string"), 2, "0")
    )


def day_period(hour: Column) -> Column:
    """Name of the period of the day an hour (0-23) falls into; null without one."""
    label = F.when(hour.isNotNull(), F.lit(DAY_PERIODS[-1][1]))
    for end, name in reversed(DAY_PERIODS[:-1]):
        label = F.when(hour < end, F.lit(name)).otherwise(label)
    return label
