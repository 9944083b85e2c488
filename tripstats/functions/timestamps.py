"""Timestamps, days, months and durations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripstats.model import TS_FORMAT


def parsed(df: DataFrame, name: str, fmt: str = TS_FORMAT) -> Column:
    """The column as a timestamp. Text that does not fit ``fmt`` becomes NULL.

    A column that is a timestamp already is used as it is: printing and parsing
    it again would lose every value with a fraction of a second.
    """
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.try_to_timestamp(F.col(name), F.lit(fmt))
    return F.col(name)


def whole_second(name: str) -> Column:
    """Whether a timestamp has no fraction of a second."""
    return F.unix_micros(F.col(name).cast("timestamp")) % 1_000_000 == 0


def unix_seconds(df: DataFrame, name: str, fmt: str = TS_FORMAT) -> Column:
    """Seconds since the epoch; read in the session time zone, NULL if unreadable."""
    return F.unix_timestamp(parsed(df, name, fmt))


def day(df: DataFrame, name: str) -> Column:
    return F.to_date(parsed(df, name))


def month(df: DataFrame, name: str) -> Column:
    """Month as ``yyyy-MM`` text."""
    return F.date_format(parsed(df, name), "yyyy-MM")


def elapsed(df: DataFrame, start: str, end: str) -> Column:
    """``end - start`` as a day-time interval."""
    return parsed(df, end) - parsed(df, start)


def interval_text(interval: Column) -> Column:
    """A day-time interval as text, ``INTERVAL '1 00:08:26' DAY TO SECOND``."""
    return interval.cast("string")


def interval_seconds(interval: Column) -> Column:
    """Whole seconds of a day-time interval, whatever the session time zone."""
    seconds = (
        F.extract(F.lit("DAY"), interval).cast("bigint") * 86400
        + F.extract(F.lit("HOUR"), interval).cast("bigint") * 3600
        + F.extract(F.lit("MINUTE"), interval).cast("bigint") * 60
        + F.extract(F.lit("SECOND"), interval).cast("bigint")
    )
    return seconds.cast("bigint")


def days_between(period: tuple[str, str], closed: str = "neither") -> tuple[Column, Column]:
    """First and last day of a period, as constants; an end at midnight that does not count
    leaves its day out."""
    start, end = (F.lit(x).cast("timestamp_ntz") for x in period)
    if closed in ("left", "neither"):
        end = end - F.expr("INTERVAL 1 MICROSECOND")
    return F.to_date(start), F.to_date(end)


def days_in(period: tuple[str, str], closed: str = "neither") -> Column:
    """How many days a period touches."""
    first, last = days_between(period, closed)
    return F.datediff(last, first) + 1
