"""Counts, sums, means and shares, each in one pass and inside the plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstats.functions.timestamps import day


def count_by(df: DataFrame, *keys: str | Column) -> DataFrame:
    """Rows per key as ``count``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


def count_by_month(df: DataFrame, timestamp: str, *keys: str) -> DataFrame:
    """Rows per key and month (``yyyy-MM``) as ``count``.

    Rows are counted per day first, so only one row per day is formatted as text.
    """
    daily = count_by(df, *keys, day(df, timestamp).alias("_day"))
    return daily.groupBy(*keys, F.date_format("_day", "yyyy-MM").alias("month")).agg(
        F.sum("count").alias("count")
    )


def fixed_divisor_mean(total: Column, divisor: int | Column) -> Column:
    """A sum over a divisor the caller names, such as the days of a month."""
    return total.cast("double") / F.lit(divisor).cast("double")


def mean_over_all_rows(value: Column, valid: Column) -> Column:
    """Sum of the valid values over the count of *all* rows."""
    return F.try_divide(F.sum(F.when(valid, value)), F.count(F.lit(1)).cast("double"))


def mean_over_valid_rows(value: Column, valid: Column) -> Column:
    """Sum of the valid values over the count of the valid rows."""
    return F.try_divide(F.sum(F.when(valid, value)), F.count_if(valid).cast("double"))


def share_columns(
    hit: Column, total: str, hits: str, percentage: str = "percentage"
) -> list[Column]:
    """Aggregates for a conditional share; the percentage of no rows is NULL."""
    n_hits, n_all = F.count_if(hit), F.count(F.lit(1))
    ratio = F.try_divide(n_hits.cast("double"), n_all.cast("double"))
    return [n_all.alias(total), n_hits.alias(hits), (ratio * 100).alias(percentage)]


def attach(df: DataFrame, one_row: DataFrame, **columns: str) -> DataFrame:
    """Put values of a one-row aggregate on every row.

    ``columns`` maps a new column to the column of ``one_row``. The aggregate
    becomes a scalar subquery: Spark runs it once, ships its one row as a
    literal, and nothing passes through the driver program.
    """
    row = one_row.select(
        F.struct(*[F.col(source).alias(name) for name, source in columns.items()])
    ).scalar()
    return df.select("*", *[row.getField(name).alias(name) for name in columns])


def attach_by_key(
    df: DataFrame, summary: DataFrame, key: str, value: str, names: Sequence[str]
) -> DataFrame:
    """Put the fields of a struct per key on every row of that key; other rows drop.

    ``summary`` has a row for each of a few keys. It becomes one map, and the map a scalar
    subquery, so the rows meet their values without a shuffle, whatever share a key has.
    """
    pairs = F.collect_list(F.struct(key, value))
    of_key = summary.filter(F.col(key).isNotNull()).select(F.map_from_entries(pairs)).scalar()
    fields = F.element_at(of_key, F.col(key))
    known = df.filter(F.col(key).isNotNull())
    # by place, as the struct's own names may be those of expressions
    inner = summary.schema[value].dataType.names
    return known.select("*", *(fields.getField(x).alias(n) for x, n in zip(inner, names)))
