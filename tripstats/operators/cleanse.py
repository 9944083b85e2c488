"""Cleansing of trip rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from tripstats.functions.columns import text
from tripstats.model import COMPAT, MEASURES, TIMESTAMPS, TYPED, check_mode
from tripstats.operators import predicates


def all_text(df: DataFrame) -> DataFrame:
    """Every column as text."""
    return df.select(*[text(name).alias(name) for name in df.columns])


def cleanse(
    df: DataFrame,
    timestamps: Iterable[str] = TIMESTAMPS,
    measures: Iterable[str] = MEASURES,
    non_negative: bool = True,
    mode: str = TYPED,
    keep_types: bool = False,
) -> DataFrame:
    """Drop rows with unreadable times and, on request, with negative measures.

    Compat mode applies the rules to the values as text and returns every column
    as text. ``keep_types`` leaves the columns as they are, for a job that goes
    on filtering: predicates on typed columns reach the scan, on text they do not.
    """
    check_mode(mode)
    df = predicates.parsable(df, timestamps, mode=mode)
    if non_negative:
        df = predicates.non_negative(df, measures, mode)
    return all_text(df) if mode == COMPAT and not keep_types else df
