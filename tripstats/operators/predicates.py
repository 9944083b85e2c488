"""Row filters: open and closed time ranges, thresholds, equality, sign.

Typed comparisons keep the column bare on one side and a constant on the other,
which is what lets Spark push them into a Parquet scan.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripstats.functions.columns import bound_like, numeric, text
from tripstats.functions.timestamps import parsed, whole_second
from tripstats.model import COMPAT, MEASURES, TIMESTAMPS, TS_FORMAT, TYPED, check_mode

# ---- fixed values -----------------------------------------------------------
# Text that a non-ANSI session accepts when it compares a string with an int:
# plain decimal digits without exponent, whose truncated value is an int >= 0.
PLAIN_DECIMAL = r"^ *[+-]?[0-9]+([.][0-9]*)? *$"
INT_TRUNCATES_TO_ZERO_ABOVE = -1.0
INT_RANGE_END = 2147483648.0
# A double prints without exponent from the first of these up to the second.
SMALLEST_PLAIN_DOUBLE = 1.0e-3
FIRST_LARGE_DOUBLE = 1.0e7
# -----------------------------------------------------------------------------

CLOSED = ("left", "right", "both", "neither")


def _all_of(conditions: Iterable[Column]) -> Column:
    return reduce(and_, conditions, F.lit(True))


def parsable(
    df: DataFrame,
    names: Iterable[str] = TIMESTAMPS,
    fmt: str = TS_FORMAT,
    mode: str = TYPED,
) -> DataFrame:
    """Rows whose timestamps are all present and readable.

    In compat mode a timestamp counts as the text it prints: one with a fraction
    of a second does not fit the default format, so its row drops.
    """
    check_mode(mode)
    conditions = []
    for name in names:
        conditions.append(parsed(df, name, fmt).isNotNull())
        if mode == COMPAT and not isinstance(df.schema[name].dataType, T.StringType):
            conditions.append(whole_second(name))
    return df.filter(_all_of(conditions))


def _plain_non_negative(df: DataFrame, name: str) -> Column:
    """Whether the text of a measure passes ``>= 0`` as a non-ANSI session reads it.

    For a double that is a matter of its value, which Parquet statistics can
    decide; for anything else the text itself is looked at.
    """
    if isinstance(df.schema[name].dataType, T.DoubleType):
        value = F.col(name)
        return (
            ((value >= SMALLEST_PLAIN_DOUBLE) & (value < FIRST_LARGE_DOUBLE))
            | (value == 0.0)
            | ((value > INT_TRUNCATES_TO_ZERO_ABOVE) & (value <= -SMALLEST_PLAIN_DOUBLE))
        )
    value = text(name).try_cast("double")
    return (
        text(name).rlike(PLAIN_DECIMAL)
        & (value > INT_TRUNCATES_TO_ZERO_ABOVE)
        & (value < INT_RANGE_END)
    )


def non_negative(
    df: DataFrame, names: Iterable[str] = MEASURES, mode: str = TYPED
) -> DataFrame:
    """Rows whose measures are all ``>= 0``.

    In compat mode the text of the measure is compared with the integer 0 by
    cutting its fraction: ``-0.5`` passes, ``1.0E-4`` and ``3000000000.0`` do not.
    """
    if check_mode(mode) == TYPED:
        return df.filter(_all_of(numeric(df, name) >= 0 for name in names))
    return df.filter(_all_of(_plain_non_negative(df, name) for name in names))


def time_range(
    df: DataFrame,
    name: str,
    start: str | None,
    end: str | None,
    closed: str = "left",
) -> DataFrame:
    """Rows with ``name`` between two times; ``closed`` says which ends count.

    A bound of None leaves that side open-ended.
    """
    if closed not in CLOSED:
        raise ValueError(f"closed must be one of {CLOSED}, not {closed!r}")
    conditions = []
    if start is not None:
        low = bound_like(df, name, start)
        inclusive = closed in ("left", "both")
        conditions.append(F.col(name) >= low if inclusive else F.col(name) > low)
    if end is not None:
        high = bound_like(df, name, end)
        inclusive = closed in ("right", "both")
        conditions.append(F.col(name) <= high if inclusive else F.col(name) < high)
    return df.filter(_all_of(conditions))


def above(df: DataFrame, name: str, threshold: str, mode: str = TYPED) -> DataFrame:
    """``name > threshold``, as numbers or as text."""
    if check_mode(mode) == TYPED:
        return df.filter(numeric(df, name) > float(threshold))
    return df.filter(text(name) > F.lit(threshold))


def below(df: DataFrame, name: str, threshold: str, mode: str = TYPED) -> DataFrame:
    """``name < threshold``, as numbers or as text."""
    if check_mode(mode) == TYPED:
        return df.filter(numeric(df, name) < float(threshold))
    return df.filter(text(name) < F.lit(threshold))


def is_value(df: DataFrame, name: str, value: str, mode: str = TYPED) -> Column:
    """The condition ``name = value``, as numbers or as text (``'1'`` is not ``'1.0'``)."""
    if check_mode(mode) == TYPED:
        return numeric(df, name) == float(value)
    return text(name) == F.lit(value)


def of_fleet(df: DataFrame, tag: str) -> DataFrame:
    """Trips of one fleet, named by the caller, not guessed from a first row."""
    return df.filter(F.col("taxi_type") == tag)
