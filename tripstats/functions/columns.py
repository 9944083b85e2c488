"""Column readings that hold for typed frames and for all-text frames.

They look at the analysed schema only, so no Spark job runs, and they use
``try_cast`` so that ANSI and non-ANSI sessions agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def numeric(df: DataFrame, name: str) -> Column:
    """The column as a number; text that is no number becomes NULL."""
    if isinstance(df.schema[name].dataType, T.NumericType):
        return F.col(name)
    return F.col(name).try_cast("double")


def text(name: str) -> Column:
    """The column as Spark prints it."""
    return F.col(name).cast("string")


def location_key(df: DataFrame, name: str) -> Column:
    """A location id as an integer join key: ``132``, ``'132'`` and ``'132.0'`` agree."""
    if isinstance(df.schema[name].dataType, T.IntegralType):
        return F.col(name)
    return F.col(name).try_cast("double").try_cast("int")


def bound_like(df: DataFrame, name: str, bound: str) -> Column:
    """A bound written as text, in the type of the column it is compared with.

    The cast is on the literal, so it folds to a constant and the comparison
    stays a plain column predicate that can be pushed to the scan.
    """
    return F.lit(bound).cast(df.schema[name].dataType)
