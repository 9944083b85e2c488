"""Top-k with named tie-breaks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _order(by: str, ties: Sequence[str]):
    return [F.desc(by), *[F.asc_nulls_first(name) for name in ties]]


def top_k(df: DataFrame, k: int, by: str, ties: Sequence[str]) -> DataFrame:
    """The ``k`` largest rows, largest first; ``ties`` decide between equals."""
    return df.orderBy(*_order(by, ties)).limit(k)


def top_k_per_group(
    df: DataFrame, k: int, group: Sequence[str], by: str, ties: Sequence[str]
) -> DataFrame:
    """The ``k`` largest rows of every group.

    Spark keeps only the best ``k`` of a group per task before it shuffles, so a
    group with most of the rows stays small on the wire.
    """
    window = Window.partitionBy(*group).orderBy(*_order(by, ties))
    return (
        df.withColumn("_rank", F.row_number().over(window))
        .filter(F.col("_rank") <= k)
        .drop("_rank")
    )
