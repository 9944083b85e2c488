"""CSV results."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame


def stamped(base: str, name: str, at: datetime | None = None) -> str:
    """``base/name_<run stamp>``; the stamp has no ``:``, which HDFS refuses."""
    return f"{base}/{name}_{(at or datetime.now()).strftime('%d-%m-%Y_%H-%M-%S')}"


def write_csv(
    df: DataFrame,
    path: str,
    single_file: bool = False,
    by: Sequence[str] = (),
    order: Sequence[str] = (),
) -> None:
    """Write a CSV folder with headers, replacing what is there.

    ``by`` names columns that become one subfolder per value.

    ``single_file`` is for results that are small by nature (per borough, per day, per
    month): their finished rows, no others, are sent to one task, which sorts them by
    ``order``. Row-level results stay spread over the tasks that made them.
    """
    if single_file:
        df = df.repartition(1)
        if order:
            df = df.sortWithinPartitions(*order)
    df.write.mode("overwrite").option("header", True).partitionBy(*by).csv(path)
