"""The trip table on disk: Parquet, partitioned by load, fleet and pickup month.

Trips lie in ``trips/load=<name>/version=<id>/taxi_type=<tag>/pickup_month=<yyyy-MM>``. A load
is written under a new version; when all its files are in place a row in ``loads`` makes
that version the load's current one, and readers follow those rows. So loading again under a
name replaces that load and nothing else, whatever stray months its files hold, and a load
that fails, at any stage, leaves the rows before it as they were. A query for a period
reads the folders of its months only, which replaces choosing monthly files by hand.
"""

from __future__ import annotations

import re
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstats.functions.timestamps import month
from tripstats.model import Fleet

_LOAD_NAME = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]*")
_LOADS = "load string, version string, number long"


def _folder(path: str, load: str, version: str) -> str:
    return f"{path.rstrip('/')}/trips/load={load}/version={version}"


def _finished_loads(spark: SparkSession, path: str) -> list:
    """Every load that was finished, a row each: load, version and its number in that load."""
    try:
        return spark.read.schema(_LOADS).json(f"{path.rstrip('/')}/loads").collect()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def current_loads(spark: SparkSession, path: str) -> dict[str, str]:
    """The current version of every load. Of two written at once, the one whose version is
    greater."""
    rows = sorted(_finished_loads(spark, path), key=lambda x: (x.number, x.version))
    return {x.load: x.version for x in rows}


def write_trip_table(trips: DataFrame, path: str, load: str) -> None:
    """Write trips as one load, by fleet and month.

    ``rebalance`` gathers the rows of a partition into few files and lets
    adaptive execution cut a partition that is too large, so a month or a fleet
    with a third of all rows is written by many tasks. The versions before stay until
    ``drop_replaced``, for those who are reading them.
    """
    if not _LOAD_NAME.fullmatch(load):
        raise ValueError(f"a load is named by letters, digits, '.', '_' and '-', not {load!r}")
    spark, version = trips.sparkSession, f"v{uuid4().hex}"
    (
        trips.withColumn("pickup_month", month(trips, "pickup_ts"))
        .hint("rebalance", "taxi_type", "pickup_month")
        .write.partitionBy("taxi_type", "pickup_month")
        .parquet(_folder(path, load, version))
    )
    earlier = [x.number for x in _finished_loads(spark, path) if x.load == load]
    row = [(load, version, max(earlier, default=0) + 1)]
    # one row is one file, which appears whole when Spark commits it
    finished = spark.createDataFrame(row, _LOADS).coalesce(1)
    finished.write.mode("append").json(f"{path.rstrip('/')}/loads")


def drop_replaced(spark: SparkSession, path: str) -> list[str]:
    """Delete the versions that a later one has replaced, and return their folders.

    Versions that are being written, or whose load failed, have no row and are not touched.
    """
    current = current_loads(spark, path)
    dropped = []
    for x in _finished_loads(spark, path):
        folder = _folder(path, x.load, x.version)
        place = spark._jvm.org.apache.hadoop.fs.Path(folder)
        files = place.getFileSystem(spark._jsc.hadoopConfiguration())
        if current[x.load] != x.version and files.exists(place) and files.delete(place, True):
            dropped.append(folder)
    return dropped


def _month_near(time: str, months: int):
    """The month of a time, moved; NULL for text that is no time. A constant to Spark, so
    that folders are pruned by it."""
    moved = F.add_months(F.lit(time).try_cast("timestamp"), months)
    return F.date_format(moved, "yyyy-MM")


def read_trip_table(
    spark: SparkSession,
    path: str,
    start: str | None = None,
    end: str | None = None,
    fleet: Fleet | None = None,
) -> DataFrame:
    """All loads of the trip table, pruned to a fleet and to the months of a period.

    The month folders are those of the session time zone at loading. A month is therefore
    read on either side of the period, whose exact filter is the caller's.
    """
    loads = current_loads(spark, path)
    if not loads:
        raise ValueError(f"no load was finished at {path}")
    folders = [_folder(path, *x) for x in loads.items()]
    trips = spark.read.option("basePath", f"{path.rstrip('/')}/trips").parquet(*folders)
    trips = trips.drop("load", "version")
    if start is not None:
        trips = trips.filter(F.col("pickup_month") >= F.coalesce(_month_near(start, -1), F.lit("")))
    if end is not None:
        trips = trips.filter(F.col("pickup_month") <= F.coalesce(_month_near(end, 1), F.lit("~")))
    if fleet is not None:
        trips = trips.filter(F.col("taxi_type") == fleet.tag)
    return trips
