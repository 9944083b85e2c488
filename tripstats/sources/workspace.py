"""Where written intermediate tables go."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from functools import cache
from uuid import uuid4

from pyspark.sql import SparkSession


@cache
def _local_folder(application_id: str) -> str:
    """A folder of one local session; it goes when the program ends."""
    folder = tempfile.mkdtemp(prefix="tripstats-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session may do without the setting; it gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    folder = folder or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return _local_folder(spark.sparkContext.applicationId)


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/tripstats/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one written table."""
    return f"{_own_folder(spark)}/{name}-{uuid4().hex}"


def drop_written(spark: SparkSession) -> bool:
    """Delete the tables that this application has written so far. Results that still read them
    can't be computed afterwards; tables of other applications stay."""
    place = spark._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
