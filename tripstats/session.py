"""A session for running the jobs from the command line."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution sizes the shuffles and splits hot partitions; statistics on
# file sizes decide what may be broadcast. spark-submit settings win over these.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def session(app_name: str) -> SparkSession:
    spark = SparkSession.builder.appName(app_name).getOrCreate()
    given = {key for key, _ in spark.sparkContext.getConf().getAll()}
    for key, value in DEFAULTS.items():
        if key not in given:
            spark.conf.set(key, value)
    return spark
