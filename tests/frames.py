"""Small trip tables for the tests."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

SCHEMA = (
    "taxi_type string, pickup_ts timestamp, dropoff_ts timestamp, PULocationID int, "
    "DOLocationID int, trip_distance double, fare_amount double, passenger_count double, "
    "airport_fee double"
)

DEFAULTS = {
    "taxi_type": "yellow_taxi",
    "pickup_ts": "2023-01-02 10:00:00",
    "dropoff_ts": "2023-01-02 10:20:00",
    "PULocationID": 1,
    "DOLocationID": 2,
    "trip_distance": 2.0,
    "fare_amount": 10.0,
    "passenger_count": 1.0,
    "airport_fee": 0.0,
}


def _time(value):
    return datetime.fromisoformat(value) if isinstance(value, str) else value


def trips(spark: SparkSession, *rows: dict) -> DataFrame:
    """One trip per dict; what a dict leaves out takes a default."""
    full = [{**DEFAULTS, **row} for row in rows]
    for row in full:
        row["pickup_ts"], row["dropoff_ts"] = _time(row["pickup_ts"]), _time(row["dropoff_ts"])
    return spark.createDataFrame([tuple(row[c] for c in DEFAULTS) for row in full], SCHEMA)


def zones(spark: SparkSession, *rows: tuple) -> DataFrame:
    return spark.createDataFrame(
        [(*row, "Zone", "Service")[:4] for row in rows],
        "LocationID int, Borough string, Zone string, service_zone string",
    )


def values(df: DataFrame, column: str) -> list:
    return [row[column] for row in df.collect()]


def rows(df: DataFrame) -> list[tuple]:
    return [tuple(row) for row in df.collect()]
