"""Sources and sinks: tables that Spark writes from the sample and reads back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstats.model import FLEETS, GREEN, YELLOW
from tripstats.operators import aggregate, enrich, predicates
from tripstats.plans import jobs
from tripstats.registry import ctes
from tripstats.sources import layout, readers, sample, sinks
from tripstats.sources.workspace import new_path

JULY = ("1996-07-01 00:00:00", "1996-08-01 00:00:00")


def _written(df: DataFrame, name: str, **how) -> str:
    path = new_path(df.sparkSession, name)
    sinks.write_csv(df, path, **how)
    return path


def _wall_clock(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in names})


def csv_infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One folder per fleet, written in one pass and read as a list of paths."""
    trips = sample.trips(spark, sf_dir).withColumn("fleet", F.col("taxi_type"))
    path = _written(trips, "infer", by=["fleet"])
    inferred = readers.read_csv_inferred(spark, [f"{path}/fleet={f.tag}" for f in FLEETS])
    return _wall_clock(inferred, "pickup_ts", "dropoff_ts")


def csv_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = {
        fleet: _written(
            sample.fleet_feed(spark, sf_dir, fleet, ids=True), f"schema-{fleet.name}"
        )
        for fleet in FLEETS
    }
    both = readers.read_trip_csv(spark, list(paths.values()))
    return _wall_clock(
        both,
        YELLOW.pickup_column,
        YELLOW.dropoff_column,
        GREEN.pickup_column,
        GREEN.dropoff_column,
    )


def month_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "trip-table")
    layout.write_trip_table(sample.trips(spark, sf_dir), path, "sample")
    return predicates.time_range(layout.read_trip_table(spark, path, *JULY), "pickup_ts", *JULY)


def zone_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _written(sample.zones(spark, sf_dir), "zones")
    trips = sample.trips(spark, sf_dir, pickup=True)
    zoned = enrich.with_zone(trips, readers.read_zones(spark, path), "pickup")
    return aggregate.count_by(zoned, "Pickup_Borough", "Pickup_Zone", "Pickup_service_zone")


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = sample.trips(spark, sf_dir, pickup=True, dropoff=True)
    enriched = jobs.enrich_trips(trips, sample.zones(spark, sf_dir))
    path = _written(enriched, "enriched")
    return spark.read.csv(path, header=True, schema=enriched.schema, enforceSchema=False)


def single_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = sample.trips(spark, sf_dir, pickup=True)
    counts = jobs.borough_counts(trips, sample.zones(spark, sf_dir), "pickup")
    path = _written(
        counts, "borough-counts", single_file=True, order=["taxi_type", "Pickup_Borough"]
    )
    table = spark.read.csv(path, header=True, schema=counts.schema, enforceSchema=False)
    files = table.agg(F.countDistinct("_metadata.file_path").alias("files"))
    return aggregate.attach(table, files, files="files")


QUERIES = {
    "src_csv_infer": csv_infer,
    "src_csv_schema": csv_schema,
    "src_month_pruned": month_pruned,
    "src_zone_lookup": zone_lookup,
    "sink_csv_roundtrip": csv_roundtrip,
    "sink_single_file": single_file,
}

_YELLOW_ONLY = "CASE WHEN taxi_type = 'yellow_taxi' THEN {} END"
_GREEN_ONLY = "CASE WHEN taxi_type = 'green_taxi' THEN {} END"

SQL = {
    "src_csv_infer": ctes.trips(f"SELECT {ctes.TRIP_COLUMNS} FROM trips"),
    "src_csv_schema": ctes.trips(
        f"""SELECT taxi_type, trip_distance, fare_amount, passenger_count,
          {ctes.id_as_text('PULocationID')} AS PULocationID,
          {ctes.id_as_text('DOLocationID')} AS DOLocationID,
          {_YELLOW_ONLY.format('airport_fee')} AS airport_fee,
          {_YELLOW_ONLY.format('pickup_ts')} AS tpep_pickup_datetime,
          {_YELLOW_ONLY.format('dropoff_ts')} AS tpep_dropoff_datetime,
          {_GREEN_ONLY.format('pickup_ts')} AS lpep_pickup_datetime,
          {_GREEN_ONLY.format('dropoff_ts')} AS lpep_dropoff_datetime
        FROM trips"""
    ),
    "src_month_pruned": ctes.trips(
        f"""SELECT {ctes.TRIP_COLUMNS}, strftime(pickup_ts, '%Y-%m') AS pickup_month
        FROM trips WHERE pickup_ts >= TIMESTAMP '{JULY[0]}' AND pickup_ts < TIMESTAMP '{JULY[1]}'"""
    ),
    "src_zone_lookup": ctes.zoned(
        """SELECT Pickup_Borough, Pickup_Zone, Pickup_service_zone, count(*) AS count
        FROM enriched GROUP BY ALL"""
    ),
    "sink_csv_roundtrip": ctes.zoned("SELECT * FROM enriched"),
    "sink_single_file": ctes.zoned(
        """SELECT taxi_type, Pickup_Borough, count(*) AS count, CAST(1 AS BIGINT) AS files
        FROM enriched GROUP BY taxi_type, Pickup_Borough"""
    ),
}
