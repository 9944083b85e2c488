"""Joins, aggregations, ranking and union."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstats.functions import timestamps
from tripstats.model import GREEN, YELLOW
from tripstats.operators import aggregate, enrich, predicates, rank
from tripstats.registry import ctes
from tripstats.sources import sample


def _zoned(spark: SparkSession, sf_dir: str, pickup: bool = False, dropoff: bool = False):
    return sample.trips(spark, sf_dir, pickup, dropoff), sample.zones(spark, sf_dir)


def _pickup_counts(spark: SparkSession, sf_dir: str, by=("taxi_type",)) -> DataFrame:
    return enrich.count_per_borough(*_zoned(spark, sf_dir, pickup=True), "pickup", by)


def zone_pickup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.with_zone(*_zoned(spark, sf_dir, pickup=True), "pickup")


def zone_both(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.with_zones(*_zoned(spark, sf_dir, pickup=True, dropoff=True))


#: The borough that ``zone_unmatched`` takes out of the lookup.
WITHOUT_ZONES = "AFRICA"


def zone_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips against a lookup that lacks a borough: they stay, with NULL zones."""
    trips, zones = _zoned(spark, sf_dir, pickup=True, dropoff=True)
    return enrich.with_zones(trips, zones.filter(F.col("Borough") != WITHOUT_ZONES))


def _counts_of_both_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each count asks the trips for its own end only."""
    pickups = enrich.count_per_borough(
        *_zoned(spark, sf_dir, pickup=True), "pickup", label="Borough"
    )
    dropoffs = enrich.count_per_borough(
        *_zoned(spark, sf_dir, dropoff=True), "dropoff", label="Borough"
    )
    return enrich.combine_counts(
        pickups.withColumnRenamed("count", "Pickup_Count"),
        dropoffs.withColumnRenamed("count", "Dropoff_Count"),
        on=["taxi_type", "Borough"],
    )


def add_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = _counts_of_both_roles(spark, sf_dir)
    return both.withColumn("Count_Sum", F.col("Pickup_Count") + F.col("Dropoff_Count"))


def count_dropoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.count_per_borough(*_zoned(spark, sf_dir, dropoff=True), "dropoff")


def count_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = sample.table(spark, sf_dir, "events")
    day = timestamps.day(events, "ts").alias("day")
    return aggregate.count_by(events, day, "event_type")


def count_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate.count_by_month(sample.trips(spark, sf_dir), "pickup_ts", "taxi_type")


def global_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample.trips(spark, sf_dir).agg(F.count(F.lit(1)).alias("count"))


def global_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = F.round(F.sum("fare_amount"), 2)
    return sample.trips(spark, sf_dir).agg(total.alias("total_fare"))


def mean_fixed_divisor(spark: SparkSession, sf_dir: str) -> DataFrame:
    mean = aggregate.fixed_divisor_mean(F.count(F.lit(1)), 31)
    return sample.table(spark, sf_dir, "events").groupBy("event_type").agg(mean.alias("mean"))


def mean_all_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fares of the trips with an airport fee, over all trips and over those."""
    fare, with_fee = F.col("fare_amount"), F.col("airport_fee") > 0
    return (
        sample.trips(spark, sf_dir)
        .groupBy("taxi_type")
        .agg(
            F.round(aggregate.mean_over_all_rows(fare, with_fee), 6).alias("over_all"),
            F.round(aggregate.mean_over_valid_rows(fare, with_fee), 6).alias("over_valid"),
        )
    )


def share_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = sample.trips(spark, sf_dir)
    hit = predicates.is_value(trips, "passenger_count", "1.0")
    return trips.groupBy("taxi_type").agg(*aggregate.share_columns(hit, "total", "hits"))


def sort_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pickup_counts(spark, sf_dir).orderBy(
        F.desc("count"), "taxi_type", "Pickup_Borough"
    )


def sort_asc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pickup_counts(spark, sf_dir).orderBy("count", "taxi_type", "Pickup_Borough")


def top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank.top_k(_pickup_counts(spark, sf_dir, ()), 5, "count", ["Pickup_Borough"])


def top_k_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank.top_k_per_group(
        _pickup_counts(spark, sf_dir), 3, ["taxi_type"], "count", ["Pickup_Borough"]
    )


def limit_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank.top_k(count_by_month(spark, sf_dir), 1, "count", ["taxi_type", "month"])


def union_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By position: the columns of the left side name the result."""
    own = {
        fleet: sample.fleet_feed(spark, sf_dir, fleet).select(
            fleet.pickup_column, "fare_amount"
        )
        for fleet in (YELLOW, GREEN)
    }
    return own[YELLOW].union(own[GREEN])


QUERIES = {
    "join_zone_pickup": zone_pickup,
    "join_zone_both": zone_both,
    "join_zone_unmatched": zone_unmatched,
    "join_inner_counts": _counts_of_both_roles,
    "fn_add": add_counts,
    "agg_count_pickup": _pickup_counts,
    "agg_count_dropoff": count_dropoff,
    "agg_count_by_day": count_by_day,
    "agg_count_by_month": count_by_month,
    "agg_global_count": global_count,
    "agg_global_sum": global_sum,
    "agg_mean_fixed_divisor": mean_fixed_divisor,
    "agg_mean_all_rows": mean_all_rows,
    "agg_share_pct": share_pct,
    "sort_desc": sort_desc,
    "sort_asc": sort_asc,
    "topk": top_k,
    "topk_per_group": top_k_per_group,
    "limit_one": limit_one,
    "union_all": union_all,
}

_BOTH_ROLES = """
pickups AS (
  SELECT taxi_type, Pickup_Borough AS Borough, count(*) AS Pickup_Count
  FROM enriched GROUP BY ALL),
dropoffs AS (
  SELECT taxi_type, Dropoff_Borough AS Borough, count(*) AS Dropoff_Count
  FROM enriched GROUP BY ALL),
both_roles AS (
  SELECT p.taxi_type, p.Borough, Pickup_Count, Dropoff_Count
  FROM pickups p JOIN dropoffs d ON p.taxi_type = d.taxi_type AND p.Borough = d.Borough)"""
_PER_PICKUP = "SELECT taxi_type, Pickup_Borough, count(*) AS count FROM enriched GROUP BY ALL"

SQL = {
    "join_zone_pickup": ctes.zoned(
        f"""SELECT {ctes.TRIP_COLUMNS}, PULocationID, Pickup_Borough, Pickup_Zone,
          Pickup_service_zone FROM enriched"""
    ),
    "join_zone_both": ctes.zoned("SELECT * FROM enriched"),
    "join_zone_unmatched": ctes.zoned(
        f"""SELECT t.*, p.Borough AS Pickup_Borough, p.Zone AS Pickup_Zone,
          p.service_zone AS Pickup_service_zone, d.Borough AS Dropoff_Borough,
          d.Zone AS Dropoff_Zone, d.service_zone AS Dropoff_service_zone
        FROM trips t
        LEFT JOIN zones p ON t.PULocationID = p.LocationID AND p.Borough <> '{WITHOUT_ZONES}'
        LEFT JOIN zones d ON t.DOLocationID = d.LocationID AND d.Borough <> '{WITHOUT_ZONES}'"""
    ),
    "join_inner_counts": ctes.zoned_and(_BOTH_ROLES, "SELECT * FROM both_roles"),
    "fn_add": ctes.zoned_and(
        _BOTH_ROLES, "SELECT *, Pickup_Count + Dropoff_Count AS Count_Sum FROM both_roles"
    ),
    "agg_count_pickup": ctes.zoned(_PER_PICKUP),
    "agg_count_dropoff": ctes.zoned(
        "SELECT taxi_type, Dropoff_Borough, count(*) AS count FROM enriched GROUP BY ALL"
    ),
    "agg_count_by_day": """
        SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS count
        FROM events GROUP BY ALL""",
    "agg_count_by_month": ctes.trips(
        """SELECT taxi_type, strftime(pickup_ts, '%Y-%m') AS month, count(*) AS count
        FROM trips GROUP BY ALL"""
    ),
    "agg_global_count": ctes.trips("SELECT count(*) AS count FROM trips"),
    "agg_global_sum": ctes.trips("SELECT round(sum(fare_amount), 2) AS total_fare FROM trips"),
    "agg_mean_fixed_divisor": """
        SELECT event_type, count(*) / CAST(31 AS DOUBLE) AS mean
        FROM events GROUP BY event_type""",
    "agg_mean_all_rows": ctes.trips(
        """SELECT taxi_type,
          round(sum(fare_amount) FILTER (airport_fee > 0) / count(*), 6) AS over_all,
          round(sum(fare_amount) FILTER (airport_fee > 0)
                / count(*) FILTER (airport_fee > 0), 6) AS over_valid
        FROM trips GROUP BY taxi_type"""
    ),
    "agg_share_pct": ctes.trips(
        """SELECT taxi_type, count(*) AS total,
          count(*) FILTER (passenger_count = 1) AS hits,
          count(*) FILTER (passenger_count = 1) / CAST(count(*) AS DOUBLE) * 100 AS percentage
        FROM trips GROUP BY taxi_type"""
    ),
    "sort_desc": ctes.zoned(
        f"{_PER_PICKUP} ORDER BY count DESC, taxi_type, Pickup_Borough NULLS FIRST"
    ),
    "sort_asc": ctes.zoned(
        f"{_PER_PICKUP} ORDER BY count, taxi_type, Pickup_Borough NULLS FIRST"
    ),
    "topk": ctes.zoned(
        """SELECT Pickup_Borough, count(*) AS count FROM enriched GROUP BY ALL
        ORDER BY count DESC, Pickup_Borough NULLS FIRST LIMIT 5"""
    ),
    "topk_per_group": ctes.zoned(
        f"""SELECT * FROM ({_PER_PICKUP})
        QUALIFY row_number() OVER (
          PARTITION BY taxi_type ORDER BY count DESC, Pickup_Borough NULLS FIRST) <= 3"""
    ),
    "limit_one": ctes.trips(
        """SELECT taxi_type, strftime(pickup_ts, '%Y-%m') AS month, count(*) AS count
        FROM trips GROUP BY ALL ORDER BY count DESC, taxi_type, month LIMIT 1"""
    ),
    "union_all": ctes.trips(
        """SELECT pickup_ts AS tpep_pickup_datetime, fare_amount FROM trips
          WHERE taxi_type = 'yellow_taxi'
        UNION ALL
        SELECT pickup_ts, fare_amount FROM trips WHERE taxi_type = 'green_taxi'"""
    ),
}
