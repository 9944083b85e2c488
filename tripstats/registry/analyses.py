"""The end-to-end jobs over the sample views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstats.model import COMPAT, GREEN, YELLOW
from tripstats.plans import jobs
from tripstats.registry import ctes
from tripstats.sources import sample

WEEK = ("1996-07-01 00:00:00", "1996-07-07 23:59:59")
JULY = ("1996-07-01 00:00:00", "1996-07-31 23:59:59")
YEAR = ("1996-01-01 00:00:00", "1997-01-01 00:00:00")
LISTED = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
MONTHS = range(1, 13)
TYPED_BOUNDS = {"min_fare": "50000", "max_distance": "10"}
TEXT_BOUNDS = {"min_fare": "50", "max_distance": "3"}


def _zoned(spark: SparkSession, sf_dir: str, pickup: bool = True, dropoff: bool = True):
    return sample.metered(spark, sf_dir, pickup, dropoff), sample.zones(spark, sf_dir)


def enrich_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.enrich_trips(*_zoned(spark, sf_dir))


def borough_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.borough_counts(*_zoned(spark, sf_dir))


def borough_counts_yellow_pickup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.borough_counts(*_zoned(spark, sf_dir, dropoff=False), "pickup", YELLOW)


def borough_counts_green_dropoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.borough_counts(*_zoned(spark, sf_dir, pickup=False), "dropoff", GREEN)


def filtered_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.filtered_by_day(sample.metered(spark, sf_dir), JULY, **TYPED_BOUNDS)


def filtered_by_day_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.filtered_by_day(
        sample.metered(spark, sf_dir), JULY, mode=COMPAT, **TEXT_BOUNDS
    )


def filtered_by_day_yellow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.filtered_by_day(
        sample.metered(spark, sf_dir), WEEK, fleet=YELLOW, mode=COMPAT, **TEXT_BOUNDS
    )


def topk_combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.top_boroughs_combined(*_zoned(spark, sf_dir), k=3)


def topk_combined_yellow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.top_boroughs_combined(*_zoned(spark, sf_dir), k=3, fleet=YELLOW)


def daily_with_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.daily_with_mean(sample.metered(spark, sf_dir), JULY, fleet=YELLOW)


def fare_per_mile(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = jobs.fare_per_mile(sample.metered(spark, sf_dir), JULY, fleet=YELLOW)
    return rows.withColumn("avg_fpm", F.round("avg_fpm", 6))


def share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.share(sample.metered(spark, sf_dir))


def share_yellow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.share(sample.metered(spark, sf_dir), fleet=YELLOW)


def share_green_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.share(sample.metered(spark, sf_dir), fleet=GREEN, mode=COMPAT)


def durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = sample.metered(spark, sf_dir)
    return jobs.durations(trips, JULY, fleet=YELLOW, with_seconds=True)


def daily_with_mean_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fleet with a mean of its own, days without trips listed."""
    return jobs.daily_with_mean(sample.metered(spark, sf_dir), JULY, every_day=True)


def fare_per_mile_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = jobs.fare_per_mile(sample.metered(spark, sf_dir), JULY)
    return rows.withColumn("avg_fpm", F.round("avg_fpm", 6))


def durations_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.durations(sample.metered(spark, sf_dir), JULY, with_seconds=True)


def top_boroughs_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.top_boroughs_merged(*_zoned(spark, sf_dir, dropoff=False))


def top_boroughs_merged_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips, zones = _zoned(spark, sf_dir, dropoff=False)
    return jobs.top_boroughs_merged(trips, zones, listed=LISTED, mode=COMPAT)


def busiest_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.busiest_month(sample.metered(spark, sf_dir), YEAR)


def busiest_month_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All months of a year named."""
    return jobs.busiest_month(sample.metered(spark, sf_dir), YEAR, 1996)


def busiest_month_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.busiest_month(sample.metered(spark, sf_dir), YEAR, 1996, MONTHS, COMPAT)


def anomaly_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of every fleet that stray from its mean, days without trips included."""
    return jobs.anomaly_bands(daily_with_mean_all(spark, sf_dir))


def share_complement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.share_with_complement(share(spark, sf_dir))


QUERIES = {
    "job_enrich_trips": enrich_trips,
    "job_borough_counts": borough_counts,
    "job_borough_counts_yellow_pickup": borough_counts_yellow_pickup,
    "job_borough_counts_green_dropoff": borough_counts_green_dropoff,
    "job_filtered_by_day": filtered_by_day,
    "job_filtered_by_day_lexical": filtered_by_day_lexical,
    "job_filtered_by_day_yellow": filtered_by_day_yellow,
    "job_topk_combined": topk_combined,
    "job_topk_combined_yellow": topk_combined_yellow,
    "job_daily_with_mean": daily_with_mean,
    "job_daily_with_mean_all": daily_with_mean_all,
    "job_fare_per_mile": fare_per_mile,
    "job_fare_per_mile_all": fare_per_mile_all,
    "job_share": share,
    "job_share_yellow": share_yellow,
    "job_share_green_compat": share_green_compat,
    "job_durations": durations,
    "job_durations_all": durations_all,
    "job_top_boroughs_merged": top_boroughs_merged,
    "job_top_boroughs_merged_compat": top_boroughs_merged_compat,
    "job_busiest_month": busiest_month,
    "job_busiest_month_named": busiest_month_named,
    "job_busiest_month_compat": busiest_month_compat,
    "job_anomaly_bands": anomaly_bands,
    "job_share_complement": share_complement,
}


def _within(period: tuple[str, str]) -> str:
    return f"pickup_ts > TIMESTAMP '{period[0]}' AND pickup_ts < TIMESTAMP '{period[1]}'"


_DAYS_OF_JULY = (
    f"generate_series(DATE '{JULY[0][:10]}', DATE '{JULY[1][:10]}', INTERVAL 1 DAY)"
)
_JULY_DIVISOR = f"CAST(len({_DAYS_OF_JULY}) AS DOUBLE)"
_CLEAN = (
    "pickup_ts IS NOT NULL AND dropoff_ts IS NOT NULL "
    "AND trip_distance >= 0 AND fare_amount >= 0"
)
_CLEAN_COMPAT = (
    "pickup_ts IS NOT NULL AND dropoff_ts IS NOT NULL "
    f"AND {ctes.PLAIN.format('trip_distance')} AND {ctes.PLAIN.format('fare_amount')}"
)
_TEXT_FILTER = "CAST(fare_amount AS VARCHAR) > '50' AND CAST(trip_distance AS VARCHAR) < '3'"
_YELLOW = "taxi_type = 'yellow_taxi'"
_COLOUR = "CASE taxi_type WHEN 'yellow_taxi' THEN 'Yellow' ELSE 'Green' END"
_SINGLES = "count(*) FILTER (passenger_count = 1)"
_PERCENT = f"{_SINGLES} / CAST(count(*) AS DOUBLE) * 100"

_ROLES = f"""
roles AS (
  SELECT taxi_type, 'pickup' AS role, Pickup_Borough AS Borough, count(*) AS count
  FROM enriched WHERE {_CLEAN} GROUP BY ALL
  UNION ALL
  SELECT taxi_type, 'dropoff', Dropoff_Borough, count(*)
  FROM enriched WHERE {_CLEAN} GROUP BY ALL),
combined AS (
  SELECT p.taxi_type, p.Borough, p.count AS Pickup_Count, d.count AS Dropoff_Count,
         p.count + d.count AS Count_Sum
  FROM roles p JOIN roles d
    ON p.taxi_type = d.taxi_type AND p.Borough = d.Borough
   AND p.role = 'pickup' AND d.role = 'dropoff')"""

_DURATION_TEXT = """'INTERVAL ''' || CASE WHEN s < 0 THEN '-' ELSE '' END
  || CAST(abs(s) // 86400 AS VARCHAR) || ' '
  || lpad(CAST(abs(s) % 86400 // 3600 AS VARCHAR), 2, '0') || ':'
  || lpad(CAST(abs(s) % 3600 // 60 AS VARCHAR), 2, '0') || ':'
  || lpad(CAST(abs(s) % 60 AS VARCHAR), 2, '0') || ''' DAY TO SECOND'"""



def _merged_sql(clean: str) -> str:
    return f"""SELECT Pickup_Borough || '_' || {_COLOUR} AS Pickup_Borough, count
        FROM (SELECT taxi_type, Pickup_Borough, count(*) AS count
              FROM enriched WHERE {clean} GROUP BY taxi_type, Pickup_Borough
              QUALIFY row_number() OVER (
                PARTITION BY taxi_type ORDER BY count(*) DESC, Pickup_Borough NULLS FIRST) <= 5)
        ORDER BY count, Pickup_Borough"""


def _busiest_sql(clean: str, label: str) -> str:
    return f"""SELECT {label} AS month, count
        FROM (SELECT taxi_type, date_trunc('month', pickup_ts) AS first, count(*) AS count
              FROM trips WHERE {clean} AND pickup_ts >= TIMESTAMP '{YEAR[0]}'
                AND pickup_ts < TIMESTAMP '{YEAR[1]}'
              GROUP BY taxi_type, date_trunc('month', pickup_ts)
              QUALIFY row_number() OVER (
                PARTITION BY taxi_type
                ORDER BY count(*) DESC, date_trunc('month', pickup_ts)) = 1)"""


_DAILY_SQL = f"""SELECT taxi_type, day, coalesce(n, 0) AS count, total, round(total) AS mean
        FROM (SELECT taxi_type, day, n,
                CAST(sum(n) OVER (PARTITION BY taxi_type) AS DOUBLE) / {_JULY_DIVISOR} AS total
              FROM (SELECT DISTINCT taxi_type FROM trips)
              CROSS JOIN (SELECT CAST(unnest({_DAYS_OF_JULY}) AS DATE) AS day)
              LEFT JOIN (SELECT taxi_type, CAST(pickup_ts AS DATE) AS day, count(*) AS n
                         FROM trips WHERE {_CLEAN} AND {_within(JULY)} AND airport_fee > 0
                         GROUP BY ALL) USING (taxi_type, day))"""

SQL = {
    "job_enrich_trips": ctes.metered_zoned(
        "SELECT * FROM enriched WHERE pickup_ts IS NOT NULL AND dropoff_ts IS NOT NULL"
    ),
    "job_borough_counts": ctes.metered_zoned_and(_ROLES, "SELECT * FROM roles"),
    "job_borough_counts_yellow_pickup": ctes.metered_zoned(
        f"""SELECT Pickup_Borough, count(*) AS count
        FROM enriched WHERE {_CLEAN} AND {_YELLOW} GROUP BY ALL"""
    ),
    "job_borough_counts_green_dropoff": ctes.metered_zoned(
        f"""SELECT Dropoff_Borough, count(*) AS count
        FROM enriched WHERE {_CLEAN} AND taxi_type = 'green_taxi' GROUP BY ALL"""
    ),
    "job_filtered_by_day": ctes.metered(
        f"""SELECT taxi_type, CAST(pickup_ts AS DATE) AS day, count(*) AS count
        FROM trips WHERE {_CLEAN} AND {_within(JULY)}
          AND fare_amount > 50000 AND trip_distance < 10 GROUP BY ALL"""
    ),
    "job_filtered_by_day_lexical": ctes.metered(
        f"""SELECT taxi_type, CAST(pickup_ts AS DATE) AS day, count(*) AS count
        FROM trips WHERE {_CLEAN_COMPAT} AND {_within(JULY)} AND {_TEXT_FILTER} GROUP BY ALL"""
    ),
    "job_filtered_by_day_yellow": ctes.metered(
        f"""SELECT CAST(pickup_ts AS DATE) AS tpep_pickup_datetime, count(*) AS count
        FROM trips WHERE {_CLEAN_COMPAT} AND {_YELLOW} AND {_within(WEEK)} AND {_TEXT_FILTER}
        GROUP BY ALL"""
    ),
    "job_topk_combined": ctes.metered_zoned_and(
        _ROLES,
        """SELECT * FROM combined QUALIFY row_number() OVER (
          PARTITION BY taxi_type ORDER BY Count_Sum DESC, Borough) <= 3""",
    ),
    "job_topk_combined_yellow": ctes.metered_zoned_and(
        _ROLES,
        f"""SELECT Borough, Pickup_Count AS YPickup_Count, Dropoff_Count AS YDropoff_Count,
          Count_Sum FROM combined WHERE {_YELLOW}
        ORDER BY Count_Sum DESC, Borough LIMIT 3""",
    ),
    "job_daily_with_mean": ctes.metered(
        f"""SELECT *, round(total) AS mean FROM (
          SELECT CAST(pickup_ts AS DATE) AS tpep_pickup_datetime, count(*) AS count,
                 CAST(sum(count(*)) OVER () AS DOUBLE) / {_JULY_DIVISOR} AS total
          FROM trips WHERE {_CLEAN} AND {_YELLOW} AND {_within(JULY)} AND airport_fee > 0
          GROUP BY CAST(pickup_ts AS DATE))
        ORDER BY tpep_pickup_datetime"""
    ),
    "job_daily_with_mean_all": ctes.metered(f"{_DAILY_SQL} ORDER BY taxi_type, day"),
    "job_fare_per_mile_all": ctes.metered(
        f"""SELECT taxi_type, fare_per_mile, n AS "len(fare_per_mile)",
          round(sum(fare_per_mile) OVER (PARTITION BY taxi_type) / n, 6) AS avg_fpm
        FROM (SELECT taxi_type, trip_distance,
                CASE WHEN trip_distance <> 0 THEN fare_amount / trip_distance END AS fare_per_mile,
                count(*) OVER (PARTITION BY taxi_type) AS n
              FROM trips WHERE {_CLEAN} AND {_within(JULY)})
        WHERE trip_distance > 0"""
    ),
    "job_durations_all": ctes.metered(
        f"""SELECT taxi_type, fare_amount, {_DURATION_TEXT} AS duration,
          CAST(s AS BIGINT) AS duration_seconds
        FROM (SELECT taxi_type, fare_amount, date_diff('second', pickup_ts, dropoff_ts) AS s
              FROM trips WHERE pickup_ts IS NOT NULL AND dropoff_ts IS NOT NULL
                AND {_within(JULY)})"""
    ),
    "job_fare_per_mile": ctes.metered(
        f"""SELECT fare_per_mile, n AS "len(fare_per_mile)",
          round(sum(fare_per_mile) OVER () / n, 6) AS avg_fpm
        FROM (SELECT trip_distance,
                CASE WHEN trip_distance <> 0 THEN fare_amount / trip_distance END AS fare_per_mile,
                count(*) OVER () AS n
              FROM trips WHERE {_CLEAN} AND {_YELLOW} AND {_within(JULY)})
        WHERE trip_distance > 0"""
    ),
    "job_share": ctes.metered(
        f"""SELECT taxi_type, count(*) AS total, {_SINGLES} AS single_total,
          {_PERCENT} AS percentage FROM trips WHERE {_CLEAN} GROUP BY taxi_type"""
    ),
    "job_share_yellow": ctes.metered(
        f"""SELECT count(*) AS yellow_total, {_SINGLES} AS yellow_single_total,
          {_PERCENT} AS percentage FROM trips WHERE {_CLEAN} AND {_YELLOW}"""
    ),
    "job_share_green_compat": ctes.metered(
        f"""SELECT count(*) AS green_total, {_SINGLES} AS green_single_total,
          {_PERCENT} AS percentage FROM trips WHERE {_CLEAN_COMPAT} AND taxi_type = 'green_taxi'"""
    ),
    "job_durations": ctes.metered(
        f"""SELECT fare_amount, {_DURATION_TEXT} AS duration,
          CAST(s AS BIGINT) AS duration_seconds
        FROM (SELECT fare_amount, date_diff('second', pickup_ts, dropoff_ts) AS s FROM trips
              WHERE pickup_ts IS NOT NULL AND dropoff_ts IS NOT NULL
                AND {_YELLOW} AND {_within(JULY)})"""
    ),
    "job_top_boroughs_merged": ctes.metered_zoned(_merged_sql(_CLEAN)),
    "job_top_boroughs_merged_compat": ctes.metered_zoned(_merged_sql(_CLEAN_COMPAT)),
    "job_busiest_month": ctes.metered(
        _busiest_sql(_CLEAN, f"strftime(first, '%Y-%m') || ' (' || {_COLOUR} || ')'")
    ),
    "job_busiest_month_named": ctes.metered(
        _busiest_sql(_CLEAN, f"strftime(first, '%B') || ' (' || {_COLOUR} || ')'")
    ),
    "job_busiest_month_compat": ctes.metered(
        _busiest_sql(_CLEAN_COMPAT, f"strftime(first, '%B') || ' (' || {_COLOUR} || ')'")
    ),
    "job_anomaly_bands": ctes.metered(
        f"""SELECT *, total * CAST(0.8 AS DOUBLE) AS low_band,
               total * CAST(1.2 AS DOUBLE) AS high_band,
               CASE WHEN count < total * CAST(0.8 AS DOUBLE) THEN 'low'
                    WHEN count > total * CAST(1.2 AS DOUBLE) THEN 'high'
                    ELSE 'normal' END AS flag
        FROM ({_DAILY_SQL}) ORDER BY taxi_type, day"""
    ),
    "job_share_complement": ctes.metered(
        f"""SELECT taxi_type, count(*) AS total, {_SINGLES} AS single_total,
          {_PERCENT} AS percentage, CAST(100 AS DOUBLE) - {_PERCENT} AS other_percentage
        FROM trips WHERE {_CLEAN} GROUP BY taxi_type"""
    ),
}
