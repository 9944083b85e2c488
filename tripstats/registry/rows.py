"""Row-level operators: projections, filters, scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstats.functions import timestamps
from tripstats.functions.labels import listed_with_fleet_suffix
from tripstats.model import COMPAT, GREEN, TS_FORMAT, YELLOW
from tripstats.operators import aggregate, enrich, predicates
from tripstats.operators.cleanse import all_text, cleanse
from tripstats.registry import ctes
from tripstats.sources import readers, sample

RANGE = ("2024-01-05 00:00:00", "2024-01-12 23:59:59")
MID_MONTH = "2024-01-15 12:00:00"
LISTED = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")


def cast_all_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    return all_text(sample.trips(spark, sf_dir))


def select(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample.trips(spark, sf_dir).select("fare_amount", "trip_distance", "pickup_ts")


def rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = sample.trips(spark, sf_dir, pickup=True)
    counts = enrich.count_per_borough(trips, sample.zones(spark, sf_dir), "pickup")
    return counts.withColumnsRenamed({"Pickup_Borough": "Borough", "count": "Pickup_Count"})


def drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample.trips(spark, sf_dir).drop("pickup_ts", "dropoff_ts", "passenger_count")


def attach_scalar(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = sample.trips(spark, sf_dir).select("taxi_type", "fare_amount")
    total = trips.agg(F.count(F.lit(1)).alias("n"), F.max("fare_amount").alias("top"))
    return aggregate.attach(trips, total, trip_count="n", highest_fare="top")


def normalise_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.unite_fleets(
        sample.fleet_feed(spark, sf_dir, YELLOW, ids=True),
        sample.fleet_feed(spark, sf_dir, GREEN, ids=True),
    )


def ts_parsable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predicates.parsable(sample.feed(spark, sf_dir))


def non_negative(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predicates.non_negative(sample.feed(spark, sf_dir))


def non_negative_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balances scaled so that small negatives and exponents both occur."""
    customers = sample.table(spark, sf_dir, "customer").select(
        "c_custkey",
        (F.col("c_acctbal") / 1000.0).alias("trip_distance"),
        (F.abs("c_acctbal") * 1500.0).alias("fare_amount"),
    )
    return predicates.non_negative(customers, mode=COMPAT)


def ts_range_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = sample.table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    return predicates.time_range(events, "ts", *RANGE, closed="neither")


def threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = predicates.above(sample.trips(spark, sf_dir), "fare_amount", "40000")
    return predicates.below(trips, "trip_distance", "30")


def threshold_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = predicates.above(sample.trips(spark, sf_dir), "fare_amount", "50", COMPAT)
    return predicates.below(trips, "trip_distance", "3", COMPAT)


def equals_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = sample.trips(spark, sf_dir)
    return trips.filter(predicates.is_value(trips, "passenger_count", "1.0", COMPAT))


def positive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predicates.above(sample.trips(spark, sf_dir), "airport_fee", "0.0")


def taxi_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predicates.of_fleet(sample.trips(spark, sf_dir), GREEN.tag)


def cleanse_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleanse(sample.feed(spark, sf_dir))


def cleanse_trips_basic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleanse(sample.feed(spark, sf_dir), non_negative=False)


def cleanse_trips_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleanse(sample.feed(spark, sf_dir), mode=COMPAT)


def _event_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample.table(spark, sf_dir, "events").select(
        "event_id", F.date_format("ts", TS_FORMAT).alias("ts_text")
    )


def unix_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _event_text(spark, sf_dir)
    seconds = timestamps.unix_seconds(events, "ts_text")
    return events.select(
        "event_id",
        seconds.alias("seconds"),
        F.timestamp_seconds(seconds).cast("timestamp_ntz").alias("back"),
    )


def to_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = sample.table(spark, sf_dir, "events").select("event_id", "ts")
    return events.withColumn("ts", timestamps.day(events, "ts"))


def date_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = sample.trips(spark, sf_dir)
    return trips.select("taxi_type", timestamps.month(trips, "pickup_ts").alias("month"))


def interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = sample.trips(spark, sf_dir)
    elapsed = timestamps.elapsed(trips, "pickup_ts", "dropoff_ts")
    return trips.select(
        "pickup_ts",
        "dropoff_ts",
        timestamps.interval_seconds(elapsed).alias("duration_seconds"),
    )


def interval_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _event_text(spark, sf_dir).withColumn("until", F.lit(MID_MONTH))
    elapsed = timestamps.elapsed(events, "ts_text", "until")
    return events.select("event_id", timestamps.interval_text(elapsed).alias("duration"))


def round_half_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = sample.trips(spark, sf_dir).select("taxi_type", "fare_amount")
    return trips.select("*", F.round("fare_amount").alias("rounded"))


def fare_per_mile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The denominator is the airport fee here, which is zero for many trips."""
    trips = sample.trips(spark, sf_dir).select("fare_amount", "trip_distance", "airport_fee")
    return trips.withColumns(
        {
            "fare_per_mile": F.try_divide("fare_amount", "trip_distance"),
            "fare_per_fee": F.try_divide("fare_amount", "airport_fee"),
        }
    )


def regexp_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = sample.trips(spark, sf_dir, pickup=True)
    counts = enrich.count_per_borough(trips, sample.zones(spark, sf_dir), "pickup")
    label = listed_with_fleet_suffix(F.col("Pickup_Borough"), F.col("taxi_type"), LISTED)
    return counts.select(label.alias("Pickup_Borough"), "count")


QUERIES = {
    "prj_cast_all_string": cast_all_string,
    "prj_select": select,
    "prj_rename": rename,
    "prj_drop": drop,
    "prj_attach_scalar": attach_scalar,
    "prj_normalise_trips": normalise_trips,
    "flt_ts_parsable": ts_parsable,
    "flt_non_negative": non_negative,
    "flt_non_negative_compat": non_negative_compat,
    "flt_ts_range_open": ts_range_open,
    "flt_threshold": threshold,
    "flt_threshold_lexical": threshold_lexical,
    "flt_equals_text": equals_text,
    "flt_positive": positive,
    "flt_taxi_type": taxi_type,
    "cleanse_trips": cleanse_trips,
    "cleanse_trips_basic": cleanse_trips_basic,
    "cleanse_trips_compat": cleanse_trips_compat,
    "fn_unix_timestamp": unix_timestamp,
    "fn_to_date": to_date,
    "fn_date_format": date_format,
    "fn_interval": interval,
    "fn_interval_text": interval_text,
    "fn_round": round_half_up,
    "fn_fare_per_mile": fare_per_mile,
    "fn_regexp_label": regexp_label,
}

_ALL_TEXT = ", ".join(
    f"CAST({name} AS VARCHAR) AS {name}" for name in ctes.TRIP_COLUMNS.split(", ")
)
_READABLE = "dropoff_ts <> 'not recorded'"
_PER_PICKUP = "SELECT taxi_type, Pickup_Borough, count(*) AS count FROM enriched GROUP BY ALL"

SQL = {
    "prj_cast_all_string": ctes.trips(f"SELECT {_ALL_TEXT} FROM trips"),
    "prj_select": ctes.trips("SELECT fare_amount, trip_distance, pickup_ts FROM trips"),
    "prj_rename": ctes.zoned(
        """SELECT taxi_type, Pickup_Borough AS Borough, count(*) AS Pickup_Count
        FROM enriched GROUP BY taxi_type, Pickup_Borough"""
    ),
    "prj_drop": ctes.trips(
        "SELECT taxi_type, trip_distance, fare_amount, airport_fee FROM trips"
    ),
    "prj_attach_scalar": ctes.trips(
        """SELECT taxi_type, fare_amount, (SELECT count(*) FROM trips) AS trip_count,
          (SELECT max(fare_amount) FROM trips) AS highest_fare FROM trips"""
    ),
    "prj_normalise_trips": ctes.trips(
        """SELECT taxi_type, pickup_ts, dropoff_ts, PULocationID, DOLocationID,
          trip_distance, fare_amount, passenger_count,
          CASE WHEN taxi_type = 'yellow_taxi' THEN airport_fee END AS airport_fee
        FROM trips"""
    ),
    "flt_ts_parsable": ctes.feed(f"SELECT * FROM feed WHERE {_READABLE}"),
    "flt_non_negative": ctes.feed(
        "SELECT * FROM feed WHERE trip_distance >= 0 AND fare_amount >= 0"
    ),
    "flt_non_negative_compat": f"""
        WITH scaled AS (
          SELECT c_custkey, c_acctbal / CAST(1000 AS DOUBLE) AS trip_distance,
                 abs(c_acctbal) * CAST(1500 AS DOUBLE) AS fare_amount
          FROM customer)
        SELECT * FROM scaled
        WHERE {ctes.PLAIN.format('trip_distance')} AND {ctes.PLAIN.format('fare_amount')}""",
    "flt_ts_range_open": f"""
        SELECT event_id, ts, event_type FROM events
        WHERE ts > TIMESTAMP '{RANGE[0]}' AND ts < TIMESTAMP '{RANGE[1]}'""",
    "flt_threshold": ctes.trips(
        f"SELECT {ctes.TRIP_COLUMNS} FROM trips WHERE fare_amount > 40000 AND trip_distance < 30"
    ),
    "flt_threshold_lexical": ctes.trips(
        f"""SELECT {ctes.TRIP_COLUMNS} FROM trips
        WHERE CAST(fare_amount AS VARCHAR) > '50' AND CAST(trip_distance AS VARCHAR) < '3'"""
    ),
    "flt_equals_text": ctes.trips(
        f"""SELECT {ctes.TRIP_COLUMNS} FROM trips
        WHERE CAST(passenger_count AS VARCHAR) = '1.0'"""
    ),
    "flt_positive": ctes.trips(f"SELECT {ctes.TRIP_COLUMNS} FROM trips WHERE airport_fee > 0"),
    "flt_taxi_type": ctes.trips(
        f"SELECT {ctes.TRIP_COLUMNS} FROM trips WHERE taxi_type = 'green_taxi'"
    ),
    "cleanse_trips": ctes.feed(
        f"SELECT * FROM feed WHERE {_READABLE} AND trip_distance >= 0 AND fare_amount >= 0"
    ),
    "cleanse_trips_basic": ctes.feed(f"SELECT * FROM feed WHERE {_READABLE}"),
    "cleanse_trips_compat": ctes.feed(
        f"""SELECT {_ALL_TEXT} FROM feed
        WHERE {_READABLE} AND {ctes.PLAIN.format('trip_distance')}
          AND {ctes.PLAIN.format('fare_amount')}"""
    ),
    "fn_unix_timestamp": """
        SELECT event_id, CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS seconds,
               date_trunc('second', ts) AS back
        FROM events""",
    "fn_to_date": "SELECT event_id, CAST(ts AS DATE) AS ts FROM events",
    "fn_date_format": ctes.trips(
        "SELECT taxi_type, strftime(pickup_ts, '%Y-%m') AS month FROM trips"
    ),
    "fn_interval": ctes.trips(
        """SELECT pickup_ts, dropoff_ts,
          CAST(date_diff('second', pickup_ts, dropoff_ts) AS BIGINT) AS duration_seconds
        FROM trips"""
    ),
    "fn_interval_text": f"""
        WITH gaps AS (
          SELECT event_id,
                 date_diff('second', date_trunc('second', ts), TIMESTAMP '{MID_MONTH}') AS s
          FROM events)
        SELECT event_id,
               'INTERVAL ''' || CASE WHEN s < 0 THEN '-' ELSE '' END
               || CAST(abs(s) // 86400 AS VARCHAR) || ' '
               || lpad(CAST(abs(s) % 86400 // 3600 AS VARCHAR), 2, '0') || ':'
               || lpad(CAST(abs(s) % 3600 // 60 AS VARCHAR), 2, '0') || ':'
               || lpad(CAST(abs(s) % 60 AS VARCHAR), 2, '0')
               || ''' DAY TO SECOND' AS duration
        FROM gaps""",
    "fn_round": ctes.trips(
        "SELECT taxi_type, fare_amount, round(fare_amount) AS rounded FROM trips"
    ),
    "fn_fare_per_mile": ctes.trips(
        """SELECT fare_amount, trip_distance, airport_fee,
          CASE WHEN trip_distance <> 0 THEN fare_amount / trip_distance END AS fare_per_mile,
          CASE WHEN airport_fee <> 0 THEN fare_amount / airport_fee END AS fare_per_fee
        FROM trips"""
    ),
    "fn_regexp_label": ctes.zoned(
        f"""SELECT CASE WHEN Pickup_Borough IN {LISTED}
              THEN Pickup_Borough
                   || CASE taxi_type WHEN 'yellow_taxi' THEN '_Yellow' ELSE '_Green' END
              ELSE Pickup_Borough END AS Pickup_Borough, count
        FROM ({_PER_PICKUP})"""
    ),
}
