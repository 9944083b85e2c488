"""Laws that must hold on any trips: eager counting, sums, skew, top-k."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from frames import rows, zones
from tripstats.model import COMPAT, YELLOW
from tripstats.operators import aggregate, enrich, rank
from tripstats.operators.cleanse import all_text
from tripstats.plans import jobs

N = 20_000


def random_trips(spark, seed, hot_share=0.4):
    """Trips of which a large share starts and ends at one location."""

    def location(offset):
        spread = F.floor(F.rand(seed + offset) * 12).cast("int")
        hot = F.when(F.rand(seed + offset + 50) < hot_share, F.lit(3)).otherwise(spread)
        return F.when(F.rand(seed + offset + 90) < 0.05, F.lit(None)).otherwise(hot)

    start = F.lit("2023-01-01 00:00:00").cast("timestamp")
    pickup = start + F.make_dt_interval(secs=F.floor(F.rand(seed) * 86400 * 200))
    df = spark.range(N).select(
        F.when(F.rand(seed + 1) < 0.8, "yellow_taxi").otherwise("green_taxi").alias("taxi_type"),
        pickup.alias("pickup_ts"),
        (pickup + F.make_dt_interval(secs=F.floor(F.rand(seed + 2) * 4000))).alias("dropoff_ts"),
        location(10).alias("PULocationID"),
        location(20).alias("DOLocationID"),
        F.round(F.rand(seed + 3) * 20 - 1, 2).alias("trip_distance"),
        F.round(F.rand(seed + 4) * 200 - 5, 2).alias("fare_amount"),
        F.floor(F.rand(seed + 5) * 4).cast("double").alias("passenger_count"),
        F.floor(F.rand(seed + 6) * 2).cast("double").alias("airport_fee"),
    )
    return df


# Location 5 is listed twice, 8 and up not at all.
ZONES = [(0, "A"), (1, "A"), (2, "B"), (3, "C"), (4, "B"), (5, "A"), (5, "D"), (6, None), (7, "D")]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_counting_first_equals_joining_first(spark, seed):
    trips, zone_table = random_trips(spark, seed), zones(spark, *ZONES)
    for role, label in (("pickup", "Pickup_Borough"), ("dropoff", "Dropoff_Borough")):
        eager = enrich.count_per_borough(trips, zone_table, role)
        joined = enrich.with_zone(trips, zone_table, role)
        late = aggregate.count_by(joined, "taxi_type", label)
        assert Counter(rows(eager)) == Counter(rows(late))


@pytest.mark.parametrize("seed", [4, 5])
def test_both_roles_in_one_pass_equal_one_pass_each(spark, seed):
    trips, zone_table = random_trips(spark, seed), zones(spark, *ZONES)
    both = enrich.count_per_role_and_borough(trips, zone_table)
    for role in ("pickup", "dropoff"):
        one = enrich.count_per_borough(trips, zone_table, role, label="Borough")
        assert Counter(rows(both.filter(F.col("role") == role).drop("role"))) == Counter(rows(one))


def test_groups_add_up_to_all_rows(spark):
    trips = random_trips(spark, 6)
    unique = zones(spark, *[z for z in ZONES if z != (5, "D")])
    counts = enrich.count_per_role_and_borough(trips, unique, ())
    sums = dict(rows(counts.groupBy("role").agg(F.sum("count"))))
    assert sums == {"pickup": N, "dropoff": N}


def test_grouped_combination_equals_the_join(spark):
    trips, zone_table = random_trips(spark, 7), zones(spark, *ZONES)
    clean = trips.filter("trip_distance >= 0 AND fare_amount >= 0")
    pickups = enrich.count_per_borough(clean, zone_table, "pickup", label="Borough")
    dropoffs = enrich.count_per_borough(clean, zone_table, "dropoff", label="Borough")
    joined = enrich.combine_counts(
        pickups.withColumnRenamed("count", "Pickup_Count"),
        dropoffs.withColumnRenamed("count", "Dropoff_Count"),
        on=["taxi_type", "Borough"],
    ).withColumn("Count_Sum", F.col("Pickup_Count") + F.col("Dropoff_Count"))
    everything = jobs.top_boroughs_combined(trips, zone_table, k=100)
    assert Counter(rows(everything)) == Counter(rows(joined))


def test_top_k_is_the_head_of_the_whole(spark):
    counts = enrich.count_per_borough(random_trips(spark, 8), zones(spark, *ZONES), "pickup")
    whole = rows(rank.top_k(counts, 1000, "count", ["taxi_type", "Pickup_Borough"]))
    assert rows(rank.top_k(counts, 4, "count", ["taxi_type", "Pickup_Borough"])) == whole[:4]
    per_group = rank.top_k_per_group(counts, 2, ["taxi_type"], "count", ["Pickup_Borough"])
    for fleet in ("yellow_taxi", "green_taxi"):
        own = [row for row in whole if row[0] == fleet][:2]
        assert Counter(r for r in rows(per_group) if r[0] == fleet) == Counter(own)


def test_enrichment_does_not_depend_on_the_join_strategy(spark):
    """Beyond the broadcast threshold the same rows come from a shuffle join."""
    trips, zone_table = random_trips(spark, 9, hot_share=0.9), zones(spark, *ZONES)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    small = Counter(rows(enrich.with_zones(trips, zone_table)))
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        shuffled = Counter(rows(enrich.with_zones(trips, zone_table)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert small == shuffled
    assert sum(small.values()) >= N


def test_share_and_complement_make_a_hundred(spark):
    shares = jobs.share_with_complement(jobs.share(random_trips(spark, 10)))
    for row in shares.collect():
        assert row["percentage"] + row["other_percentage"] == pytest.approx(100.0)
        assert 0 < row["single_total"] < row["total"]


YEAR = ("2023-01-01 00:00:00", "2023-12-31 23:59:59")
COMPAT_JOBS = {
    "enrich": lambda t, z: jobs.enrich_trips(t, z, mode=COMPAT),
    "borough counts": lambda t, z: jobs.borough_counts(t, z, mode=COMPAT),
    "filtered": lambda t, z: jobs.filtered_by_day(t, YEAR, mode=COMPAT),
    "top combined": lambda t, z: jobs.top_boroughs_combined(t, z, mode=COMPAT),
    "daily": lambda t, z: jobs.daily_with_mean(t, YEAR, fleet=YELLOW, mode=COMPAT),
    "fare per mile": lambda t, z: jobs.fare_per_mile(t, YEAR, mode=COMPAT).withColumn(
        "avg_fpm", F.round("avg_fpm", 6)
    ),
    "share": lambda t, z: jobs.share(t, mode=COMPAT),
    "durations": lambda t, z: jobs.durations(t, YEAR, mode=COMPAT),
    "top merged": lambda t, z: jobs.top_boroughs_merged(t, z, mode=COMPAT),
    "busiest month": lambda t, z: jobs.busiest_month(t, mode=COMPAT),
}


@pytest.mark.parametrize("name", COMPAT_JOBS)
def test_compat_on_typed_columns_equals_text_columns(spark, tmp_path_factory, name):
    """Deciding the text rules by value gives what comparing real text gives."""
    path = str(tmp_path_factory.getbasetemp() / "compat-trips")
    random_trips(spark, 11).withColumn(
        "trip_distance", F.when(F.rand(12) < 0.01, 1.0e-4).otherwise(F.col("trip_distance"))
    ).withColumn(
        "pickup_ts",
        F.when(F.rand(13) < 0.05, F.col("pickup_ts") + F.expr("INTERVAL '0.25' SECOND")).otherwise(
            F.col("pickup_ts")
        ),
    ).write.mode("ignore").parquet(path)
    trips, zone_table = spark.read.parquet(path), zones(spark, *ZONES)
    typed = COMPAT_JOBS[name](trips, zone_table)
    textual = COMPAT_JOBS[name](all_text(trips), zone_table)
    assert typed.columns == textual.columns
    assert Counter(rows(typed)) == Counter(rows(textual))
    assert typed.count() > 0
