"""Time the end-to-end jobs and print one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local cores.
``--compare`` also times the same questions asked the plain way: every column
cast to text, both zone joins under every count, one action per number.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tripstats import registry  # noqa: E402
from tripstats.model import COMPAT, FLEETS, YELLOW  # noqa: E402
from tripstats.operators import aggregate, enrich, predicates, rank  # noqa: E402
from tripstats.operators.cleanse import all_text, cleanse  # noqa: E402
from tripstats.registry.analyses import JULY, TEXT_BOUNDS  # noqa: E402
from tripstats.sources import sample  # noqa: E402

HEADLINES = [
    "job_enrich_trips",
    "job_borough_counts",
    "job_filtered_by_day",
    "job_filtered_by_day_lexical",
    "job_topk_combined",
    "job_daily_with_mean",
    "job_daily_with_mean_all",
    "job_fare_per_mile",
    "job_fare_per_mile_all",
    "job_share",
    "job_durations",
    "job_durations_all",
    "job_top_boroughs_merged",
    "job_top_boroughs_merged_compat",
    "job_busiest_month",
    "job_busiest_month_compat",
    "job_busiest_month_named",
    "job_anomaly_bands",
    "job_share_complement",
]
RUNS = 3


def finish(df: DataFrame) -> None:
    """Produce every row without keeping any."""
    df.write.format("noop").mode("overwrite").save()


def median_seconds(action) -> float:
    """Median over the runs after one warm-up."""
    times = []
    for _ in range(RUNS + 1):
        start = time.perf_counter()
        action()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times[1:]), 3)


# ---- the plain way ----------------------------------------------------------


def _text_trips(spark: SparkSession, sf_dir: str, tag: str, ids: bool = True) -> DataFrame:
    """Trips of one fleet as text; without location ids where no zone is asked for."""
    trips = sample.metered(spark, sf_dir, pickup=ids, dropoff=ids)
    return cleanse(all_text(predicates.of_fleet(trips, tag)), mode=COMPAT)


def plain_borough_counts(spark: SparkSession, sf_dir: str) -> None:
    for fleet in FLEETS:
        zoned = enrich.with_zones(
            _text_trips(spark, sf_dir, fleet.tag), sample.zones(spark, sf_dir)
        )
        for column in ("Pickup_Borough", "Dropoff_Borough"):
            finish(aggregate.count_by(zoned, column))


def plain_topk_combined(spark: SparkSession, sf_dir: str) -> None:
    for fleet in FLEETS:
        zoned = enrich.with_zones(
            _text_trips(spark, sf_dir, fleet.tag), sample.zones(spark, sf_dir)
        )
        pickups = aggregate.count_by(zoned, F.col("Pickup_Borough").alias("Borough"))
        dropoffs = aggregate.count_by(zoned, F.col("Dropoff_Borough").alias("Borough"))
        both = enrich.combine_counts(
            pickups.withColumnRenamed("count", "p"),
            dropoffs.withColumnRenamed("count", "d"),
            ["Borough"],
        )
        finish(rank.top_k(both.withColumn("s", F.col("p") + F.col("d")), 3, "s", ["Borough"]))


def plain_filtered_by_day(spark: SparkSession, sf_dir: str) -> None:
    for fleet in FLEETS:
        zoned = enrich.with_zones(
            _text_trips(spark, sf_dir, fleet.tag), sample.zones(spark, sf_dir)
        )
        kept = predicates.time_range(zoned, "pickup_ts", *JULY, closed="neither")
        kept = predicates.above(kept, "fare_amount", TEXT_BOUNDS["min_fare"], COMPAT)
        kept = predicates.below(kept, "trip_distance", TEXT_BOUNDS["max_distance"], COMPAT)
        finish(aggregate.count_by(kept, F.to_date("pickup_ts").alias("day")))


def plain_fare_per_mile(spark: SparkSession, sf_dir: str) -> None:
    trips = predicates.time_range(
        _text_trips(spark, sf_dir, YELLOW.tag, ids=False), "pickup_ts", *JULY, closed="neither"
    )
    distance = F.col("trip_distance").try_cast("double")
    rows = trips.select(
        distance.alias("d"),
        F.try_divide(F.col("fare_amount").try_cast("double"), distance).alias("fare_per_mile"),
    )
    n = rows.count()
    moved = rows.filter(F.col("d") > 0)
    total = moved.agg(F.sum("fare_per_mile")).collect()[0][0]
    finish(moved.select("fare_per_mile", F.lit(n).alias("n"), F.lit(total / n).alias("avg")))


def plain_share(spark: SparkSession, sf_dir: str) -> None:
    for fleet in FLEETS:
        trips = _text_trips(spark, sf_dir, fleet.tag, ids=False)
        trips.count()
        trips.filter(F.col("passenger_count") == "1.0").count()


PLAIN = {
    "job_borough_counts": plain_borough_counts,
    "job_filtered_by_day_lexical": plain_filtered_by_day,
    "job_topk_combined": plain_topk_combined,
    "job_fare_per_mile": plain_fare_per_mile,
    "job_share": plain_share,
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tripstats-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {
        name: median_seconds(lambda: finish(registry.QUERIES[name](spark, sf_dir)))
        for name in HEADLINES
    }
    result = {
        "metric": "total of the median seconds of the end-to-end jobs",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }
    if "--compare" in sys.argv:
        result["plain"] = {
            name: median_seconds(lambda: run(spark, sf_dir)) for name, run in PLAIN.items()
        }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
