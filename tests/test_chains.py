"""The tails of the analyses on published count tables.

The tables are counts of real trips; what each tail must make of them is known.
"""

from datetime import date

import pytest
from pyspark.sql import functions as F

from frames import rows
from tripstats.model import GREEN, YELLOW
from tripstats.plans import jobs

# ---- fixed values: published counts -----------------------------------------
# fleet -> borough -> (pickups, dropoffs)
BOROUGHS = {
    "yellow_taxi": {
        "Queens": (2156255, 1206699),
        "EWR": (3022, 66804),
        "Unknown": (251027, 322283),
        "Brooklyn": (153844, 876717),
        "Staten Island": (2033, 7029),
        "Manhattan": (19596373, 19583700),
        "Bronx": (34636, 133958),
    },
    "green_taxi": {
        "Queens": (120930, 118990),
        "EWR": (23, 339),
        "Unknown": (1332, 4993),
        "Brooklyn": (65583, 54317),
        "Staten Island": (62, 138),
        "Manhattan": (266942, 269076),
        "Bronx": (10423, 17442),
    },
}
TOTALS = {"yellow_taxi": 22197190, "green_taxi": 465295}
SINGLES = {"yellow_taxi": 16231479, "green_taxi": 367910}
PERCENTAGES = {"yellow_taxi": 73.12402605915433, "green_taxi": 79.07026724980926}
JULY_DAYS = [
    6697, 6812, 6963, 8044, 9194, 8456, 7682, 7484, 8745, 10891, 9861, 8393, 8445, 8165, 7611,
    9508, 11358, 9647, 9324, 8689, 8613, 7011, 9593, 9885, 8190, 9460, 8426, 9188, 6828, 10626,
    9749,
]
# -----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def per_role(spark):
    table = [
        (fleet, role, borough, counts[i])
        for fleet, boroughs in BOROUGHS.items()
        for borough, counts in boroughs.items()
        for i, role in enumerate(("pickup", "dropoff"))
    ]
    return spark.createDataFrame(
        table, "taxi_type string, role string, Borough string, count bigint"
    )


def test_pickups_and_dropoffs_add_up(per_role):
    sums = per_role.groupBy("taxi_type", "role").agg(F.sum("count"))
    assert {(f, n) for f, _, n in rows(sums)} == set(TOTALS.items())


def test_combined_top_yellow(per_role):
    own = per_role.filter("taxi_type = 'yellow_taxi'").drop("taxi_type")
    assert rows(jobs.combined_top_boroughs(own, fleet=YELLOW)) == [
        ("Manhattan", 19596373, 19583700, 39180073),
        ("Queens", 2156255, 1206699, 3362954),
        ("Brooklyn", 153844, 876717, 1030561),
        ("Unknown", 251027, 322283, 573310),
        ("Bronx", 34636, 133958, 168594),
    ]


def test_combined_top_green(per_role):
    own = per_role.filter("taxi_type = 'green_taxi'").drop("taxi_type")
    result = jobs.combined_top_boroughs(own, fleet=GREEN)
    assert result.columns == ["Borough", "GPickup_Count", "GDropoff_Count", "Count_Sum"]
    assert rows(result) == [
        ("Manhattan", 266942, 269076, 536018),
        ("Queens", 120930, 118990, 239920),
        ("Brooklyn", 65583, 54317, 119900),
        ("Bronx", 10423, 17442, 27865),
        ("Unknown", 1332, 4993, 6325),
    ]


def test_merged_top(per_role):
    pickups = per_role.filter("role = 'pickup'").select(
        "taxi_type", F.col("Borough").alias("Pickup_Borough"), "count"
    )
    assert rows(jobs.merged_top_boroughs(pickups)) == [
        ("Unknown_Green", 1332),
        ("Bronx_Green", 10423),
        ("Bronx_Yellow", 34636),
        ("Brooklyn_Green", 65583),
        ("Queens_Green", 120930),
        ("Brooklyn_Yellow", 153844),
        ("Unknown_Yellow", 251027),
        ("Manhattan_Green", 266942),
        ("Queens_Yellow", 2156255),
        ("Manhattan_Yellow", 19596373),
    ]


def test_busiest_months(spark):
    counts = spark.createDataFrame(
        [
            ("yellow_taxi", "2023-05", 3481709),
            ("green_taxi", "2023-03", 71843),
            ("yellow_taxi", "2023-04", 3000000),
            ("green_taxi", "2008-12", 2),
        ],
        "taxi_type string, month string, count bigint",
    )
    assert rows(jobs.labelled_busiest_month(counts, 2023, range(1, 8))) == [
        ("May (Yellow)", 3481709),
        ("March (Green)", 71843),
    ]


@pytest.fixture(scope="module")
def july(spark):
    table = [(date(2023, 7, i + 1), n) for i, n in enumerate(JULY_DAYS)]
    return spark.createDataFrame(table, "tpep_pickup_datetime date, count bigint")


def test_daily_mean(july):
    result = jobs.with_daily_mean(july, 31)
    assert result.columns == ["tpep_pickup_datetime", "count", "total", "mean"]
    assert {row[2:] for row in rows(result)} == {(8694.774193548386, 8695.0)}


def test_anomalies(july):
    flags = {
        row["tpep_pickup_datetime"].day: row["flag"]
        for row in jobs.anomaly_bands(jobs.with_daily_mean(july, 31)).collect()
    }
    odd = {day: flag for day, flag in flags.items() if flag != "normal"}
    assert odd == {1: "low", 2: "low", 29: "low", 10: "high", 17: "high", 30: "high"}


def test_percentages(spark):
    from tripstats.operators.aggregate import share_columns

    for fleet, total in TOTALS.items():
        hits = spark.range(total).agg(
            *share_columns(F.col("id") < SINGLES[fleet], "total", "singles")
        )
        assert rows(hits) == [(total, SINGLES[fleet], PERCENTAGES[fleet])]
