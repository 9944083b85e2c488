"""The physical plans: what is read, what is shuffled, what is scanned once."""

import re

import pytest

from tripstats import registry
from tripstats.model import YELLOW
from tripstats.operators import enrich
from tripstats.plans import jobs
from tripstats.registry.analyses import JULY
from tripstats.sources import sample

SF_DIR = "/root/testdata/sf0.01"


def planned(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_no_python_and_no_cross_join(spark, name):
    if name.startswith(("src_", "sink_")):
        pytest.skip("writes a table first")
    plan = planned(registry.QUERIES[name](spark, SF_DIR))
    for node in ("PythonUDF", "EvalPython", "InPandas", "CartesianProduct", "NestedLoopJoin"):
        assert node not in plan


def test_filters_and_columns_reach_the_scan(spark):
    plan = planned(jobs.daily_with_mean(sample.trips(spark, SF_DIR), JULY))
    assert "GreaterThan(o_orderdate,1996-07-01T00:00)" in plan
    assert "LessThan(o_orderdate,1996-07-" in plan
    assert "GreaterThan(l_tax,0.0)" in plan
    schemas = set(re.findall(r"ReadSchema: struct<([^>]*)>", plan))
    assert all("l_partkey" not in s and "l_discount" not in s for s in schemas)


def test_counts_are_partial_before_any_shuffle(spark):
    """No exchange sits between the trip rows and their partial count."""
    df = jobs.borough_counts(
        sample.trips(spark, SF_DIR, pickup=True), sample.zones(spark, SF_DIR), "pickup"
    )
    lines = planned(df).splitlines()
    exchanges = [i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 2
    assert all("partial_" in lines[i + 1] for i in exchanges)


def test_one_role_joins_one_end(spark):
    plan = planned(
        jobs.borough_counts(
            sample.trips(spark, SF_DIR, pickup=True), sample.zones(spark, SF_DIR), "pickup"
        )
    )
    assert "customer.parquet" not in plan


def test_both_roles_scan_the_trips_once(spark):
    trips = sample.trips(spark, SF_DIR, pickup=True, dropoff=True)
    zones = sample.zones(spark, SF_DIR)
    for df in (jobs.borough_counts(trips, zones), jobs.top_boroughs_combined(trips, zones)):
        assert planned(df).count("sf0.01/lineitem.parquet") == 1


def test_daily_mean_reuses_the_daily_counts(spark):
    df = jobs.daily_with_mean(sample.trips(spark, SF_DIR), JULY)
    df.collect()
    assert "ReusedExchange" in planned(df)
    assert "Window" not in planned(df)


def test_enrichment_broadcasts_only_below_the_threshold(spark):
    trips = sample.trips(spark, SF_DIR, pickup=True)
    zones = sample.zones(spark, SF_DIR)
    assert "BroadcastHashJoin [PULocationID" in planned(enrich.with_zone(trips, zones, "pickup"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = planned(enrich.with_zone(trips, zones, "pickup"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin [PULocationID" in plan
    assert "BroadcastHashJoin" not in plan


def test_top_k_does_not_sort_everything(spark):
    plan = planned(registry.QUERIES["topk"](spark, SF_DIR))
    assert "TakeOrderedAndProject" in plan


def test_top_k_per_group_limits_before_the_shuffle(spark):
    plan = planned(registry.QUERIES["topk_per_group"](spark, SF_DIR))
    assert "WindowGroupLimit" in plan


@pytest.mark.parametrize("fleet", [None, YELLOW])
def test_mean_fare_shuffles_no_trip_row(spark, tmp_path, fleet):
    """Above the trips' own rows stand filters and projections; only the means' partial sums
    are exchanged, in the subquery."""
    path = str(tmp_path / "trips")
    sample.trips(spark, SF_DIR).write.parquet(path)
    df = jobs.fare_per_mile(spark.read.parquet(path), JULY, fleet=fleet)
    assert df.count() > 0
    main, *subqueries = df._jdf.queryExecution().executedPlan().toString().split("Subquery subquery#")
    above = main[: main.index("FileScan")] if "FileScan" in main else main
    assert "Exchange" not in above and "Join" not in above
    assert any("partial_" in x for x in subqueries)
