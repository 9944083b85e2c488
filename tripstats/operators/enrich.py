"""Joining trips with the zone dimension.

Row-level enrichment is a left equi-join without a hint. Spark measures the
zone side itself and broadcasts it only below
``spark.sql.autoBroadcastJoinThreshold``; beyond that the join is a shuffle join
whose hot keys adaptive execution splits. Counts do not join trip rows at all:
they count per location id first and join the handful of counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstats.functions.columns import location_key

# role -> (location id of the trip, prefix of the zone columns)
ROLES = {
    "pickup": ("PULocationID", "Pickup"),
    "dropoff": ("DOLocationID", "Dropoff"),
}


def with_zone(trips: DataFrame, zones: DataFrame, role: str) -> DataFrame:
    """Trips plus ``<Role>_Borough/_Zone/_service_zone``; unmatched trips keep NULLs."""
    id_column, prefix = ROLES[role]
    side = zones.select(
        location_key(zones, "LocationID").alias("_zone_key"),
        F.col("Borough").alias(f"{prefix}_Borough"),
        F.col("Zone").alias(f"{prefix}_Zone"),
        F.col("service_zone").alias(f"{prefix}_service_zone"),
    )
    on = location_key(trips, id_column) == F.col("_zone_key")
    return trips.join(side, on, "left").drop("_zone_key")


def with_zones(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Trips plus the zone columns of both ends."""
    return with_zone(with_zone(trips, zones, "pickup"), zones, "dropoff")


def _sum_per_borough(
    counts: DataFrame, zones: DataFrame, group: Sequence[str | Column], label: str
) -> DataFrame:
    """Counts per location id to counts per borough.

    A location id listed twice in the zones counts once per listing, just as
    joining the trips themselves would.
    """
    side = zones.select(
        location_key(zones, "LocationID").alias("_zone_key"),
        F.col("Borough").alias(label),
    )
    return (
        counts.join(side, counts["_location"] == F.col("_zone_key"), "left")
        .groupBy(*group, label)
        .agg(F.sum("_n").alias("count"))
    )


def count_per_borough(
    trips: DataFrame,
    zones: DataFrame,
    role: str,
    by: Sequence[str] = ("taxi_type",),
    label: str | None = None,
) -> DataFrame:
    """Trips per borough of one role, the same as joining and then counting.

    The shuffle carries one partial count per location id and task, so a borough
    that holds most of the trips costs no more than any other.
    """
    id_column, prefix = ROLES[role]
    counts = trips.groupBy(
        *by, location_key(trips, id_column).alias("_location")
    ).agg(F.count(F.lit(1)).alias("_n"))
    return _sum_per_borough(counts, zones, by, label or f"{prefix}_Borough")


def count_per_role_and_borough(
    trips: DataFrame, zones: DataFrame, by: Sequence[str] = ("taxi_type",)
) -> DataFrame:
    """Trips per role and borough, both roles in one pass over the trips."""
    pickup, dropoff = (ROLES[role][0] for role in ("pickup", "dropoff"))
    keyed = trips.select(
        *by,
        location_key(trips, pickup).alias("_pu"),
        location_key(trips, dropoff).alias("_do"),
    )
    sets = [[*by, "_pu"], [*by, "_do"]]
    counts = (
        keyed.groupingSets(sets, *by, "_pu", "_do")
        .agg(
            F.grouping("_do").alias("_is_pickup"),
            F.count(F.lit(1)).alias("_n"),
        )
        .select(
            *by,
            F.when(F.col("_is_pickup") == 1, "pickup").otherwise("dropoff").alias("role"),
            F.when(F.col("_is_pickup") == 1, F.col("_pu"))
            .otherwise(F.col("_do"))
            .alias("_location"),
            "_n",
        )
    )
    return _sum_per_borough(counts, zones, [*by, "role"], "Borough")


def combine_counts(pickups: DataFrame, dropoffs: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner join of two count tables; a NULL key or a one-sided key drops out."""
    return pickups.join(dropoffs, on=list(on), how="inner")
