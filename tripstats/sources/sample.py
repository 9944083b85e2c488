"""Trips and zones as views over the star-schema sample tables.

A line item is a trip: it starts with its order, ends when it ships, goes from
the supplier's nation to the customer's. The ids come over left joins on primary
keys, so a query that asks for one end only may leave the other join out without
changing a row. None of the tables is small by definition, so no join is hinted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstats.model import GREEN, LOCATION_IDS, TIMESTAMPS, TS_FORMAT, YELLOW, Fleet
from tripstats.sources.readers import normalise, with_fleet_names

# ---- fixed values -----------------------------------------------------------
UNREADABLE_TIME = "not recorded"

SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
        "c_mktsegment string"
    ),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
        "value double, props string"
    ),
}
# -----------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A sample table; its schema is given, so no footer is read to find it."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _trip_columns(ids: list[Column]) -> list[Column]:
    return [
        F.when(F.col("l_linestatus") == "O", YELLOW.tag)
        .otherwise(GREEN.tag)
        .alias("taxi_type"),
        F.col("o_orderdate").alias("pickup_ts"),
        F.col("l_shipdate").alias("dropoff_ts"),
        *ids,
        F.col("l_quantity").alias("trip_distance"),
        F.col("l_extendedprice").alias("fare_amount"),
        F.col("l_linenumber").cast("double").alias("passenger_count"),
        F.col("l_tax").alias("airport_fee"),
    ]


def _items_with(orders: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    return items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


def _id_as_text(id_column: Column) -> Column:
    """A location id as files have it: ``7`` or ``7.0``."""
    whole = id_column.cast("string")
    return F.when(F.col("l_linenumber") % 2 == 0, F.concat(whole, F.lit(".0"))).otherwise(whole)


def _metered_fare() -> Column:
    """The price of an item, but now and then its negative, a fraction of a negative unit, or a
    number so small that it prints with an exponent."""
    part = F.col("l_partkey") % 11
    return (
        F.when(part == 0, -F.col("l_extendedprice"))
        .when(part == 1, -F.col("l_linenumber") / 8.0)
        .when(part == 2, F.col("l_linenumber") / 1048576.0)
        .otherwise(F.col("l_extendedprice"))
    )


def trips(
    spark: SparkSession,
    sf_dir: str,
    pickup: bool = False,
    dropoff: bool = False,
    text_ids: bool = False,
    dirty: bool = False,
) -> DataFrame:
    """The trip view, with the location id of the ends that are asked for.

    Customers join the orders, not the far more numerous items. ``text_ids`` gives ids as
    files have them; ``dirty`` gives fares of ``_metered_fare`` and leaves one dropoff time in
    thirteen unread, so that cleansing has something to do.
    """
    ids = []
    as_id = _id_as_text if text_ids else (lambda x: x)
    orders = table(spark, sf_dir, "orders")
    if dropoff:
        customer = table(spark, sf_dir, "customer")
        orders = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
    joined = _items_with(orders, spark, sf_dir)
    if pickup:
        supplier = table(spark, sf_dir, "supplier")
        joined = joined.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"), "left")
        ids.append(as_id(F.col("s_nationkey")).alias("PULocationID"))
    if dropoff:
        ids.append(as_id(F.col("c_nationkey")).alias("DOLocationID"))
    columns = _trip_columns(ids)
    if dirty:
        read = F.when(F.col("l_partkey") % 13 != 0, F.col("l_shipdate")).alias("dropoff_ts")
        columns[2] = read
        columns[-3] = _metered_fare().alias("fare_amount")
    return joined.select(*columns)


def metered(
    spark: SparkSession, sf_dir: str, pickup: bool = False, dropoff: bool = False
) -> DataFrame:
    """Dirty trips as a job gets them from files: ids come as text and are normalised."""
    raw = trips(spark, sf_dir, pickup, dropoff, text_ids=True, dirty=True)
    return normalise(raw, YELLOW)


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips as they come from a meter, before cleansing.

    Times are text, fares those of ``_metered_fare``. Items already delivered have an
    unreadable dropoff time, returned ones a negative fare.
    """
    items = _items_with(table(spark, sf_dir, "orders"), spark, sf_dir)
    raw = items.select(
        *_trip_columns([]), "l_returnflag", _metered_fare().alias("metered_fare")
    )
    as_text = {name: F.date_format(name, TS_FORMAT) for name in TIMESTAMPS}
    return raw.withColumns(
        {
            "pickup_ts": as_text["pickup_ts"],
            "dropoff_ts": F.when(
                F.col("l_returnflag") == "A", F.lit(UNREADABLE_TIME)
            ).otherwise(as_text["dropoff_ts"]),
            "fare_amount": F.when(
                F.col("l_returnflag") == "R", -F.col("fare_amount")
            ).otherwise(F.col("metered_fare")),
        }
    ).drop("l_returnflag", "metered_fare")


def fleet_feed(
    spark: SparkSession, sf_dir: str, fleet: Fleet, ids: bool = False
) -> DataFrame:
    """Trips of one fleet under that fleet's own column names, on request with ids as text.

    Only the yellow fleet reports an airport fee, and the green one puts its
    measures first.
    """
    own = trips(spark, sf_dir, ids, ids, text_ids=True)
    own = own.filter(F.col("taxi_type") == fleet.tag)
    own = with_fleet_names(own, fleet)
    if fleet == YELLOW:
        return own
    measures = ["trip_distance", "fare_amount", "passenger_count"]
    times = [fleet.pickup_column, fleet.dropoff_column]
    return own.select(*measures, "taxi_type", *times, *(LOCATION_IDS if ids else ()))


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The zone lookup: nations with their regions."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(
        F.col("n_nationkey").alias("LocationID"),
        F.col("r_name").alias("Borough"),
        F.col("n_name").alias("Zone"),
        F.concat(F.lit("zone_"), F.col("r_regionkey")).alias("service_zone"),
    )
