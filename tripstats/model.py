"""Names, types and fixed values of the trip data model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# How a predicate compares a measure.
#   TYPED  - as the number it is.
#   COMPAT - as text, the way a table whose columns were all cast to string compares.
TYPED = "typed"
COMPAT = "compat"


@dataclass(frozen=True)
class Fleet:
    """One fleet: the tag in ``taxi_type``, its timestamp prefix and its label."""

    tag: str
    prefix: str
    label: str

    @property
    def pickup_column(self) -> str:
        return f"{self.prefix}_pickup_datetime"

    @property
    def dropoff_column(self) -> str:
        return f"{self.prefix}_dropoff_datetime"

    @property
    def short(self) -> str:
        return self.label[0]

    @property
    def name(self) -> str:
        return self.label.lower()


# ---- fixed values -----------------------------------------------------------
YELLOW = Fleet("yellow_taxi", "tpep", "Yellow")
GREEN = Fleet("green_taxi", "lpep", "Green")
FLEETS = (YELLOW, GREEN)

TS_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Columns of a trip file that the operators use; any other column passes
# through as text. Location ids come as `132` or as `132.0`, so they are read as
# text and become integers when the trips are normalised.
TRIP_TYPES: dict[str, T.DataType] = {
    "taxi_type": T.StringType(),
    "tpep_pickup_datetime": T.TimestampType(),
    "tpep_dropoff_datetime": T.TimestampType(),
    "lpep_pickup_datetime": T.TimestampType(),
    "lpep_dropoff_datetime": T.TimestampType(),
    "PULocationID": T.StringType(),
    "DOLocationID": T.StringType(),
    "trip_distance": T.DoubleType(),
    "fare_amount": T.DoubleType(),
    "passenger_count": T.DoubleType(),
    "airport_fee": T.DoubleType(),
}

ZONE_SCHEMA = T.StructType(
    [
        T.StructField("LocationID", T.IntegerType()),
        T.StructField("Borough", T.StringType()),
        T.StructField("Zone", T.StringType()),
        T.StructField("service_zone", T.StringType()),
    ]
)

LOCATION_IDS = ("PULocationID", "DOLocationID")
TIMESTAMPS = ("pickup_ts", "dropoff_ts")
MEASURES = ("trip_distance", "fare_amount")
# -----------------------------------------------------------------------------


def check_mode(mode: str) -> str:
    if mode not in (TYPED, COMPAT):
        raise ValueError(f"mode must be {TYPED!r} or {COMPAT!r}, not {mode!r}")
    return mode
