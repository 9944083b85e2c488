"""The sample views as SQL, for the oracle queries."""

# ---- fixed values: the same views as tripstats.sources.sample ---------------
_TRIPS = """
trips AS (
  SELECT CASE WHEN l_linestatus = 'O' THEN 'yellow_taxi' ELSE 'green_taxi' END AS taxi_type,
         o_orderdate AS pickup_ts, l_shipdate AS dropoff_ts,
         s_nationkey AS PULocationID, c_nationkey AS DOLocationID,
         l_quantity AS trip_distance, l_extendedprice AS fare_amount,
         CAST(l_linenumber AS DOUBLE) AS passenger_count, l_tax AS airport_fee
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN supplier ON l_suppkey = s_suppkey
  LEFT JOIN customer ON o_custkey = c_custkey
)"""

# A fare as the meter gives it: now and then negative, between -1 and 0, or tiny.
_METERED_FARE = """CASE l_partkey % 11 WHEN 0 THEN -l_extendedprice
      WHEN 1 THEN -l_linenumber / CAST(8 AS DOUBLE)
      WHEN 2 THEN l_linenumber / CAST(1048576 AS DOUBLE) ELSE l_extendedprice END"""

_METERED = _TRIPS.replace(
    "l_shipdate AS dropoff_ts", "CASE WHEN l_partkey % 13 <> 0 THEN l_shipdate END AS dropoff_ts"
).replace("l_extendedprice AS fare_amount", f"{_METERED_FARE} AS fare_amount")

_ZONES = """
zones AS (
  SELECT n_nationkey AS LocationID, r_name AS Borough, n_name AS Zone,
         'zone_' || CAST(r_regionkey AS VARCHAR) AS service_zone
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""

_FEED = f"""
feed AS (
  SELECT CASE WHEN l_linestatus = 'O' THEN 'yellow_taxi' ELSE 'green_taxi' END AS taxi_type,
         strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS pickup_ts,
         CASE WHEN l_returnflag = 'A' THEN 'not recorded'
              ELSE strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') END AS dropoff_ts,
         l_quantity AS trip_distance,
         CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE {_METERED_FARE} END AS fare_amount,
         CAST(l_linenumber AS DOUBLE) AS passenger_count, l_tax AS airport_fee
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""

_ENRICHED = """
enriched AS (
  SELECT t.*, p.Borough AS Pickup_Borough, p.Zone AS Pickup_Zone,
         p.service_zone AS Pickup_service_zone,
         d.Borough AS Dropoff_Borough, d.Zone AS Dropoff_Zone,
         d.service_zone AS Dropoff_service_zone
  FROM trips t
  LEFT JOIN zones p ON t.PULocationID = p.LocationID
  LEFT JOIN zones d ON t.DOLocationID = d.LocationID
)"""
# -----------------------------------------------------------------------------

# Columns of a trip without location ids.
TRIP_COLUMNS = (
    "taxi_type, pickup_ts, dropoff_ts, trip_distance, fare_amount, "
    "passenger_count, airport_fee"
)


# What the text comparison with 0 lets through, said in numbers: above -1, within the int
# range, and not printed with an exponent.
PLAIN = (
    "({0} > -1 AND {0} < 2147483648 AND ({0} = 0 OR abs({0}) BETWEEN 0.001 AND 9999999.999999))"
)


def id_as_text(column: str) -> str:
    """A location id as files have it: ``7`` or ``7.0``, by the line number."""
    text = f"CAST({column} AS VARCHAR)"
    return f"CASE WHEN CAST(passenger_count AS INT) % 2 = 0 THEN {text} || '.0' ELSE {text} END"


def trips(body: str) -> str:
    return f"WITH {_TRIPS} {body}"


def feed(body: str) -> str:
    return f"WITH {_FEED} {body}"


def zoned(body: str) -> str:
    """Trips with the zones of both ends as ``enriched``."""
    return f"WITH {_TRIPS}, {_ZONES}, {_ENRICHED} {body}"


def zoned_and(more: str, body: str) -> str:
    """``zoned`` with further CTEs."""
    return f"WITH {_TRIPS}, {_ZONES}, {_ENRICHED}, {more} {body}"


def metered(body: str) -> str:
    """Dirty trips as ``trips``."""
    return f"WITH {_METERED} {body}"


def metered_zoned(body: str) -> str:
    return f"WITH {_METERED}, {_ZONES}, {_ENRICHED} {body}"


def metered_zoned_and(more: str, body: str) -> str:
    return f"WITH {_METERED}, {_ZONES}, {_ENRICHED}, {more} {body}"
