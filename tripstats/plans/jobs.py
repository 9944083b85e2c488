"""The end-to-end analyses over a normalised trip table.

Each job takes ``trips`` (``taxi_type, pickup_ts, dropoff_ts, PULocationID,
DOLocationID, trip_distance, fare_amount, passenger_count, airport_fee`` and
whatever else) and answers one question. Without ``fleet`` a job answers for all
fleets at once, in one pass and with ``taxi_type`` as a column; with ``fleet`` it
gives the single-fleet result table.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstats.functions import labels
from tripstats.functions.columns import numeric, text
from tripstats.functions.timestamps import (
    day,
    days_between,
    days_in,
    elapsed,
    interval_seconds,
    interval_text,
)
from tripstats.model import COMPAT, TYPED, Fleet
from tripstats.operators import aggregate, enrich, predicates, rank
from tripstats.operators.cleanse import all_text, cleanse

# ---- fixed values -----------------------------------------------------------
WEEK_ONE = ("2023-01-01 00:00:00", "2023-01-07 23:59:59")
JANUARY = ("2023-01-01 00:00:00", "2023-01-31 23:59:59")
MARCH = ("2023-03-01 00:00:00", "2023-03-31 23:59:59")
JULY = ("2023-07-01 00:00:00", "2023-07-31 23:59:59")
MIN_FARE = "50"
MAX_DISTANCE = "1"
NO_FEE = "0.0"
ONE_PASSENGER = "1.0"
TOP_BOROUGHS = 5
BAND = 0.2
# -----------------------------------------------------------------------------


def _clean(trips: DataFrame, fleet: Fleet | None, mode: str, non_negative: bool = True):
    if fleet is not None:
        trips = predicates.of_fleet(trips, fleet.tag)
    return cleanse(trips, non_negative=non_negative, mode=mode, keep_types=True)


def enrich_trips(
    trips: DataFrame, zones: DataFrame, fleet: Fleet | None = None, mode: str = TYPED
) -> DataFrame:
    """Trips with the zone of both ends; negative measures stay."""
    zoned = enrich.with_zones(_clean(trips, fleet, mode, non_negative=False), zones)
    return all_text(zoned) if mode == COMPAT else zoned


def borough_counts(
    trips: DataFrame,
    zones: DataFrame,
    role: str | None = None,
    fleet: Fleet | None = None,
    mode: str = TYPED,
) -> DataFrame:
    """Trips per borough. Without ``role`` pickups and dropoffs share one pass."""
    trips = _clean(trips, fleet, mode)
    by = ["taxi_type"] if fleet is None else []
    if role is None:
        return enrich.count_per_role_and_borough(trips, zones, by)
    return enrich.count_per_borough(trips, zones, role, by)


def filtered_by_day(
    trips: DataFrame,
    period: tuple[str, str] = WEEK_ONE,
    min_fare: str = MIN_FARE,
    max_distance: str = MAX_DISTANCE,
    closed: str = "neither",
    fleet: Fleet | None = None,
    mode: str = TYPED,
) -> DataFrame:
    """Trips per day that cost more than one bound and went less far than another."""
    trips = _clean(trips, fleet, mode)
    trips = predicates.time_range(trips, "pickup_ts", *period, closed=closed)
    trips = predicates.above(trips, "fare_amount", min_fare, mode)
    trips = predicates.below(trips, "trip_distance", max_distance, mode)
    if fleet is None:
        return aggregate.count_by(trips, "taxi_type", day(trips, "pickup_ts").alias("day"))
    return aggregate.count_by(trips, day(trips, "pickup_ts").alias(fleet.pickup_column))


def top_boroughs_combined(
    trips: DataFrame,
    zones: DataFrame,
    k: int = TOP_BOROUGHS,
    fleet: Fleet | None = None,
    mode: str = TYPED,
) -> DataFrame:
    """Boroughs with the most pickups and dropoffs together.

    A borough counts only if trips both start and end there.
    """
    trips = _clean(trips, fleet, mode)
    by = ["taxi_type"] if fleet is None else []
    return combined_top_boroughs(
        enrich.count_per_role_and_borough(trips, zones, by), k, fleet
    )


def combined_top_boroughs(
    per_role: DataFrame, k: int = TOP_BOROUGHS, fleet: Fleet | None = None
) -> DataFrame:
    """The list of ``top_boroughs_combined`` from counts per role and borough.

    Both counts of a borough come from one grouping of the table, not from
    joining it with itself.
    """
    by = ["taxi_type"] if fleet is None else []
    initial = fleet.short if fleet else ""
    pickups, dropoffs = f"{initial}Pickup_Count", f"{initial}Dropoff_Count"
    both = (
        per_role.groupBy(*by, "Borough")
        .agg(
            F.sum(F.when(F.col("role") == "pickup", F.col("count"))).alias(pickups),
            F.sum(F.when(F.col("role") == "dropoff", F.col("count"))).alias(dropoffs),
        )
        .dropna(subset=["Borough", pickups, dropoffs])
        .withColumn("Count_Sum", F.col(pickups) + F.col(dropoffs))
    )
    if by:
        return rank.top_k_per_group(both, k, by, "Count_Sum", ["Borough"])
    return rank.top_k(both, k, "Count_Sum", ["Borough"])


def daily_with_mean(
    trips: DataFrame,
    period: tuple[str, str] = JULY,
    fee: str = "airport_fee",
    divisor: int | None = None,
    closed: str = "neither",
    fleet: Fleet | None = None,
    mode: str = TYPED,
    every_day: bool = False,
) -> DataFrame:
    """Trips with a surcharge per day, with the mean per day beside it.

    ``total`` is the mean as it comes out, ``mean`` the same rounded. The divisor is
    the number of days of the period unless another is given. ``every_day`` also lists
    days without such trips, with a count of 0.
    """
    by = ["taxi_type"] if fleet is None else []
    day_name = fleet.pickup_column if fleet else "day"
    trips = _clean(trips, fleet, mode)
    trips = predicates.time_range(trips, "pickup_ts", *period, closed=closed)
    trips = predicates.above(trips, fee, NO_FEE, mode)
    daily = aggregate.count_by(trips, *by, day(trips, "pickup_ts").alias(day_name))
    if every_day:
        daily = with_every_day(daily, period, day_name, by, closed)
    days = F.lit(divisor) if divisor is not None else days_in(period, closed)
    return with_daily_mean(daily, days, by).orderBy(*by, day_name)


def with_daily_mean(
    daily: DataFrame, divisor: int | Column, by: Sequence[str] = ()
) -> DataFrame:
    """Add ``total`` and ``mean`` to a table of counts per day, for each value of ``by``."""
    mean = aggregate.fixed_divisor_mean(F.sum("count"), divisor).alias("total")
    if by:
        with_mean = daily.join(daily.groupBy(*by).agg(mean), list(by))
    else:
        with_mean = aggregate.attach(daily, daily.agg(mean), total="total")
    return with_mean.withColumn("mean", F.round("total"))


def with_every_day(
    daily: DataFrame,
    period: tuple[str, str],
    day_name: str,
    by: Sequence[str] = (),
    closed: str = "neither",
) -> DataFrame:
    """Add the days of a period that have no row, with a count of 0, for each value of ``by``."""
    first, last = days_between(period, closed)
    each = F.explode(F.sequence(first, last)).alias(day_name)
    groups = daily.select(*by).distinct() if by else daily.sparkSession.range(1)
    calendar = groups.select(*by, each)
    return calendar.join(daily, [*by, day_name], "left").fillna(0, ["count"])


def fare_per_mile(
    trips: DataFrame,
    period: tuple[str, str] = MARCH,
    denominator: str = "all",
    closed: str = "neither",
    fleet: Fleet | None = None,
    mode: str = TYPED,
) -> DataFrame:
    """Fare per mile of every trip that moved, with the mean on every row.

    ``denominator="all"`` divides by every trip of the period, also by those
    that did not move; ``"valid"`` by the ones that did. Without ``fleet`` every fleet has
    a mean of its own; the trips of no fleet are left out. Trip rows are never shuffled.
    """
    means = {"all": aggregate.mean_over_all_rows, "valid": aggregate.mean_over_valid_rows}
    trips = predicates.time_range(
        _clean(trips, fleet, mode), "pickup_ts", *period, closed=closed
    )
    by = ["taxi_type"] if fleet is None else []
    distance = numeric(trips, "trip_distance")
    ratio = F.try_divide(
        numeric(trips, "fare_amount").cast("double"), distance.cast("double")
    )
    moved = distance > 0
    length = F.count(F.lit(1)) if denominator == "all" else F.count_if(moved)
    mean = means[denominator](ratio, moved)
    names = ("len(fare_per_mile)", "avg_fpm")
    rows = trips.filter(moved).select(*by, ratio.alias("fare_per_mile"))
    if by:
        summary = trips.groupBy(*by).agg(F.struct(length, mean).alias("of_fleet"))
        return aggregate.attach_by_key(rows, summary, "taxi_type", "of_fleet", names)
    summary = trips.agg(length.alias(names[0]), mean.alias(names[1]))
    return aggregate.attach(rows, summary, **{name: name for name in names})


def share(
    trips: DataFrame,
    column: str = "passenger_count",
    value: str = ONE_PASSENGER,
    fleet: Fleet | None = None,
    mode: str = TYPED,
) -> DataFrame:
    """Share of the trips with one value, such as a single passenger, in percent."""
    trips = _clean(trips, fleet, mode)
    hit = predicates.is_value(trips, column, value, mode)
    if fleet is None:
        return trips.groupBy("taxi_type").agg(
            *aggregate.share_columns(hit, "total", "single_total")
        )
    return trips.agg(
        *aggregate.share_columns(hit, f"{fleet.name}_total", f"{fleet.name}_single_total")
    )


def share_with_complement(shares: DataFrame) -> DataFrame:
    """Add the rest of the hundred percent."""
    return shares.withColumn("other_percentage", F.lit(100.0) - F.col("percentage"))


def durations(
    trips: DataFrame,
    period: tuple[str, str] = JANUARY,
    closed: str = "neither",
    fleet: Fleet | None = None,
    mode: str = TYPED,
    with_seconds: bool = False,
) -> DataFrame:
    """Fare and duration of every trip; negative measures and durations stay."""
    trips = predicates.time_range(
        _clean(trips, fleet, mode, non_negative=False), "pickup_ts", *period, closed=closed
    )
    interval = elapsed(trips, "pickup_ts", "dropoff_ts")
    fare = F.col("fare_amount") if mode == TYPED else text("fare_amount")
    columns = ["taxi_type"] if fleet is None else []
    columns += [fare.alias("fare_amount"), interval_text(interval).alias("duration")]
    if with_seconds:
        columns.append(interval_seconds(interval).alias("duration_seconds"))
    return trips.select(*columns)


def top_boroughs_merged(
    trips: DataFrame,
    zones: DataFrame,
    k: int = TOP_BOROUGHS,
    listed: Iterable[str] | None = None,
    mode: str = TYPED,
) -> DataFrame:
    """The busiest pickup boroughs of every fleet in one list, smallest first.

    ``listed`` names the boroughs that get a fleet suffix. Without it all get one, in
    compat mode those of the fixed list.
    """
    if listed is None and mode == COMPAT:
        listed = labels.LABELLED_BOROUGHS
    counts = enrich.count_per_borough(_clean(trips, None, mode), zones, "pickup")
    return merged_top_boroughs(counts, k, listed)


def merged_top_boroughs(
    counts: DataFrame, k: int = TOP_BOROUGHS, listed: Iterable[str] | None = None
) -> DataFrame:
    """The list of ``top_boroughs_merged`` from counts per fleet and borough."""
    best = rank.top_k_per_group(counts, k, ["taxi_type"], "count", ["Pickup_Borough"])
    borough, tag = F.col("Pickup_Borough"), F.col("taxi_type")
    label = (
        labels.with_fleet_suffix(borough, tag)
        if listed is None
        else labels.listed_with_fleet_suffix(borough, tag, listed)
    )
    return best.select(label.alias("Pickup_Borough"), "count").orderBy(
        "count", "Pickup_Borough"
    )


def busiest_month(
    trips: DataFrame,
    period: tuple[str, str] | None = None,
    year: int | None = None,
    months: Iterable[int] | None = None,
    mode: str = TYPED,
) -> DataFrame:
    """The month with the most trips of every fleet.

    ``period`` (half-open) keeps stray dates of other years out. With ``year`` the months of
    that year are named, with ``months`` only those of the list; others keep their text.
    Compat mode without either has a fixed list. Otherwise every month is ``yyyy-MM`` with
    its fleet.
    """
    if year is not None and months is None:
        months = range(1, 13)
    elif mode == COMPAT and months is None:
        months = labels.LABELLED_MONTHS
    if months is not None and year is None:
        year = labels.LABELLED_YEAR
    trips = _clean(trips, None, mode)
    if period is not None:
        trips = predicates.time_range(trips, "pickup_ts", *period)
    counts = aggregate.count_by_month(trips, "pickup_ts", "taxi_type")
    return labelled_busiest_month(counts, year, months)


def labelled_busiest_month(
    counts: DataFrame, year: int | None = None, months: Iterable[int] | None = None
) -> DataFrame:
    """The list of ``busiest_month`` from counts per fleet and month."""
    best = rank.top_k_per_group(counts, 1, ["taxi_type"], "count", ["month"])
    month, tag = F.col("month"), F.col("taxi_type")
    label = (
        labels.month_with_fleet(month, tag)
        if months is None
        else labels.listed_month_with_fleet(month, tag, year, months)
    )
    return best.orderBy(F.desc("taxi_type")).select(label.alias("month"), "count")


def anomaly_bands(daily: DataFrame, band: float = BAND) -> DataFrame:
    """Mark days that stray from the mean by more than a share of it.

    Takes the table of ``daily_with_mean`` and compares with the unrounded mean.
    """
    low, high = F.col("total") * (1 - band), F.col("total") * (1 + band)
    return daily.withColumns(
        {
            "low_band": low,
            "high_band": high,
            "flag": F.when(F.col("count") < low, "low")
            .when(F.col("count") > high, "high")
            .otherwise("normal"),
        }
    )
