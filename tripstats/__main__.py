"""Run one analysis on trip files and write its result tables as CSV.

    python -m tripstats JOB --yellow FILE... --green FILE... --zones FILE --out FOLDER

Storage endpoints and credentials are session settings (``spark.hadoop.*``);
every path may be any URI the session can read.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstats.model import COMPAT, FLEETS, TYPED, Fleet
from tripstats.plans import jobs
from tripstats.session import session
from tripstats.sources import layout, readers, sinks

# name, table, and the order of a table small enough for a single file, else None
Result = tuple[str, DataFrame, list | None]


class Inputs:
    """The trip tables and the zones that the arguments name."""

    def __init__(self, spark: SparkSession, args: argparse.Namespace):
        self.spark, self.args = spark, args
        self._files = dict(zip(FLEETS, (args.yellow, args.green)))

    @property
    def fleets(self) -> list[Fleet]:
        if self.args.table:
            return list(FLEETS)
        return [fleet for fleet in FLEETS if self._files[fleet]]

    @property
    def zones(self) -> DataFrame:
        if not self.args.zones:
            raise SystemExit("this job needs --zones")
        return readers.read_zones(self.spark, self.args.zones)

    def trips(
        self, fleet: Fleet, period: tuple[str | None, str | None] | None = None
    ) -> DataFrame:
        """Trips of one fleet; only the months of the period, if the layout allows."""
        if self.args.table:
            bounds = period or (None, None)
            table = layout.read_trip_table(self.spark, self.args.table, *bounds, fleet=fleet)
            return table.drop("pickup_month")
        files = self._files[fleet]
        if not files:
            raise SystemExit(f"this job needs --{fleet.name} or --table")
        layouts = None
        if self.args.same_header:
            layouts = {readers.csv_header(self.spark, files[0]): files}
        return readers.normalise(readers.read_trip_csv(self.spark, files, layouts), fleet)

    def all_trips(self, period: tuple[str | None, str | None] | None = None) -> DataFrame:
        both = [self.trips(fleet, period) for fleet in self.fleets]
        if not both:
            raise SystemExit("this job needs --yellow, --green or --table")
        return both[0] if len(both) == 1 else both[0].unionByName(
            both[1], allowMissingColumns=True
        )

    def period(self, default: tuple[str, str]) -> tuple[str, str]:
        return self.args.start or default[0], self.args.end or default[1]


def _enrich(inputs: Inputs) -> Iterator[Result]:
    for fleet in inputs.fleets:
        trips = jobs.enrich_trips(
            inputs.trips(fleet), inputs.zones, fleet, inputs.args.mode
        )
        yield f"enriched_{fleet.name}", readers.with_fleet_names(trips, fleet), None


def _borough_counts(inputs: Inputs) -> Iterator[Result]:
    for fleet in inputs.fleets:
        counts = jobs.borough_counts(
            inputs.trips(fleet), inputs.zones, fleet=fleet, mode=inputs.args.mode
        ).cache()
        for role in ("pickup", "dropoff"):
            table = counts.filter(F.col("role") == role).select(
                F.col("Borough").alias(f"{role.capitalize()}_Borough"), "count"
            )
            yield f"boroughs_{fleet.name}_{role}", table, [table.columns[0]]
        counts.unpersist()


def _filtered_by_day(inputs: Inputs) -> Iterator[Result]:
    period = inputs.period(jobs.WEEK_ONE)
    for fleet in inputs.fleets:
        table = jobs.filtered_by_day(
            inputs.trips(fleet, period), period, fleet=fleet, mode=inputs.args.mode
        )
        yield f"filtered_{fleet.name}", table, [fleet.pickup_column]


def _top_combined(inputs: Inputs) -> Iterator[Result]:
    for fleet in inputs.fleets:
        table = jobs.top_boroughs_combined(
            inputs.trips(fleet), inputs.zones, inputs.args.k, fleet, inputs.args.mode
        )
        yield f"top_{fleet.name}", table, [F.desc("Count_Sum"), "Borough"]


def _daily_with_mean(inputs: Inputs) -> Iterator[Result]:
    """A table for every fleet whose trips have the fee."""
    period, fee = inputs.period(jobs.JULY), inputs.args.fee
    trips = {fleet: inputs.trips(fleet, period) for fleet in inputs.fleets}
    having = {fleet: df for fleet, df in trips.items() if fee in df.columns}
    if not having:
        raise SystemExit(f"no trips with a column {fee}")
    for fleet, df in having.items():
        table = jobs.daily_with_mean(
            df,
            period,
            fee,
            divisor=inputs.args.days,
            fleet=fleet,
            mode=inputs.args.mode,
            every_day=inputs.args.every_day,
        )
        yield f"daily_{fleet.name}", table, [fleet.pickup_column]


def _anomalies(inputs: Inputs) -> Iterator[Result]:
    for name, daily, order in _daily_with_mean(inputs):
        yield name.replace("daily", "anomalies"), jobs.anomaly_bands(daily), order


def _fare_per_mile(inputs: Inputs) -> Iterator[Result]:
    period = inputs.period(jobs.MARCH)
    for fleet in inputs.fleets:
        table = jobs.fare_per_mile(
            inputs.trips(fleet, period), period, fleet=fleet, mode=inputs.args.mode
        )
        yield f"fare_per_mile_{fleet.name}", table, None


def _share(inputs: Inputs) -> Iterator[Result]:
    for fleet in inputs.fleets:
        table = jobs.share(inputs.trips(fleet), fleet=fleet, mode=inputs.args.mode)
        yield f"share_{fleet.name}", table, []


def _durations(inputs: Inputs) -> Iterator[Result]:
    period = inputs.period(jobs.JANUARY)
    for fleet in inputs.fleets:
        table = jobs.durations(
            inputs.trips(fleet, period), period, fleet=fleet, mode=inputs.args.mode
        )
        yield f"durations_{fleet.name}", table, None


def _top_merged(inputs: Inputs) -> Iterator[Result]:
    table = jobs.top_boroughs_merged(
        inputs.all_trips(), inputs.zones, inputs.args.k, inputs.args.listed, inputs.args.mode
    )
    yield "top_merged", table, ["count", "Pickup_Borough"]


def _busiest_month(inputs: Inputs) -> Iterator[Result]:
    args = inputs.args
    period = (args.start, args.end) if args.start or args.end else None
    table = jobs.busiest_month(
        inputs.all_trips(period), period, args.year, args.months, args.mode
    )
    yield "busiest_month", table, ["month"]


JOBS: dict[str, Callable[[Inputs], Iterator[Result]]] = {
    "enrich": _enrich,
    "borough-counts": _borough_counts,
    "filtered-by-day": _filtered_by_day,
    "top-combined": _top_combined,
    "daily-with-mean": _daily_with_mean,
    "anomalies": _anomalies,
    "fare-per-mile": _fare_per_mile,
    "share": _share,
    "durations": _durations,
    "top-merged": _top_merged,
    "busiest-month": _busiest_month,
}


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tripstats", description=__doc__)
    parser.add_argument("job", choices=[*JOBS, "load"])
    parser.add_argument("--yellow", nargs="+", default=[], help="CSV paths")
    parser.add_argument("--green", nargs="+", default=[], help="CSV paths")
    parser.add_argument("--table", help="trip table written by 'load', instead of CSV paths")
    parser.add_argument("--zones", help="CSV path of the zone lookup")
    parser.add_argument("--out", required=True, help="folder for the result tables")
    parser.add_argument("--mode", choices=[TYPED, COMPAT], default=TYPED)
    parser.add_argument("--start", help="first time of the period, yyyy-MM-dd HH:mm:ss")
    parser.add_argument("--end", help="end of the period")
    parser.add_argument("--fee", default="airport_fee", help="surcharge that daily means count")
    parser.add_argument("--days", type=int, help="divisor of daily means, if not the period's days")
    parser.add_argument("--every-day", action="store_true", help="list days without trips too")
    parser.add_argument("--listed", nargs="*", help="only these boroughs get a fleet suffix")
    parser.add_argument("--year", type=int, help="year whose months get a name")
    parser.add_argument("--months", type=int, nargs="*", help="only these months get a name")
    parser.add_argument("--load", default="all", help="name of the load that 'load' writes")
    parser.add_argument(
        "--same-header", action="store_true", help="all paths of a fleet have the header of its first"
    )
    parser.add_argument(
        "--drop-replaced", action="store_true", help="after 'load', delete what it replaced"
    )
    parser.add_argument("--preview", action="store_true", help="print schema and first rows")
    parser.add_argument("-k", type=int, default=jobs.TOP_BOROUGHS)
    return parser.parse_args(argv)


def run(spark: SparkSession, args: argparse.Namespace) -> list[str]:
    """Run the job and return the folders it wrote."""
    inputs = Inputs(spark, args)
    if args.job == "load":
        layout.write_trip_table(inputs.all_trips(), args.out, args.load)
        if args.drop_replaced:
            layout.drop_replaced(spark, args.out)
        return [args.out]
    written = []
    for name, table, order in JOBS[args.job](inputs):
        written.append(sinks.stamped(args.out.rstrip("/"), name))
        small = order is not None
        sinks.write_csv(table, written[-1], single_file=small, order=order or ())
        if args.preview:
            table.printSchema()
            result = spark.read.csv(written[-1], header=True, schema=table.schema)
            result.show(truncate=False)
    return written


def main() -> None:
    args = arguments()
    spark = session(f"tripstats {args.job}")
    try:
        for path in run(spark, args):
            print(path)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
