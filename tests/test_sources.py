"""Files in and out: header drift, layout, single files, workspace, command line."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from frames import rows, trips
from tripstats import __main__ as cli
from tripstats.model import GREEN, YELLOW
from tripstats.operators import predicates
from tripstats.sources import layout, readers, sinks, workspace

YELLOW_CSV = """taxi_type,tpep_pickup_datetime,tpep_dropoff_datetime,PULocationID,DOLocationID,trip_distance,fare_amount,passenger_count,airport_fee,tip
yellow_taxi,2023-07-02 10:00:00,2023-07-02 10:10:00,1,2,2.0,10.0,1.0,1.25,0.5
yellow_taxi,2023-07-03 10:00:00,2023-07-03 11:10:00,1,1,0.0,7.0,2.0,0.0,
yellow_taxi,not a time,2023-07-03 11:10:00,1,1,0.5,7.0,2.0,0.0,
yellow_taxi,2023-07-03 12:00:00,2023-07-03 12:10:00,3,2.0,1.0,-7.0,,1.75,
"""
# The columns of the next month swap places and one is spelled otherwise.
DRIFTED_CSV = """tpep_pickup_datetime,taxi_type,tpep_dropoff_datetime,DOLocationID,PULocationID,fare_amount,trip_distance,passenger_count,Airport_fee
2023-07-04 09:00:00,yellow_taxi,2023-07-04 09:30:00,2,1,20.0,4.0,1.0,1.75
"""
GREEN_CSV = """taxi_type,lpep_pickup_datetime,lpep_dropoff_datetime,PULocationID,DOLocationID,trip_distance,fare_amount,passenger_count
green_taxi,2023-07-02 10:00:00,2023-07-02 10:10:00,2,2,2.0,10.0,1.0
green_taxi,2023-06-02 10:00:00,2023-06-02 10:10:00,2,1,2.0,10.0,
"""
ZONES_CSV = """LocationID,Borough,Zone,service_zone
1,Queens,Astoria,Boro Zone
2,Bronx,Norwood,Boro Zone
"""


@pytest.fixture
def files(tmp_path):
    paths = {}
    for name, body in {
        "yellow": YELLOW_CSV, "drifted": DRIFTED_CSV, "green": GREEN_CSV, "zones": ZONES_CSV
    }.items():
        path = tmp_path / f"{name}.csv"
        path.write_text(body)
        paths[name] = str(path)
    paths["out"] = str(tmp_path / "out")
    return paths


def test_header_drift_is_realigned(any_ansi, files):
    df = readers.normalise(
        readers.read_trip_csv(any_ansi, [files["yellow"], files["drifted"]]), YELLOW
    )
    assert df.count() == 5
    assert rows(df.filter("fare_amount = -7.0").select("DOLocationID")) == [(2,)]
    late = df.filter(F.col("pickup_ts") == F.lit("2023-07-04 09:00:00").cast("timestamp"))
    assert rows(
        late.select("PULocationID", "DOLocationID", "trip_distance", "fare_amount", "airport_fee", "tip")
    ) == [(1, 2, 4.0, 20.0, 1.75, None)]
    assert dict(df.dtypes)["tip"] == "string"


def test_drift_inside_one_path_is_realigned(spark, tmp_path):
    folder = tmp_path / "mixed [1] 100% a+b"
    folder.mkdir()
    (folder / "a {x}.csv").write_text(YELLOW_CSV)
    (folder / "b*.csv").write_text(DRIFTED_CSV)
    (folder / "empty.csv").write_text("")
    escaped = str(folder).replace("[", "\\[").replace("]", "\\]")
    df = readers.read_trip_csv(spark, [escaped])
    assert df.count() == 5
    assert rows(df.filter("fare_amount = 20.0").select("PULocationID", "DOLocationID", "trip_distance")) == [("1", "2", 4.0)]


def _jobs_of(spark, group, action):
    spark.sparkContext.setJobGroup(group, group)
    try:
        return action(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_headers_of_many_paths_take_one_job(spark, tmp_path):
    paths = []
    for i in range(50):
        path = tmp_path / f"month-{i}.csv"
        path.write_text([YELLOW_CSV, DRIFTED_CSV][i % 2] + "x," * 5)
        paths.append(str(path))
    sizes = [spark.conf.get(f"spark.sql.files.{x}") for x in ("maxPartitionBytes", "openCostInBytes")]
    # beside the one listing job that Spark runs for more than 32 paths
    found, n = _jobs_of(spark, "headers", lambda: readers.headers_of(spark, paths))
    assert n <= 2 and sorted(map(len, found.values())) == [25, 25]
    found, n = _jobs_of(spark, "few-headers", lambda: readers.headers_of(spark, paths[:20]))
    assert n == 1 and sum(map(len, found.values())) == 20
    assert sizes == [spark.conf.get(f"spark.sql.files.{x}") for x in ("maxPartitionBytes", "openCostInBytes")]
    for header in found:
        assert header in [tuple(x.splitlines()[0].split(",")) for x in (YELLOW_CSV, DRIFTED_CSV)]


@pytest.mark.parametrize("line", ["a,b", '"a b","c,d"', "a,,b", "A,a,c", '"x\\"y",z', "one"])
def test_header_names_are_those_of_the_reader(spark, tmp_path, line):
    path = tmp_path / "h.csv"
    path.write_text(line + "\n")
    assert readers.header_names(line) == readers.csv_header(spark, str(path))
    assert list(readers.headers_of(spark, [str(path)])) == [readers.header_names(line)]


def test_no_header_at_all(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    with pytest.raises(ValueError, match="no file has a header"):
        readers.read_trip_csv(spark, [str(tmp_path)])


def test_unreadable_time_is_null_and_drops(any_ansi, files):
    df = readers.normalise(readers.read_trip_csv(any_ansi, [files["yellow"]]), YELLOW)
    assert df.filter(F.col("pickup_ts").isNull()).count() == 1


def test_fleets_unite_by_name(any_ansi, files):
    both = readers.unite_fleets(
        readers.read_trip_csv(any_ansi, [files["yellow"]]),
        readers.read_trip_csv(any_ansi, [files["green"]]),
    )
    assert both.filter(F.col("taxi_type") == GREEN.tag).select("airport_fee").distinct().collect()[0][0] is None
    assert {"pickup_ts", "dropoff_ts"} <= set(both.columns)
    assert both.count() == 6


def test_missing_fleet_tag_is_added(spark, files):
    plain = readers.read_trip_csv(spark, [files["green"]]).drop("taxi_type")
    assert rows(readers.normalise(plain, GREEN).select("taxi_type").distinct()) == [("green_taxi",)]


def test_inferred_types(spark, files):
    df = readers.read_csv_inferred(spark, [files["green"]])
    assert dict(df.dtypes)["lpep_pickup_datetime"] == "timestamp"
    assert dict(df.dtypes)["PULocationID"] == "int"


def test_trip_table_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "table")
    df = trips(
        spark,
        *[{"pickup_ts": f"2023-0{m}-05 10:00:00"} for m in range(1, 8)],
        {"pickup_ts": "2023-03-05 10:00:00", "taxi_type": "green_taxi"},
    )
    layout.write_trip_table(df, path, "first")
    march = ("2023-03-01 00:00:00", "2023-03-31 23:59:59")
    own = layout.read_trip_table(spark, path, *march, YELLOW)
    # a month on either side of the period
    assert rows(own.select("pickup_month").orderBy("pickup_month")) == [("2023-02",), ("2023-03",), ("2023-04",)]
    plan = own._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(pickup_month" in plan
    assert dict(own.dtypes)["pickup_month"] == "string"
    assert layout.read_trip_table(spark, path).drop("pickup_month").count() == df.count()


def test_loads_leave_each_other_alone(spark, tmp_path):
    path = str(tmp_path / "table")
    may = trips(spark, {"pickup_ts": "2024-05-05 10:00:00"}, {"pickup_ts": "2024-05-06 10:00:00"})
    # a stray trip of May in the file of July
    july = trips(spark, *[{"pickup_ts": f"2023-07-0{d} 10:00:00"} for d in (1, 2)], {"pickup_ts": "2024-05-07 10:00:00"})
    layout.write_trip_table(may, path, "2024-05")
    layout.write_trip_table(july, path, "2023-07")
    assert layout.read_trip_table(spark, path).count() == 5
    layout.write_trip_table(july, path, "2023-07")
    table = layout.read_trip_table(spark, path)
    assert table.count() == 5 and table.filter("pickup_month = '2024-05'").count() == 3
    assert "load" not in table.columns
    with pytest.raises(ValueError, match="a load is named"):
        layout.write_trip_table(may, path, "a/b")


@pytest.mark.parametrize("stage", ["reading", "writing"])
def test_a_failed_reload_leaves_the_rows_before_it(spark, tmp_path, stage):
    path, mode = str(tmp_path / "table"), "spark.sql.parquet.int96RebaseModeInWrite"
    good = trips(spark, *[{"pickup_ts": f"2023-07-0{d} 10:00:00"} for d in (1, 2, 3)])
    layout.write_trip_table(good, path, "july")
    bad = trips(spark, {"pickup_ts": "1001-01-01 10:00:00"}, {"pickup_ts": "2023-07-02 10:00:00"})
    if stage == "reading":
        bad = bad.withColumn("fare_amount", F.raise_error(F.lit("lost")).cast("double"))
    before = spark.conf.get(mode)
    try:
        spark.conf.set(mode, "EXCEPTION")  # Parquet's writer refuses the old date
        with pytest.raises(Exception):
            layout.write_trip_table(bad, path, "july")
    finally:
        spark.conf.set(mode, before)
    assert layout.read_trip_table(spark, path).count() == 3
    assert layout.drop_replaced(spark, path) == []
    layout.write_trip_table(good.limit(1), path, "july")
    assert layout.read_trip_table(spark, path).count() == 1


def test_replaced_versions_stay_until_dropped(spark, tmp_path):
    path = str(tmp_path / "table")
    day = lambda d: trips(spark, {"pickup_ts": f"2023-07-0{d} 10:00:00"})
    layout.write_trip_table(day(1), path, "a")
    layout.write_trip_table(day(2), path, "b")
    reading = layout.read_trip_table(spark, path)
    first = layout.current_loads(spark, path)
    layout.write_trip_table(day(3), path, "a")
    assert reading.count() == 2 and layout.read_trip_table(spark, path).count() == 2
    assert layout.drop_replaced(spark, path) == [layout._folder(path, "a", first["a"])]
    assert layout.drop_replaced(spark, path) == []
    assert rows(layout.read_trip_table(spark, path).selectExpr("day(pickup_ts) d").orderBy("d")) == [(2,), (3,)]
    with pytest.raises(ValueError, match="no load was finished"):
        layout.read_trip_table(spark, str(tmp_path / "none"))


def test_pruning_loses_no_row(spark, tmp_path):
    path, zone = str(tmp_path / "table"), spark.conf.get("spark.sql.session.timeZone")
    times = ["2023-06-30 23:30:00", "2023-07-01 00:30:00", "2023-07-31 23:30:00", "2023-08-01 02:00:00"]
    layout.write_trip_table(trips(spark, *[{"pickup_ts": t} for t in times]), path, "x")

    def within(start, end):
        return predicates.time_range(layout.read_trip_table(spark, path, start, end), "pickup_ts", start, end).count()

    assert within("2023-7-1 00:00:00", "2023-8-1 00:00:00") == 2
    assert within("2023-7-1", None) == 3 and within(None, "2023-07-02") == 2
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        # four hours later than in UTC, where the folders were named
        assert within("2023-07-01 00:00:00", "2023-08-01 00:00:00") == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_declared_layouts_need_no_job_per_path(spark, files):
    """Fifty paths cost Spark's one listing job at most, and no look at a header."""
    header = tuple(YELLOW_CSV.splitlines()[0].split(","))
    group = "declared-layouts"
    spark.sparkContext.setJobGroup(group, group)
    try:
        df = readers.read_trip_csv(spark, layouts={header: [files["yellow"]] * 50})
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) <= 1
        assert df.count() == 200
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    with pytest.raises(Exception, match="CSV header"):
        readers.read_trip_csv(spark, layouts={header: [files["drifted"]]}).collect()


def test_corrupt_values_can_be_kept(spark, files, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text(YELLOW_CSV.replace("2.0,10.0", "2.0,1x5"))
    df = readers.read_trip_csv(spark, [str(path)], keep_corrupt=True).cache()
    bad = df.filter("_corrupt_record is not null")
    assert {"1x5" in r._corrupt_record for r in bad.collect()} == {True, False}  # and the unreadable time
    assert "_corrupt_record" not in readers.read_trip_csv(spark, [str(path)]).columns
    df.unpersist()


def test_hot_partition_is_written_by_many_tasks(spark, tmp_path):
    """Adaptive execution splits a partition that is larger than it advises."""
    path = str(tmp_path / "table")
    df = spark.range(0, 400_000, numPartitions=8).select(
        F.lit("yellow_taxi").alias("taxi_type"),
        F.lit("2023-03-05 10:00:00").cast("timestamp").alias("pickup_ts"),
        F.rand(1).alias("fare_amount"),
    )
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "1MB")
        layout.write_trip_table(df, path, "x")
    finally:
        spark.conf.set(key, before)
    assert len(glob.glob(f"{path}/trips/**/*.parquet", recursive=True)) > 2
    assert layout.read_trip_table(spark, path).count() == 400_000


def test_single_file(spark, tmp_path):
    path = str(tmp_path / "one")
    sinks.write_csv(spark.range(100, numPartitions=8), path, single_file=True)
    assert len(glob.glob(f"{path}/*.csv")) == 1
    ordered = str(tmp_path / "ordered")
    sinks.write_csv(spark.range(100, numPartitions=8), ordered, single_file=True, order=[F.desc("id")])
    assert [int(r.id) for r in spark.read.csv(ordered, header=True).collect()] == list(range(99, -1, -1))
    many = str(tmp_path / "many")
    sinks.write_csv(spark.range(100, numPartitions=8), many)
    assert len(glob.glob(f"{many}/*.csv")) == 8


def test_run_stamp_has_no_colon(spark):
    from datetime import datetime

    stamp = sinks.stamped("out", "t", datetime(2023, 12, 1, 9, 5, 7))
    assert stamp == "out/t_01-12-2023_09-05-07"


class _Session:
    """Stands for a session with given settings."""

    def __init__(self, master, folder=None, checkpoint=None):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = self
        self.master, self.applicationId = master, "app"
        self._checkpoint = checkpoint

    def getCheckpointDir(self):
        return self._checkpoint


def test_shared_folder_is_read_from_the_session():
    assert workspace.shared_folder(_Session("yarn", "hdfs://n/tmp/")) == "hdfs://n/tmp"
    assert workspace.shared_folder(_Session("yarn", checkpoint="hdfs://n/c")) == "hdfs://n/c"
    assert os.path.isdir(workspace.shared_folder(_Session("local[2]")))
    with pytest.raises(ValueError):
        workspace.shared_folder(_Session("yarn"))


def test_written_tables_can_be_dropped(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(workspace, "shared_folder", lambda spark: f"file://{tmp_path}")
    other = tmp_path / "tripstats" / "another-application" / "table"
    other.mkdir(parents=True)
    path = workspace.new_path(spark, "numbers")
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3
    assert workspace.drop_written(spark) and not workspace.drop_written(spark)
    assert os.listdir(tmp_path / "tripstats") == ["another-application"] and other.exists()


# ---- command line -----------------------------------------------------------


def run(spark, files, job, *more):
    args = cli.arguments(
        [
            job, "--yellow", files["yellow"], files["drifted"], "--green", files["green"],
            "--zones", files["zones"], "--out", files["out"], *more,
        ]
    )
    results = {}
    for path in cli.run(spark, args):
        name = os.path.basename(path).split("_")
        results["_".join(name[:-2])] = spark.read.csv(path, header=True)
    return results


def test_cli_borough_counts(spark, files):
    results = run(spark, files, "borough-counts")
    assert set(results) == {
        "boroughs_yellow_pickup", "boroughs_yellow_dropoff",
        "boroughs_green_pickup", "boroughs_green_dropoff",
    }
    assert results["boroughs_yellow_pickup"].columns == ["Pickup_Borough", "count"]
    assert rows(results["boroughs_yellow_pickup"]) == [("Queens", "3")]
    assert sorted(rows(results["boroughs_green_dropoff"])) == [("Bronx", "1"), ("Queens", "1")]


def test_cli_enrich_has_fleet_names(spark, files):
    results = run(spark, files, "enrich")
    assert "lpep_pickup_datetime" in results["enriched_green"].columns
    assert results["enriched_yellow"].count() == 4
    assert results["enriched_yellow"].filter("Pickup_Borough is null").count() == 1


@pytest.mark.parametrize("mode", ["typed", "compat"])
@pytest.mark.parametrize("job", [j for j in cli.JOBS if j not in ("enrich", "borough-counts")])
def test_cli_jobs_run(spark, files, job, mode):
    period = ["--start", "2023-07-01 00:00:00", "--end", "2023-07-31 23:59:59", "--mode", mode]
    for table in run(spark, files, job, *period).values():
        table.collect()


def test_cli_daily(spark, files):
    results = run(spark, files, "daily-with-mean", "--every-day")
    days = rows(results["daily_yellow"])
    assert len(days) == 31 and days[0] == ("2023-07-01", "0", "0.06451612903225806", "0.0")
    results = run(spark, files, "daily-with-mean")
    assert rows(results["daily_yellow"]) == [
        ("2023-07-02", "1", "0.06451612903225806", "0.0"),
        ("2023-07-04", "1", "0.06451612903225806", "0.0"),
    ]


def test_cli_labels(spark, files):
    year = ["--start", "2023-01-01 00:00:00", "--end", "2024-01-01 00:00:00"]
    months = run(spark, files, "busiest-month", *year)["busiest_month"]
    assert rows(months) == [("2023-06 (Green)", "1"), ("2023-07 (Yellow)", "3")]
    months = run(spark, files, "busiest-month", *year, "--year", "2023", "--months", "7")["busiest_month"]
    assert rows(months) == [("2023-06", "1"), ("July (Yellow)", "3")]
    merged = run(spark, files, "top-merged", "--listed", "Bronx")["top_merged"]
    assert rows(merged) == [("Bronx_Green", "2"), ("Queens", "3")]


def test_cli_names_all_months_of_a_year(spark, files):
    year = ["--start", "2023-01-01 00:00:00", "--end", "2024-01-01 00:00:00", "--year", "2023"]
    months = run(spark, files, "busiest-month", *year)["busiest_month"]
    assert rows(months) == [("July (Yellow)", "3"), ("June (Green)", "1")]


def test_cli_daily_of_every_fleet_with_the_fee(spark, files, tmp_path):
    results = run(spark, files, "anomalies", "--fee", "fare_amount", "--every-day", "--days", "10")
    assert set(results) == {"anomalies_yellow", "anomalies_green"}
    assert rows(results["anomalies_green"].filter("count > 0").select("lpep_pickup_datetime", "total", "flag")) == [("2023-07-02", "0.1", "high")]
    with pytest.raises(SystemExit, match="no trips with a column"):
        run(spark, files, "daily-with-mean", "--fee", "toll")


def test_cli_load_can_drop_what_it_replaced(spark, files, tmp_path):
    table = str(tmp_path / "table")
    for _ in range(2):
        cli.run(spark, cli.arguments(["load", "--green", files["green"], "--drop-replaced", "--out", table]))
    assert len(glob.glob(f"{table}/trips/load=all/version=*")) == 1


def test_cli_preview(spark, files, capsys):
    """The schema and the first rows of what was written."""
    run(spark, files, "share", "--preview")
    out = capsys.readouterr().out
    assert "|-- yellow_single_total: long" in out and "|-- green_total: long" in out
    assert "66.66666666666666" in out


def test_cli_same_header(spark, files):
    args = cli.arguments(["share", "--green", files["green"], files["green"], "--same-header", "--out", files["out"]])
    (path,) = cli.run(spark, args)
    assert rows(spark.read.csv(path, header=True))[0][0] == "4"


def test_cli_prunes_busiest_month(spark, files, tmp_path):
    table = str(tmp_path / "table")
    cli.run(spark, cli.arguments(["load", "--green", files["green"], "--load", "g", "--out", table]))
    args = cli.arguments(["busiest-month", "--table", table, "--start", "2023-01-01", "--end", "2023-02-01", "--out", files["out"]])
    inputs = cli.Inputs(spark, args)
    plan = inputs.all_trips((args.start, args.end))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("pickup_month") >= 2 and "PartitionFilters: [isnotnull(pickup_month" in plan


def test_cli_on_a_loaded_table(spark, files, tmp_path):
    table = str(tmp_path / "table")
    cli.run(spark, cli.arguments(
        ["load", "--yellow", files["yellow"], files["drifted"], "--green", files["green"], "--out", table]
    ))
    args = cli.arguments(["share", "--table", table, "--out", files["out"]])
    written = cli.run(spark, args)
    assert [rows(spark.read.csv(p, header=True)) for p in written] == [
        [("3", "2", "66.66666666666666")],
        [("2", "1", "50.0")],
    ]


def test_cli_asks_for_what_it_needs(spark, files):
    args = cli.arguments(["enrich", "--yellow", files["yellow"], "--out", files["out"]])
    with pytest.raises(SystemExit, match="--zones"):
        cli.run(spark, args)
