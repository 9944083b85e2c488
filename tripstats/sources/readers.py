"""Reading trip files and the zone lookup."""

from __future__ import annotations

import csv
import re
from collections import Counter, defaultdict
from collections.abc import Mapping, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripstats.functions.columns import location_key
from tripstats.model import GREEN, LOCATION_IDS, TRIP_TYPES, YELLOW, ZONE_SCHEMA, Fleet

_KNOWN = {name.lower(): name for name in TRIP_TYPES}


def read_csv_inferred(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Many CSV files as one table with inferred types.

    Inference reads every file once more, so it suits first looks and small
    files; ``read_trip_csv`` is the one for large data.
    """
    return spark.read.csv(list(paths), header=True, inferSchema=True)


def csv_header(spark: SparkSession, path: str) -> tuple[str, ...]:
    """Column names of a CSV path; Spark reads one line for it."""
    return tuple(spark.read.csv(path, header=True).columns)


def header_names(line: str) -> tuple[str, ...]:
    """The names in a header line, as Spark's CSV reader gives them: an empty name is ``_c`` and
    its place, and names that differ at most in case get their place added."""
    names = next(csv.reader([line], escapechar="\\", doublequote=False))
    times = Counter(name.lower() for name in names)
    return tuple(
        f"_c{i}" if not name else f"{name}{i}" if times[name.lower()] > 1 else name
        for i, name in enumerate(names)
    )


def header_schema(header: Sequence[str]) -> T.StructType:
    """A schema in the order of a header: known columns typed, the others text."""
    return T.StructType(
        [
            T.StructField(name, TRIP_TYPES.get(_KNOWN.get(name.lower()), T.StringType()))
            for name in header
        ]
    )


def _first_lines(spark: SparkSession, lines: DataFrame) -> list:
    """The first line of every file of a text scan, in one job.

    Every file is one task, which ends after the first rows it gets, so a file of any size
    costs as much as a small one.
    """

    def first(batches):
        for batch in batches:
            for i, value in enumerate(batch["value"]):
                if value.as_py().strip():
                    yield batch.slice(i, 1)
                    return

    sizes = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {key: spark.conf.get(key) for key in sizes}
    try:
        for key in sizes:
            spark.conf.set(key, str(1 << 50))
        rows = lines.mapInArrow(first, lines.schema)
        return rows.filter("file_block_start = 0").select("file_path", "value").collect()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def headers_of(
    spark: SparkSession, paths: Sequence[str]
) -> dict[tuple[str, ...], list[str]]:
    """The files under all paths by header, found in one job; files without a line are left
    out."""
    columns = ["_metadata.file_path", "_metadata.file_block_start", "value"]
    lines = spark.read.text(list(paths)).select(*columns)
    found = {row.file_path: row.value for row in _first_lines(spark, lines)}
    layouts: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for line in dict.fromkeys(found.values()):
        files = sorted(file for file, own in found.items() if own == line)
        layouts[header_names(line)] += [_as_path(file) for file in files]
    return dict(layouts)


def _as_path(uri: str) -> str:
    """A file's URI as a path for a reader, in which it stands for itself alone."""
    return re.sub(r"([][{}*?\\])", r"\\\1", unquote(uri))


def read_trip_csv(
    spark: SparkSession,
    paths: Sequence[str] = (),
    layouts: Mapping[tuple[str, ...], Sequence[str]] | None = None,
    keep_corrupt: bool = False,
) -> DataFrame:
    """Many trip CSV paths as one typed table, without an inference pass.

    Files are grouped by header, each group is read with a schema in its own
    column order, and the groups are united by name. Headers that differ in
    order, in case or by a column therefore line up, also inside one path.

    ``layouts`` declares the groups (header to paths), and no job runs before the table is
    read; Spark checks the headers of their files and fails on a difference. Otherwise one
    job, ``headers_of``, looks at the first line of every file. A value that is not of its
    column's type is NULL; ``keep_corrupt`` adds the column ``_corrupt_record`` with the
    whole line of such rows.
    """
    tables = []
    layouts = layouts or headers_of(spark, paths)
    if not layouts:
        raise ValueError("no file has a header")
    for header, members in layouts.items():
        schema = header_schema(header)
        if keep_corrupt:
            schema = schema.add("_corrupt_record", T.StringType())
        table = spark.read.csv(
            list(members), header=True, schema=schema, enforceSchema=False
        )
        header = schema.names
        tables.append(table.toDF(*[_KNOWN.get(name.lower(), name) for name in header]))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """The zone lookup, with its fixed schema."""
    return spark.read.csv(path, header=True, schema=ZONE_SCHEMA, enforceSchema=False)


def normalise(df: DataFrame, fleet: Fleet) -> DataFrame:
    """Common timestamp names, integer location ids, and the fleet as a column."""
    df = df.withColumnsRenamed(
        {fleet.pickup_column: "pickup_ts", fleet.dropoff_column: "dropoff_ts"}
    )
    ids = [name for name in LOCATION_IDS if name in df.columns]
    df = df.withColumns({name: location_key(df, name) for name in ids})
    if "taxi_type" not in df.columns:
        df = df.withColumn("taxi_type", F.lit(fleet.tag))
    return df


def with_fleet_names(df: DataFrame, fleet: Fleet) -> DataFrame:
    """Common timestamp names back to those of the fleet."""
    return df.withColumnsRenamed(
        {"pickup_ts": fleet.pickup_column, "dropoff_ts": fleet.dropoff_column}
    )


def unite_fleets(yellow: DataFrame, green: DataFrame) -> DataFrame:
    """Both fleets as one table; a column only one fleet has is NULL for the other."""
    return normalise(yellow, YELLOW).unionByName(
        normalise(green, GREEN), allowMissingColumns=True
    )
