"""Whole groups from sorted partitions, groups cut into tiles, and connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstats.sources.workspace import new_path

BLOCK = 1024


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: computed once, its lineage cut."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parts_for(df: DataFrame, least: int, part_bytes: int) -> int:
    """How many parts to deal df to, at least ``least`` for each shuffle partition, so that one
    holds some ``part_bytes`` of its input files; at most 64 for each partition, as Spark's
    estimate of a size may be far too large."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return min(max(least * partitions, size // part_bytes), max(least, 64) * partitions)


def numbered(df: DataFrame, name: str) -> DataFrame:
    """df as a written table with ``number``: 0, 1, 2 and so on in the order of its partitions
    and of the rows in each.

    No task sees all rows: a row's place in its partition is written with it, and how many rows
    lie in the partitions before, a number for each partition, is added when it is read.
    """
    placed = df.withColumn("number", F.monotonically_increasing_id())  # partition, place in it
    table = written(placed, name)
    part, place = F.shiftright("number", 33), F.col("number").bitwiseAND((1 << 33) - 1)
    sizes = table.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()
    starts, total = [], 0
    for x in sorted(sizes):
        starts.append((x.part, total))
        total += x.n
    before = df.sparkSession.createDataFrame(starts, "part long, before long")
    rows = table.withColumn("part", part).join(F.broadcast(before), "part")
    return rows.select(*df.columns, (F.col("before") + place).alias("number"))


def tiled(members: DataFrame, group: str, size: str, member: str, block: int = BLOCK) -> DataFrame:
    """Rows of a group dealt to tiles so that every two rows of it meet in some tile.

    A group of up to ``block`` rows is one tile. A larger one is cut into blocks by a hash
    of the member; each pair of blocks is a tile. So a task holds about 2 * block
    rows however large the group, and a row is sent once per block of its own group.
    Adds block, tile_i and tile_j.
    """
    blocks = F.ceil(F.col(size) / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64(F.col(member)), blocks).cast("int")
    return (
        members.withColumn("block", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .withColumn("tile_i", F.least("block", "other"))
        .withColumn("tile_j", F.greatest("block", "other"))
        .drop("other")
        .repartition(group, "tile_i", "tile_j")
        .sortWithinPartitions(group, "tile_i", "tile_j")
    )


def whole_groups(
    batches: Iterator[pa.RecordBatch], keys: list[str]
) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """(rows, where each group starts and the end) of batches sorted by integer keys.

    Each table holds whole groups: the last group of a batch waits for the next.
    """
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        cuts = _cuts(table, keys)
        if len(cuts) > 2:
            head = int(cuts[-2])
            yield table.slice(0, head).combine_chunks(), cuts[:-1]
            table = table.slice(head)
        rest = table
    if rest is not None and rest.num_rows:
        yield rest.combine_chunks(), _cuts(rest, keys)


def _cuts(table: pa.Table, keys: list[str]) -> np.ndarray:
    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for key in keys:
        value = table[key].to_numpy()
        new[1:] |= value[1:] != value[:-1]
    return np.r_[np.flatnonzero(new), table.num_rows]


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of edges (a, b); label is the least node it can reach.

    Large stars and small stars in turn: every neighbour is hung under the least one
    until nothing moves. The least neighbour is an aggregate, written as a table so that
    the join with it has exchanges of its own, which adaptive execution can split at a hot
    node; no neighbourhood is gathered. The edges of every round are a written table too.
    """
    least, greatest = F.least("a", "b"), F.greatest("a", "b")
    pairs = edges.select(greatest.alias("a"), least.alias("b")).filter("a > b").distinct()
    pairs = written(pairs, "edges")
    before = None
    while True:
        state = tuple(
            pairs.agg(F.count("a"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        )
        if state == before or not state[0]:
            return pairs.select(F.col("a").alias("node"), F.col("b").alias("label")).union(
                pairs.select("b", "b").distinct()
            )
        before = state
        pairs = written(_small_star(_large_star(pairs)), "edges")


def _large_star(pairs: DataFrame) -> DataFrame:
    """Hang each larger neighbour of a node under the least of the node and its neighbours."""
    both = pairs.union(pairs.select(F.col("b"), F.col("a"))).toDF("u", "v")
    low = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
    return both.filter("v > u").join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours under the least of them."""
    low = written(pairs.groupBy("a").agg(F.min("b").alias("m")), "least")
    moved = pairs.join(low, "a").select(F.col("b").alias("x"), F.col("m").alias("y"))
    return moved.filter("x > y").union(low).toDF("a", "b").distinct()
