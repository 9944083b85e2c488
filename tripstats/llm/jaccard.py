"""N-gram Jaccard self-join with Bayesian candidate pruning."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstats.llm.arrays import U64, mix, text_slices, windows, words
from tripstats.llm.groups import BLOCK, components, tiled, whole_groups, written

SHINGLE = 5
THRESHOLD = 0.8
TOLERANCE = 1e-6
BANDS, ROWS = 32, 4
VALUES = BANDS * ROWS
STEP = 16
#: Text looked at together; a byte takes some 20 bytes on the way.
SLICE_BYTES = 1 << 20
MILLION = 1_000_000

SKETCH = "doc_id long, text_hash long, n_shingles int, set_a long, set_b long, sketch binary"
SKETCH_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("text_hash", pa.int64()),
        ("n_shingles", pa.int32()),
        ("set_a", pa.int64()),
        ("set_b", pa.int64()),
        ("sketch", pa.binary()),
    ]
)


def shingles(texts: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(row, 64-bit hash) of the distinct shingles of every text, in order.

    A shingle is ``size`` consecutive words; a text of fewer words, but at least one, is a
    shingle itself; a text without words has none.
    """
    found = words(texts)
    place, value = windows(found, size)
    doc = found.doc[place]
    count = np.diff(found.first)
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):
        whole = np.zeros(len(short), U64)
        for k in range(size - 1):
            more = count[short] > k
            at = found.first[short[more]] + k
            whole[more] = whole[more] * U64(0xC2B2AE3D27D4EB4F) + found.hash[at]
        doc, value = np.r_[doc, short], np.r_[value, mix(whole, 3)]
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    return doc[new], value[new]


@cache
def _factors() -> np.ndarray:
    return mix(np.arange(VALUES), seed=29) | U64(1)


def minhashes(value: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """16 bits of each of VALUES MinHash values of the sets that begin at ``starts``."""
    out = np.empty((len(starts), VALUES), np.uint16)
    for k, factor in enumerate(_factors()):
        low = np.minimum.reduceat(value * factor, starts)
        out[:, k] = (mix(low, k) >> U64(48)).astype(np.uint16)
    return out


def _sketches(docs: DataFrame, size: int) -> DataFrame:
    """Set digest and MinHash sketch of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, max_bytes=SLICE_BYTES):
            doc, value = shingles(part["text"], size)
            n = part.num_rows
            count = np.bincount(doc, minlength=n).astype(np.int32)
            sums = np.zeros((2, n), U64)
            sketch = [None] * n
            if len(doc):
                full = np.flatnonzero(count)
                starts = np.r_[0, np.cumsum(count[full])[:-1]]
                for k in range(2):
                    sums[k, full] = np.add.reduceat(mix(value, 40 + k), starts)
                for i, row in zip(full, minhashes(value, starts)):
                    sketch[i] = row.tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    part["doc_id"],
                    part["text_hash"],
                    pa.array(count),
                    pa.array(sums[0].view(np.int64)),
                    pa.array(sums[1].view(np.int64)),
                    pa.array(sketch, pa.binary()),
                ],
                schema=SKETCH_ARROW,
            )

    return docs.mapInArrow(run, SKETCH)


def matches_needed(threshold: float, tolerance: float) -> list[int]:
    """For STEP, 2 * STEP, ... compared values, the least number of equal ones to go on with.

    With a uniform prior and m of n values equal, the similarity is Beta(m + 1, n - m + 1)
    distributed. Its mass above the threshold is the chance of at most m successes in
    n + 1 draws. Fewer matches leave less than the tolerance.
    """
    needed = []
    for n in range(STEP, VALUES + 1, STEP):
        mass, m = 0.0, -1
        while mass < tolerance:
            m += 1
            mass += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        needed.append(m)
    return needed


def _likely(left: np.ndarray, right: np.ndarray, needed: list[int]) -> np.ndarray:
    """Places of the pairs of sketches that no step drops; left may be one sketch."""
    alive = np.arange(len(right))
    equal = np.zeros(len(right), np.int16)
    one = left.ndim == 1
    for step, least in enumerate(needed):
        cut = slice(step * STEP, (step + 1) * STEP)
        mine = left[cut] if one else left[alive, cut]
        equal = equal + (mine == right[alive, cut]).sum(1, dtype=np.int16)
        stay = equal >= least
        alive, equal = alive[stay], equal[stay]
        if not len(alive):
            break
    return alive


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, np.uint16).reshape(-1, VALUES)


def _join_labels(sketch: np.ndarray, needed: list[int]) -> np.ndarray:
    """A label per row; rows that likely pairs connect share one. Pairs inside a label are
    not compared again, so a tight group costs about one comparison per row."""
    label = np.arange(len(sketch))
    for i in range(len(sketch) - 1):
        apart = i + 1 + np.flatnonzero(label[i + 1 :] != label[i])
        if len(apart):
            hit = apart[_likely(sketch[i], sketch[apart], needed)]
            if len(hit):
                label[np.isin(label, label[hit])] = label[i]
    return label


SMALL_CELL = 12


def _likely_edges(cells: DataFrame, needed: list[int]) -> DataFrame:
    """Edges that connect, within each cell, all rows that likely pairs connect."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, cuts in whole_groups(batches, ["cell", "tile_i", "tile_j"]):
            rep = table["rep"].to_numpy()
            sketch = _matrix(table["sketch"])
            sizes = np.diff(cuts)
            end = np.repeat(cuts[1:], sizes)
            small = np.repeat(sizes <= SMALL_CELL, sizes)
            pairs = []
            for lag in range(1, SMALL_CELL):
                i = np.flatnonzero(small & (np.arange(len(rep)) + lag < end))
                if not len(i):
                    break
                i = i[_likely(sketch[i], sketch[i + lag], needed)]
                pairs.append((rep[i], rep[i + lag]))
            for k in np.flatnonzero(sizes > SMALL_CELL):
                own = slice(cuts[k], cuts[k + 1])
                label = _join_labels(sketch[own], needed)
                moved = label != np.arange(len(label))
                pairs.append((rep[own][moved], rep[own][label[moved]]))
            if pairs:
                a, b = (np.concatenate(x) for x in zip(*pairs))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return cells.mapInArrow(run, "a long, b long")


def _with_shingles(docs: DataFrame, size: int) -> DataFrame:
    """The same rows with the sorted distinct shingles instead of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, max_bytes=SLICE_BYTES):
            doc, value = shingles(part["text"], size)
            ends = np.cumsum(np.bincount(doc, minlength=part.num_rows)) * 8
            raw = value.tobytes()
            sets = [raw[a:b] for a, b in zip([0, *ends], ends)]
            at = part.schema.get_field_index("text")
            yield part.set_column(at, "shingles", pa.array(sets, pa.binary()))

    schema = ", ".join(
        f"{n} {t}" if n != "text" else "shingles binary" for n, t in docs.dtypes
    )
    return docs.mapInArrow(run, schema)


def _verified(table: pa.Table, needed: list[int], threshold: float):
    """(rep, members, links, root) of one tile: exact Jaccard of every likely pair."""
    _, once = np.unique(table["rep"].to_numpy(), return_index=True)
    if len(once) < table.num_rows:  # rows with the same doc_id and text
        table = table.take(once)
    rep = table["rep"].to_numpy()
    copies = table["copies"].to_numpy()
    block = table["block"].to_numpy()
    across = table["tile_i"][0].as_py() != table["tile_j"][0].as_py()
    sketch = _matrix(table["sketch"])
    raw = table["shingles"].to_pylist()
    size = np.array([len(x) // 8 for x in raw])
    starts = np.r_[0, np.cumsum(size)]
    known, element = np.unique(np.frombuffer(b"".join(raw), np.uint64), return_inverse=True)
    mine = np.zeros(len(known), bool)
    links, label = np.zeros(len(rep), np.int64), np.arange(len(rep))
    wanted = round(threshold * MILLION)
    for i in range(len(rep) - 1):
        rest = np.arange(i + 1, len(rep))
        if across:
            rest = rest[block[rest] != block[i]]
        rest = rest[_likely(sketch[i], sketch[rest], needed)]
        if not len(rest):
            continue
        mine[element[starts[i] : starts[i + 1]]] = True
        if len(rest) < 32:
            common = np.array([mine[element[starts[j] : starts[j + 1]]].sum() for j in rest])
        else:
            common = np.add.reduceat(mine[element], starts[:-1], dtype=np.int64)[rest]
        mine[element[starts[i] : starts[i + 1]]] = False
        either = size[i] + size[rest] - common
        linked = rest[common * MILLION >= wanted * either]
        links[i] += copies[linked].sum()
        links[linked] += copies[i]
        if len(linked):
            joined = np.isin(label, label[np.r_[i, linked]])
            label[joined] = label[joined].min()
    least = np.full(len(rep), np.iinfo(np.int64).max)
    np.minimum.at(least, label, rep)
    return rep, table["members"].to_numpy(), links, least[label]


def _links(tiles: DataFrame, needed: list[int], threshold: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, cuts in whole_groups(batches, ["cluster", "tile_i", "tile_j"]):
            parts = [
                _verified(table.slice(a, b - a), needed, threshold)
                for a, b in zip(cuts[:-1], cuts[1:])
            ]
            columns = [pa.array(np.concatenate(x)) for x in zip(*parts)]
            yield pa.RecordBatch.from_arrays(columns, names=["rep", "members", "links", "root"])

    return tiles.mapInArrow(run, "rep long, members long, links long, root long")


def near_duplicates(
    docs: DataFrame,
    size: int = SHINGLE,
    threshold: float = THRESHOLD,
    tolerance: float = TOLERANCE,
    block: int = BLOCK,
) -> DataFrame:
    """Every document with its class of near duplicates and its number of links.

    Two documents are linked when the Jaccard similarity of their shingle sets (``size``
    words) is at least ``threshold``; a class is what links connect. Steps:

    1. Documents with equal shingle sets have one representative; the rest joins those.
    2. Representatives that share one of 32 bands of 4 MinHash values meet (a pair at 0.8
       misses all bands with probability 5e-8). MinHash values are compared 16 at a time, and a
       pair is dropped as soon as its posterior chance of reaching the threshold is below
       ``tolerance``. What is left connects representatives into clusters.
    3. Inside a cluster all pairs go through the same pruning and the rest is verified on
       the whole shingle sets. Pairs are counted, never written.

    Cells and clusters above ``block`` rows are cut into tiles. Sketches, representatives
    and edges are written tables. Returns doc_id, class_id (the least doc_id of the class),
    n_links (documents linked to this one, copies included), n_shingles, representative (the
    least doc_id with the same set), text_hash (xxhash64 of the text, which with doc_id tells rows
    apart) and stays (true for one row of each class, one with the least doc_id). A row per
    input row. A text of one to four words is one shingle; without words, or with a null
    doc_id, a row has no links, is its own class and stays. Rows that share a doc_id are
    documents of their own: their class is that of their text. An empty table gives no rows.
    Other columns are not read. A slice of texts, or one text above its bound, takes some 40
    bytes a word on the way.
    """
    needed = matches_needed(threshold, tolerance)
    text_hash = F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash, "text")
    sketched = _sketches(docs, size).withColumn("row", F.monotonically_increasing_id())
    sketched = written(sketched, "sketches")
    same_set = ["set_a", "set_b", "n_shingles"]
    usable = sketched.filter("doc_id is not null and n_shingles > 0")
    reps = usable.groupBy(*same_set, "sketch").agg(
        F.min(F.struct("doc_id", "row", "text_hash")).alias("least"),
        F.count(F.lit(1)).alias("copies"),
    )
    reps = reps.select(
        *same_set,
        "sketch",
        "copies",
        F.col("least.row").alias("rep"),
        F.col("least.doc_id").alias("rep_id"),
        F.col("least.text_hash").alias("rep_hash"),
    )
    reps = written(reps, "representatives")

    cell = F.expr(
        f"explode(transform(sequence(0, {BANDS - 1}), "
        f"i -> xxhash64(i, substring(sketch, {2 * ROWS} * i + 1, {2 * ROWS}))))"
    )
    bands = reps.select("rep", cell.alias("cell"))
    shared = bands.groupBy("cell").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    met = bands.join(shared, "cell").join(reps.select("rep", "sketch"), "rep")
    cells = tiled(met, "cell", "members", "rep", block)
    clusters = components(_likely_edges(cells, needed)).toDF("rep", "cluster")

    sizes = clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("members"))
    active = (
        reps.select("rep", "rep_id", "rep_hash", "copies", "sketch")
        .join(clusters, "rep")
        .join(sizes, "cluster")
    )
    texts = docs.toDF("rep_id", "rep_hash", "text").join(active, ["rep_id", "rep_hash"])
    texts = texts.drop("rep_id", "rep_hash")
    tiles = tiled(_with_shingles(texts, size), "cluster", "members", "rep", block)
    links = written(_links(tiles, needed, threshold), "links")

    counted = links.groupBy("rep").agg(F.sum("links").alias("links"))
    roots = links.filter(F.col("members") <= block).select(F.col("rep").alias("node"), F.col("root").alias("label"))
    many = components(links.filter(F.col("members") > block).select(F.col("rep").alias("a"), F.col("root").alias("b")))
    classes = roots.union(many).groupBy("node").agg(F.min("label").alias("label"))
    known = (
        reps.drop("sketch", "rep_hash")
        .join(counted, "rep", "left")
        .join(classes, F.col("rep") == F.col("node"), "left")
        .select(
            *same_set,
            "rep",
            F.col("rep_id").alias("representative"),
            F.coalesce("label", "rep").alias("label"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        )
    )
    known = written(known, "classes")
    least = known.groupBy("label").agg(F.min(F.struct("representative", "rep")).alias("least"))
    known = known.join(written(least, "least"), "label")
    joined = sketched.drop("sketch").join(known, same_set, "left")
    usable_row = F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)

    def if_usable(value, otherwise):
        return F.when(usable_row, value).otherwise(otherwise)

    own = F.col("doc_id")
    return joined.select(
        "doc_id",
        if_usable(F.col("least.representative"), own).alias("class_id"),
        if_usable(F.col("n_links"), F.lit(0)).cast("long").alias("n_links"),
        F.col("n_shingles").cast("long").alias("n_shingles"),
        if_usable(F.col("representative"), own).alias("representative"),
        "text_hash",
        if_usable(F.col("least.rep") == F.col("row"), F.lit(True)).alias("stays"),
    )


def without_near_duplicates(docs: DataFrame, **how) -> DataFrame:
    """The rows of docs of which near_duplicates says that they stay, with all their columns.

    Rows that go are named by doc_id and text_hash; rows that also share their text with one
    that stays stay with it.
    """
    classes = near_duplicates(docs, **how)
    names = ["doc_id", "text_hash"]
    kept = classes.filter("stays").select(*names)
    gone = classes.filter("not stays").select(*names).join(kept, names, "left_anti").distinct()
    text_hash = F.xxhash64(F.coalesce("text", F.lit("")))
    same = [F.col("doc_id").cast("long") == F.col("gone_id"), text_hash == F.col("gone_hash")]
    return docs.join(gone.toDF("gone_id", "gone_hash"), same, "left_anti")
