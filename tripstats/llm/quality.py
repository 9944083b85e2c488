"""Quality rules with an isolation forest on their statistics."""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstats.llm.arrays import text_bytes, text_slices, windows, words
from tripstats.llm.groups import written

WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED = 30  # percent of words
TREES, TREE_ROWS = 100, 256
#: Most labelled rows that the forest is grown on; each tree draws TREE_ROWS of them.
FIT_ROWS = 8192
#: Share of good labelled rows that the threshold may reject at most.
MAX_LOSS = 0.01
BINS = 1000
SEED = 17

_SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_HAS_WORD = re.compile(r"[^\x20\x09-\x0D]")

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
# Shares of repeated lines and words are left to the base rules: in the forest they hide the
# others, as good documents repeat too (rows left out of calibration: 14 to 92 % of the bad ones
# caught with them, 98 % without).
FEATURES = ["chars_per_word", "symbols_per_word", "mark_share", "upper_share"]
SCHEMA = pa.schema(
    [("doc_id", pa.int64())]
    + [(x, pa.int64()) for x in COUNTS]
    + [("features", pa.list_(pa.float64()))]
)
SQL_SCHEMA = "doc_id long, " + ", ".join(f"{x} long" for x in COUNTS) + ", features array<double>"


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.r_[0, np.cumsum(flags, dtype=np.int64)]
    return total[offsets[1:]] - total[offsets[:-1]]


def _duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split("\n") if _HAS_WORD.search(x)]
    return len(lines) - len(set(lines))


def _repeated_words(found, n_texts: int) -> np.ndarray:
    """Words of each text inside a window of WINDOW words that the text has twice."""
    place, value = windows(found, WINDOW)
    doc = found.doc[place]
    order = np.lexsort((value, doc))
    same = np.zeros(len(order) + 1, bool)
    same[1:-1] = (doc[order][1:] == doc[order][:-1]) & (value[order][1:] == value[order][:-1])
    twice = place[order][same[1:] | same[:-1]]
    edge = np.zeros(len(found.hash) + 1, np.int64)
    np.add.at(edge, twice, 1)
    np.add.at(edge, twice + WINDOW, -1)
    covered = np.cumsum(edge)[: len(found.hash)] > 0
    return np.bincount(found.doc[covered], minlength=n_texts)


def statistics(docs: DataFrame) -> DataFrame:
    """The rule statistics of every document: doc_id, COUNTS and FEATURES as an array."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            texts, n = part["text"], part.num_rows
            data, offsets = text_bytes(texts)
            found = words(texts)
            n_words = np.diff(found.first)
            lead = (data & 0xC0) != 0x80  # first bytes of code points
            total = np.r_[0, np.cumsum(lead, dtype=np.int64)]
            chars = np.zeros(n, np.int64)
            np.add.at(chars, found.doc, total[found.end] - total[found.start])
            symbols = _per_text(_SYMBOLS[data], offsets)
            lines = [_duplicate_lines(x) for x in texts.to_pylist()]
            repeated = _repeated_words(found, n)
            per_word, per_char = np.maximum(n_words, 1), np.maximum(chars, 1)
            letter = (data >= 128) | ((data | 32) >= 97) & ((data | 32) <= 122)
            letter |= (data >= 48) & (data <= 57)  # or a digit
            marks = chars - _per_text(letter & lead, offsets)
            upper = _per_text((data >= 65) & (data <= 90), offsets)
            features = [chars / per_word, symbols / per_word, marks / per_char, upper / per_char]
            rows = list(np.stack(features, axis=1))
            columns = [n_words, chars, symbols, lines, repeated]
            yield pa.RecordBatch.from_arrays(
                [
                    part["doc_id"],
                    *(pa.array(x, pa.int64()) for x in columns),
                    pa.array(rows, SCHEMA.field("features").type),
                ],
                schema=SCHEMA,
            )

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInArrow(run, SQL_SCHEMA)


def _usual_depth(n: int) -> float:
    """Mean path length of an unsuccessful search in a binary tree of n rows."""
    return 2 * (log(n - 1) + 0.5772156649) - 2 * (n - 1) / n if n > 2 else float(n == 2)


def grow_tree(rows: np.ndarray, rng: np.random.Generator, depth: int) -> list[tuple]:
    """Nodes (feature, cut, left, right, length) of a tree of random splits; feature is -1
    at a leaf, where length is its depth and that of the tree its rows would still need."""
    nodes: list[tuple] = []

    def grow(own: np.ndarray, level: int) -> int:
        at = len(nodes)
        nodes.append(())
        low, high = own.min(0), own.max(0)
        free = np.flatnonzero(high > low)
        if level == depth or len(own) < 2 or not len(free):
            nodes[at] = (-1, 0.0, at, at, level + _usual_depth(len(own)))
            return at
        feature = rng.choice(free)
        cut = rng.uniform(low[feature], high[feature])
        left = own[:, feature] <= cut
        nodes[at] = (feature, cut, grow(own[left], level + 1), grow(own[~left], level + 1), 0.0)
        return at

    grow(rows, 0)
    return nodes


class Forest:
    """Isolation trees as arrays; ``scores`` is 2 ** (-mean path length / usual one)."""

    def __init__(self, rows: np.ndarray, trees: int, tree_rows: int, seed: int):
        rng = np.random.default_rng(seed)
        n = min(tree_rows, len(rows))
        self.usual = max(_usual_depth(n), 1.0)
        self.depth = int(np.ceil(np.log2(max(n, 2))))
        self.trees = []
        for _ in range(trees):
            own = rows[rng.choice(len(rows), n, replace=False)]
            nodes = grow_tree(own, rng, self.depth)
            self.trees.append(tuple(np.array(x) for x in zip(*nodes)))

    def scores(self, rows: np.ndarray) -> np.ndarray:
        total = np.zeros(len(rows))
        every = np.arange(len(rows))
        for feature, cut, left, right, length in self.trees:
            at = np.zeros(len(rows), np.int64)
            for _ in range(self.depth):
                f = feature[at]
                goes_left = rows[every, np.maximum(f, 0)] <= cut[at]
                at = np.where(goes_left, left[at], right[at])
            total += length[at]
        return 2.0 ** (-total / len(self.trees) / self.usual)


def fit_forest(
    labelled: DataFrame, trees: int, tree_rows: int, fit_rows: int, seed: int
) -> Forest | None:
    """A forest on at most ``fit_rows`` labelled rows, chosen by a hash of their id."""
    order = F.xxhash64(F.lit(seed), F.col("doc_id"))
    sample = labelled.orderBy(order, "doc_id").limit(fit_rows).select("features").toArrow()
    if not sample.num_rows:
        return None
    rows = np.array(sample["features"].to_pylist())
    return Forest(rows[np.lexsort(rows.T)], trees, tree_rows, seed)


def scored(stats: DataFrame, forest: Forest | None) -> DataFrame:
    """The statistics with the forest's anomaly score; 0 without a forest."""
    columns = [x for x in stats.columns if x != "features"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            flat = batch["features"].flatten().to_numpy(zero_copy_only=False)
            found = forest.scores(flat.reshape(n, -1)) if forest and n else np.zeros(n)
            yield pa.RecordBatch.from_arrays(
                [*(batch[x] for x in columns), pa.array(found)], names=[*columns, "anomaly"]
            )

    schema = ", ".join(f"{n} {t}" for n, t in stats.dtypes if n != "features") + ", anomaly double"
    return stats.mapInArrow(run, schema)


def calibrated(labelled: DataFrame, max_loss: float) -> float:
    """The score above which rows are rejected, from all labelled rows.

    Of the BINS cuts, the one with the most rejected bad rows less rejected good rows (as
    shares of each), among those that reject at most ``max_loss`` of the good. Only the
    counts per bin come to the driver. 1.0 (reject none) without rows of both kinds.
    """
    bin_ = F.floor(F.col("anomaly") * BINS).cast("int")
    counts = labelled.groupBy(bin_.alias("bin"), "quality").count().toPandas()
    good, bad = np.zeros(BINS + 1), np.zeros(BINS + 1)
    for bin_no, quality, n in counts.itertuples(index=False):
        (good if quality == 1 else bad)[bin_no] += n
    if not good.sum() or not bad.sum():
        return 1.0
    lost = np.cumsum(good[::-1])[::-1] / good.sum()
    caught = np.cumsum(bad[::-1])[::-1] / bad.sum()
    gain = np.where(lost <= max_loss, caught - lost, -1.0)
    best = int(np.argmax(gain))
    return best / BINS if gain[best] > 0 else 1.0


def judge(
    docs: DataFrame,
    labels: DataFrame,
    trees: int = TREES,
    tree_rows: int = TREE_ROWS,
    fit_rows: int = FIT_ROWS,
    max_loss: float = MAX_LOSS,
    seed: int = SEED,
) -> DataFrame:
    """Every document with its rule statistics, anomaly score and verdict.

    A document fails the base rules with fewer than MIN_WORDS words or with more than
    MAX_REPEATED percent of its words in repeated windows. An isolation forest, grown on at
    most ``fit_rows`` labelled rows that pass them, scores every document by how few random
    splits isolate its statistics; ``calibrated`` sets the threshold on all labelled rows
    that pass. A document is kept if it passes the base rules and its score is below the
    threshold. A null text has no words. Labels with a null doc_id or quality are not
    used; a doc_id with several labels counts once per label. Without labels only the
    base rules decide. Returns doc_id, COUNTS, base_failed, anomaly, threshold and kept, a
    row per input row; other columns are not read. An empty table gives no rows. A slice of
    texts, or a single text above its bound, takes some 30 bytes a byte while it is looked at.
    """
    stats = written(statistics(docs), "statistics")
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words")
    )
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality").dropna()
    labelled = stats.filter(~failed).join(marks, "doc_id")
    forest = fit_forest(labelled, trees, tree_rows, fit_rows, seed)
    threshold = calibrated(scored(labelled, forest), max_loss)
    return scored(stats, forest).withColumns(
        {
            "base_failed": failed,
            "threshold": F.lit(threshold),
            "kept": ~failed & (F.col("anomaly") < threshold),
        }
    )
