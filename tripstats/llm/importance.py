"""Resampling a corpus towards a target distribution by importance weights of hashed n-grams.

Texts are taken a slice at a time: the slice is joined into one byte string with a
sentinel between texts, one regex pass finds the words of all of them, and n-grams that
would cross a sentinel are masked by the text each word lies in. Buckets are CRC-32
modulo their number; the checksum of an n-gram comes from those of its words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstats.llm.arrays import text_slices
from tripstats.llm.groups import numbered, written

LONGEST = 3
BUCKETS = 10_000
MIN_WORDS = 20
#: Documents drawn, in percent of those with MIN_WORDS words.
PERCENT = 5
SEED = 42
SENTINEL = b"\0"
# Words of texts in UTF-8 whose letters A-Z are small already.
WORD = re.compile(rb"[0-9a-z\x80-\xFF]+")
SMALL = bytes(x + 32 if 65 <= x <= 90 else x for x in range(256))

_IN_WORD = np.array([WORD.fullmatch(bytes([x])) is not None for x in range(256)])
#: Words below this size share tables of their own for each size.
SHORT = 64
#: Text joined together.
SLICE_BYTES = 1 << 20

SCORED = "doc_id long, n_words long, n_features long, weight long"
SCORED_ARROW = pa.schema([(x.split()[0], pa.int64()) for x in SCORED.split(", ")])


@cache
def _zeros(power: int) -> np.ndarray:
    """What 2 ** power zero bytes do to a checksum: four tables, one for each of its bytes."""
    if power:
        half = _zeros(power - 1)
        return np.stack([_through(half, table) for table in half])
    steps = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        steps = np.where(steps & 1, (steps >> 1) ^ np.uint32(0xEDB88320), steps >> 1)
    own = np.arange(256, dtype=np.uint32)
    return np.stack([steps, own, own << 8, own << 16])


def _through(tables: np.ndarray, sums: np.ndarray) -> np.ndarray:
    out = tables[0][sums & 255]
    for k in (1, 2, 3):
        out = out ^ tables[k][(sums >> (8 * k)) & 255]
    return out


@cache
def _zeros_by_size() -> np.ndarray:
    """The tables of 0 to SHORT - 1 zero bytes."""
    one = _zeros(0)
    own = np.arange(256, dtype=np.uint32)
    tables = [np.stack([own, own << 8, own << 16, own << 24])]
    while len(tables) < SHORT:
        tables.append(np.stack([_through(one, table) for table in tables[-1]]))
    return np.stack(tables)


def _shifted(sums: np.ndarray, size: np.ndarray) -> np.ndarray:
    """What ``size`` zero bytes do to each checksum."""
    tables, short = _zeros_by_size(), np.minimum(size, SHORT - 1)
    out = tables[short, 0, sums & 255]
    for k in (1, 2, 3):
        out ^= tables[short, k, (sums >> (8 * k)) & 255]
    long = np.flatnonzero(size >= SHORT)
    if len(long):
        own, left, power = sums[long], size[long], 0
        while (left >> power).any():
            some = np.flatnonzero((left >> power) & 1)
            own[some] = _through(_zeros(power), own[some])
            power += 1
        out[long] = own
    return out


def joined_crc(left: np.ndarray, right: np.ndarray, right_size: np.ndarray) -> np.ndarray:
    """CRC-32 of each left part followed by the right one, from the sums of both."""
    return _shifted(left, right_size) ^ right


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words of each text, checksum of each n-gram, text of each n-gram)."""
    data = SENTINEL.join(texts).translate(SMALL)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.cumsum(sizes + 1) - (sizes + 1)
    found = WORD.findall(data)
    crc = np.fromiter(map(crc32, found), np.uint32, len(found))
    size = np.fromiter(map(len, found), np.int64, len(found))
    inside = _IN_WORD[np.frombuffer(data, np.uint8)]
    head = inside.copy()
    head[1:] &= ~inside[:-1]
    doc = np.searchsorted(starts, np.flatnonzero(head), "right") - 1
    # a word with the blank before it, which is how it follows another
    blank = np.full(len(crc), crc32(b" "), np.uint32)
    after, after_size = joined_crc(blank, crc, size), size + 1
    sums, docs = [crc], [doc]
    now = crc
    for n in range(2, LONGEST + 1):
        now = joined_crc(now[:-1], after[n - 1 :], after_size[n - 1 :])
        whole = doc[: len(now)] == doc[n - 1 :]
        sums.append(now[whole])
        docs.append(doc[: len(now)][whole])
    words = np.bincount(doc, minlength=len(texts))
    return words, np.concatenate(sums), np.concatenate(docs)


def _texts(part: pa.RecordBatch) -> list[bytes]:
    return part["text"].cast(pa.binary()).to_pylist()


def bucket_counts(rows: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) of all n-grams of all texts; each task adds up its own before it sends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for part in text_slices(batches, max_bytes=SLICE_BYTES):
            _, sums, _ = features(_texts(part))
            total += np.bincount(sums % buckets, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array(total[some], pa.int64())], names=["bucket", "n"]
        )

    counts = rows.select("text").mapInArrow(run, "bucket int, n long")
    return counts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How much more the target uses each bucket: floor(1000 ln ratio), smoothed by one.

    What comes to the driver is a number per bucket, whatever the size of either table.
    """
    counts = np.zeros((2, buckets))
    for own, rows in zip(counts, (docs, target)):
        found = bucket_counts(rows, buckets).toArrow()
        own[found["bucket"].to_numpy()] = found["n"].to_numpy()
    (s, t), (all_s, all_t) = counts, counts.sum(1)
    ratio = (t + 1) * (all_s + buckets) / ((s + 1) * (all_t + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weighted(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features and weight (the sum of gains) of every row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, max_bytes=SLICE_BYTES):
            n = part.num_rows
            words, sums, doc = features(_texts(part))
            each = np.bincount(doc, minlength=n)
            # sums of whole numbers, exact in doubles up to 2 ** 53
            weight = np.bincount(doc, weights=gain[sums % len(gain)], minlength=n)
            yield pa.RecordBatch.from_arrays(
                [
                    part["doc_id"],
                    *(pa.array(x.astype(np.int64)) for x in (words, each, weight)),
                ],
                schema=SCORED_ARROW,
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, SCORED)


def with_score(rows: DataFrame, seed: int = SEED) -> DataFrame:
    """Add score: the weight and Gumbel noise that a hash of the id gives, in thousandths."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    return rows.withColumn("score", F.col("weight") + noise.cast("long"))


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    buckets: int = BUCKETS,
    seed: int = SEED,
) -> DataFrame:
    """Every document with its importance weight, noisy score and rank in the draw.

    Features are the runs of 1 to LONGEST words of a text, each in the bucket of its
    CRC-32; the weight adds up the gains of a document's features. Of the documents
    with ``min_words`` words, ``percent`` percent (rounded down) with the highest scores are
    drawn, ties going to the smaller doc_id; the others have a null rank.

    Ranks come without a window over all rows: rows are sorted by ranges of the score, and
    a row's rank is its place in its range after the rows of the ranges before, of which
    there is one count a range. Nulls: a null text has no words; a null doc_id is hashed
    as empty and loses ties. Repeated rows are weighed and drawn one by one. An empty target
    gives every text the smoothed gain. Other columns are not read. Returns doc_id,
    n_words, n_features, weight, score and rank, a row per input row.

    A slice of texts takes some 100 bytes a word on the way, and so does a single text
    above the slice bound.
    """
    rows = with_score(weighted(docs, gains(docs, target, buckets)), seed)
    able = (F.col("n_words") >= min_words).alias("able")
    order = [F.desc("able"), F.desc("score"), F.asc_nulls_last("doc_id")]
    ties = [F.asc("n_words"), F.asc("n_features")]
    rows = written(rows.withColumn("able", able), "weighted")
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order, *ties)
    ranked = numbered(placed, "ranked")
    drawn = F.lit(percent * rows.filter("able").count() // 100)
    rank = F.when(F.col("able") & (F.col("number") < drawn), F.col("number") + 1)
    return ranked.select(
        "doc_id", "n_words", "n_features", "weight", "score", rank.alias("rank")
    )
