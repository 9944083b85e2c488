"""Phrases whose words occur together more often than apart, counted in quotient filters.

Words become ids: each task numbers the words it sees and writes its text as streams of
these local numbers; the words that are frequent in their language get ids of their own
by a distributed sort, and come back to every shard by a join. A shard then counts its
n-grams in quotient filters, which are merged bucket by bucket across shards. A phrase
occurs no oftener than its words, so leaving out the rare words loses no candidate.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripstats.llm.arrays import text_slices
from tripstats.llm.groups import numbered, written
from tripstats.llm.quotient import Counts, Permutation, counted, joined, merged, split

#: Times a phrase must occur.
LEAST = 10
#: A phrase goes if a longer one around it occurs in so many percent of its places.
INSIDE_PERCENT = 50
TOP = 2000
SCALE = 1_000_000
UNKNOWN = "und"
#: Words of one shard, about 12 bytes each while they are gathered.
SHARD_WORDS = 2_000_000
#: Bytes of one text that are split into words at a time.
PIECE_BYTES = 4 << 20
#: Distinct n-grams that a merging task gathers before it adds them to what it has.
MERGE_ENTRIES = 1_000_000
#: Parts of a language that are ranked on their own first.
SALTS = 64

# Characters that end a piece, and the small letters of A-Z.
BREAKS = b".,;:!?\n\x0b\x0c\r"
BREAK = b"."
_TABLE = bytes(
    x + 32 if 65 <= x <= 90 else BREAK[0] if x in BREAKS else 32 if x == 9 else x
    for x in range(256)
)

STREAMS = "shard long, lang string, words array<string>, counts array<long>, stream binary"
STREAMS_ARROW = pa.schema(
    [
        ("shard", pa.int64()),
        ("lang", pa.string()),
        ("words", pa.list_(pa.string())),
        ("counts", pa.list_(pa.int64())),
        ("stream", pa.binary()),
    ]
)
FILTERS = "bucket int, filter binary"
FILTERS_ARROW = pa.schema([("bucket", pa.int32()), ("filter", pa.binary())])
GRAMS = "w1 long, w2 long, w3 long, a long"
GRAMS_ARROW = pa.schema([(x, pa.int64()) for x in ("w1", "w2", "w3", "a")])


class Shard:
    """The words of one language in one task: a number for each, and text as numbers. 0 is a
    break, which no n-gram spans."""

    def __init__(self):
        self.known: dict[bytes, int] = defaultdict()
        self.known.default_factory = self.known.__len__
        self.known[BREAK] = 0
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, texts: list[bytes]) -> None:
        data = BREAK.join([*texts, b""]).translate(_TABLE)
        at = 0
        while at < len(data):
            stop = data.find(BREAK, at + PIECE_BYTES) + 1 or len(data)
            tokens = data[at:stop].replace(BREAK, b" . ").split()
            self.parts.append(np.fromiter(map(self.known.__getitem__, tokens), np.int32, len(tokens)))
            self.size += len(tokens)
            at = stop

    def row(self, shard: int, lang: str) -> pa.RecordBatch:
        stream = np.concatenate(self.parts)
        counts = np.bincount(stream, minlength=len(self.known))[1:]
        words = [x.decode() for x in self.known][1:]
        values = [shard], [lang], [words], [counts], [stream.astype("<i4").tobytes()]
        return pa.RecordBatch.from_arrays(
            [pa.array(x, f.type) for x, f in zip(values, STREAMS_ARROW)], schema=STREAMS_ARROW
        )


def streams(docs: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Shards of docs: their words with counts, and their text as numbers of these words.

    A task gathers a shard for each language; when it holds ``shard_words`` words altogether
    the largest shard is finished.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards: dict[str, Shard] = defaultdict(Shard)
        base, made = TaskContext.get().partitionId() << 32, 0
        for part in text_slices(batches):
            langs = np.array(part["lang"].to_pylist(), object)
            texts = part["text"].cast(pa.binary())
            for lang in dict.fromkeys(langs):
                shards[lang].add(texts.filter(pa.array(langs == lang)).to_pylist())
            while sum(x.size for x in shards.values()) >= shard_words:
                largest = max(shards, key=lambda x: shards[x].size)
                yield shards.pop(largest).row(base + made, largest)
                made += 1
        for lang, shard in shards.items():
            yield shard.row(base + made, lang)
            made += 1

    lang = F.coalesce("lang", F.lit(UNKNOWN)).alias("lang")
    return docs.select("text", lang).mapInArrow(run, STREAMS)


def _shard_words(shards: DataFrame) -> DataFrame:
    """(shard, lang, local, word, n) of every shard; local numbers begin at 1."""
    both = F.posexplode(F.arrays_zip("words", "counts")).alias("at", "x")
    return shards.select("shard", "lang", both).select(
        "shard",
        "lang",
        (F.col("at") + 1).cast("int").alias("local"),
        F.col("x.words").alias("word"),
        F.col("x.counts").alias("n"),
    )


def vocabulary(words: DataFrame, least: int = LEAST) -> DataFrame:
    """(lang, word, n, id) of the words that occur ``least`` times in a language; ids count
    from 1 over all languages, without gaps."""
    total = words.groupBy("lang", "word").agg(F.sum("n").alias("n"))
    known = numbered(total.filter(F.col("n") >= least), "vocabulary")
    return known.select("lang", "word", "n", (F.col("number") + 1).alias("id"))


def _filters(shards: DataFrame, ids: DataFrame, id_bits: int, bucket_bits: int) -> DataFrame:
    """The n-grams of every shard as a filter for each bucket."""
    permutation = Permutation(id_bits)

    def run(shard: pa.Table, table: pa.Table) -> pa.Table:
        rows = []
        for size, stream in zip(shard["size"].to_pylist(), shard["stream"].to_pylist()):
            id_of = np.zeros(size + 1, np.int64)
            id_of[table["local"].to_numpy()] = table["id"].to_numpy()
            seq = id_of[np.frombuffer(stream, "<i4")]
            found = []
            for n in (2, 3):
                own = [seq[k : len(seq) - n + 1 + k] for k in range(n)] if len(seq) >= n else [seq[:0]] * n
                whole = np.flatnonzero(np.logical_and.reduce([x > 0 for x in own]))
                own = [x[whole] for x in own]
                found.append(permutation.of(*own, *[np.zeros_like(own[0])] * (3 - n)))
            rows += split(counted(*(np.concatenate(x) for x in zip(*found))), permutation.half, bucket_bits)
        return pa.table([[x[k] for x in rows] for k in (0, 1)], schema=FILTERS_ARROW)

    streams = shards.select("shard", F.size("words").alias("size"), "stream")
    return streams.groupBy("shard").cogroup(ids.groupBy("of")).applyInArrow(run, FILTERS)


def _merged(filters: DataFrame, id_bits: int, bucket_bits: int, least: int) -> DataFrame:
    """(w1, w2, w3, a) of the n-grams that occur ``least`` times; w3 is 0 for two words.

    The filters of a bucket stream through one task, which holds the bucket's distinct
    n-grams and MERGE_ENTRIES more.
    """
    permutation = Permutation(id_bits)

    def frequent(found: Counts) -> pa.RecordBatch:
        own = found.n >= least
        ids = permutation.undone(found.left[own], found.right[own])
        return pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (*ids, found.n[own])], schema=GRAMS_ARROW
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, waiting, size = None, [], 0
        for batch in batches:
            for own, data in zip(batch["bucket"].to_pylist(), batch["filter"]):
                if own != bucket and waiting:
                    yield frequent(merged(waiting))
                    waiting, size = [], 0
                bucket = own
                waiting.append(joined(bucket, data.as_py(), permutation.half, bucket_bits))
                size += len(waiting[-1].n)
                if size > MERGE_ENTRIES + 2 * len(waiting[0].n):
                    waiting = [merged(waiting)]
                    size = len(waiting[0].n)
        if waiting:
            yield frequent(merged(waiting))

    by_bucket = filters.repartition("bucket").sortWithinPartitions("bucket")
    return by_bucket.mapInArrow(run, GRAMS)


def _score(l: Column, r: Column) -> Column:
    """floor(SCALE * a * a / (l * r)), exact for counts up to 10 ** 15."""
    a, l, r = (x.cast("decimal(15,0)") for x in (F.col("a"), l, r))
    over, under = (a * a * F.lit(SCALE).cast("decimal(7,0)"), l * r)
    return F.call_function("div", over.cast("decimal(38,0)"), under.cast("decimal(38,0)"))


def scored(grams: DataFrame, known: DataFrame, inside_percent: int = INSIDE_PERCENT) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the candidates that no longer one contains."""
    first = known.select(F.col("id").alias("w1"), "lang", F.col("word").alias("x1"), F.col("n").alias("l"))
    second = known.select(F.col("id").alias("w2"), F.col("word").alias("x2"), F.col("n").alias("r"))
    pairs = grams.filter("w3 = 0").drop("w3").join(first, "w1").join(second, "w2")
    pairs = written(pairs.withColumn("score", _score(F.col("l"), F.col("r"))), "pairs")
    triples = grams.filter("w3 > 0")

    heads = pairs.select("w1", "w2", "lang", "x1", "x2", F.col("l").alias("l1"), F.col("a").alias("l2"))
    tails = pairs.select(
        F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("x2").alias("x3"), F.col("a").alias("r1"), F.col("r").alias("r2")
    )
    cut = triples.join(heads, ["w1", "w2"]).join(tails, ["w2", "w3"])
    cut = cut.withColumns({"s1": _score(F.col("l1"), F.col("r1")), "s2": _score(F.col("l2"), F.col("r2"))})
    at_first = F.col("s1") <= F.col("s2")
    of_cut = {x: F.when(at_first, F.col(f"{x}1")).otherwise(F.col(f"{x}2")) for x in ("l", "r")}
    longer = cut.select(
        "lang",
        F.concat_ws(" ", "x1", "x2", "x3").alias("phrase"),
        "a",
        *(value.alias(x) for x, value in of_cut.items()),
        F.least("s1", "s2").alias("score"),
    )

    around = triples.select("w1", "w2", "a").union(triples.select("w2", "w3", "a")).groupBy("w1", "w2")
    around = around.agg(F.max("a").alias("longer"))
    inside = F.coalesce(100 * F.col("longer") >= inside_percent * F.col("a"), F.lit(False))
    free = pairs.join(around, ["w1", "w2"], "left").filter(~inside)
    free = free.select("lang", F.concat_ws(" ", "x1", "x2").alias("phrase"), "a", "l", "r", "score")
    return longer.union(free)


def _top(rows: DataFrame, top: int) -> DataFrame:
    """The first rows of each language with their rank. Parts of a language are cut to ``top``
    rows each before they meet, so no task sees a whole language."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    in_part = Window.partitionBy("lang", "salt").orderBy(*order)
    rows = rows.withColumn("salt", salt).withColumn("place", F.row_number().over(in_part))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    rows = rows.filter(F.col("place") <= top).drop("salt", "place")
    return rows.withColumn("rank", rank).filter(F.col("rank") <= top)


def collocations(
    docs: DataFrame,
    least: int = LEAST,
    top: int = TOP,
    inside_percent: int = INSIDE_PERCENT,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """The ``top`` phrases of 2 or 3 words of each language by how closely their words stick.

    Texts (A-Z made small) are split at BREAKS into pieces and these at blanks and tabs into
    words. A candidate occurs ``least`` times, overlaps included. Cut after its first word
    or words it scores floor(10 ** 6 * a * a / (l * r)), where l and r count the two parts; the
    lowest cut is its score, the first one on ties. A candidate inside a longer one that
    occurs in ``inside_percent`` percent of its places goes. Ties go to the larger a, then the
    smaller phrase by bytes.

    Returns lang, rank, phrase, a, l, r, n (words of the language) and score. A null lang is
    UNKNOWN, a null text has no words, repeated rows count each, a table without
    candidates gives no rows. Other columns are not read. A single text above PIECE_BYTES is
    split piece by piece; a piece without a break, and a text's word numbers (4 bytes a
    word), are held whole.
    """
    spark = docs.sparkSession
    shards = written(streams(docs, shard_words), "streams")
    words = _shard_words(shards)
    known = written(vocabulary(words, least), "words")
    n_known = known.count()
    id_bits = max(2, n_known.bit_length())
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bucket_bits = (4 * partitions).bit_length()
    ids = words.join(known.select("lang", "word", "id"), ["lang", "word"]).select(F.col("shard").alias("of"), "local", "id")
    filters = _filters(shards, ids, id_bits, bucket_bits)
    grams = written(_merged(filters, id_bits, bucket_bits, least), "grams")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    best = _top(scored(grams, known, inside_percent), top)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
