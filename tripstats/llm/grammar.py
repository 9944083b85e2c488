"""Token files compressed with a Re-Pair grammar per shard.

A file row is one shard: a few documents that follow one another in doc_id order, as bytes:

    magic b"RPG2", then little-endian unsigned 32-bit numbers: terminals, rules, symbols,
    documents; then the arrays
    left, right     4 bytes per rule     what the rule's nonterminal stands for
    expansion       4 bytes per rule     how many ids that is in the end
    doc ids         8 bytes per document
    doc lengths     4 bytes per document, with the end id
    has id          1 byte per document  0 where the doc id is null
    symbols         3 planes of a byte each, lowest first

Symbols below ``terminals`` are ids, the others nonterminals, numbered in the order of
their rules; a rule refers to earlier symbols only. A rule takes 12 bytes and an occurrence it
replaces saves 3, so a pair gets a rule while it occurs LEAST times without overlap, and none
is left that does.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripstats.llm.arrays import U64, text_slices
from tripstats.llm.tokens import encoder

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
SHARD_TOKENS = 1 << 20
#: A pair must occur this often, without overlap, for a rule of its own.
LEAST = 6
MAGIC = b"RPG2"
#: Frequent pairs are looked up in a table of so many bits.
TABLE_BITS = 20

SHARDS = "part int, shard int, n_tokens long, data binary"


class Shard(NamedTuple):
    terminals: int
    left: np.ndarray
    right: np.ndarray
    expansion: np.ndarray
    doc_ids: np.ndarray
    lengths: np.ndarray
    has_id: np.ndarray
    symbols: np.ndarray


def _spread(run_starts: np.ndarray, n: int) -> np.ndarray:
    """For each of n places, how far it lies behind the start of its run."""
    at = np.arange(n)
    return at - np.maximum.accumulate(np.where(run_starts, at, 0))


class Pairs(NamedTuple):
    """Occurrences of pairs that are frequent: place, rank (from 1, growing with the number of
    occurrences) and pair; every: all their places, overlapping ones too."""

    place: np.ndarray
    rank: np.ndarray
    pair: np.ndarray
    every: np.ndarray


def _bins(code: np.ndarray) -> np.ndarray:
    return ((code * U64(0x9E3779B97F4A7C15)) >> U64(64 - TABLE_BITS)).astype(np.int32)


def _number_in(pairs: np.ndarray, code: np.ndarray) -> np.ndarray:
    """The place of each code among sorted distinct pairs, or -1: by search if there are few
    codes, else by a table of bins, and by search where two pairs share a bin."""
    if len(code) < 1 << TABLE_BITS - 5:
        at = np.minimum(np.searchsorted(pairs, code), len(pairs) - 1)
        return np.where(pairs[at] == code, at, -1)
    own = _bins(pairs)
    table = np.full(1 << TABLE_BITS, -1, np.int32)
    table[own] = np.arange(len(pairs), dtype=np.int32)
    found = table[_bins(code)]
    wrong = np.flatnonzero((found >= 0) & (pairs[found] != code))
    found[wrong] = -1
    hidden = np.flatnonzero(table[own] != np.arange(len(pairs)))
    if len(hidden) and len(wrong):
        at = np.minimum(np.searchsorted(pairs[hidden], code[wrong]), len(hidden) - 1)
        hit = pairs[hidden[at]] == code[wrong]
        found[wrong[hit]] = hidden[at[hit]]
    return found


def frequent_pairs(seq: np.ndarray, place: np.ndarray, follow: np.ndarray, least: int) -> Pairs:
    """The pairs of the symbols at ``place`` and ``follow`` that occur ``least`` times without
    overlap.

    Only a pair of two equal symbols overlaps itself; of its runs every second place counts.
    """
    left, right = seq[place], seq[follow]
    code = (left.astype(U64) << U64(24)) | right.astype(U64)
    counts = np.ones(len(place), bool)
    same = np.flatnonzero(left == right)
    if len(same):
        start = np.r_[True, place[same[1:]] != follow[same[:-1]]]
        counts[same] = _spread(start, len(same)) % 2 == 0
    ordered = np.sort(code[counts])
    heads = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(ordered) else place[:0]
    count = np.diff(np.r_[heads, len(ordered)])
    often = count >= least
    pairs, count = ordered[heads[often]], count[often]
    if not len(pairs):
        none = place[:0]
        return Pairs(none, none, code[:0], none)
    rank = np.empty(len(pairs) + 1, np.int32)
    rank[np.argsort(count, kind="stable")] = np.arange(1, len(pairs) + 1)
    rank[-1] = 0  # of those that are not frequent
    rank = rank[_number_in(pairs, code)]
    every = np.flatnonzero(rank)
    own = every[counts[every]]
    return Pairs(place[own], rank[own], code[own], place[every])


def compress(
    ids: np.ndarray, least: int = LEAST
) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """(terminals, left, right, symbols) of a grammar for ids.

    Every round counts the pairs and replaces each occurrence that no occurrence of a more
    frequent pair touches, so the most frequent pair goes wholly and others as far as they
    don't get in its way. A pair that would be replaced fewer than ``least`` times waits
    for the next round, when the pairs around it are gone. It ends when no pair occurs
    ``least`` times without overlap. A pair can only become frequent if it has a symbol that
    the round has placed, so after the first round only those and the frequent ones that are
    left are counted.
    """
    seq = ids.astype(np.int32)
    terminals = symbol = int(seq.max(initial=0)) + 1
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    known, known_name = np.zeros(0, U64), np.zeros(0, np.int64)
    n = len(seq)
    # places stay where they are: each knows the next and the one before that are still in use
    follow, before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
    alive = np.ones(n, bool)
    to_count = np.arange(max(n - 1, 0), dtype=np.int32)
    renewed: list[np.ndarray] = []
    while len(to_count):
        place, rank, pair, every = frequent_pairs(seq, to_count, follow[to_count], least)
        if not len(place):
            if not renewed:
                break
            # symbols placed again may make pairs with places that were not counted since
            again = np.zeros(symbol, bool)
            again[np.concatenate(renewed)] = True
            renewed, wanted = [], np.zeros(n + 1, bool)
            own = np.flatnonzero(again[seq] & alive)
            wanted[own] = wanted[before[own]] = True
            to_count = np.flatnonzero(wanted[:n]).astype(np.int32)
            to_count = to_count[follow[to_count] < n]
            continue
        next_to = place[1:] == follow[place[:-1]]
        wins = np.ones(len(place), bool)
        wins[1:] &= ~next_to | (rank[1:] > rank[:-1])
        wins[:-1] &= ~next_to | (rank[:-1] > rank[1:])
        place, rank, pair = place[wins], rank[wins], pair[wins]
        often = np.bincount(rank) >= least
        kept = often[rank]
        place, rank, pair = place[kept], rank[kept], pair[kept]
        number = (np.cumsum(often) - 1)[rank]
        rules = np.zeros(int(often.sum()), U64)
        rules[number] = pair
        # a pair that got a rule before, where others were in its way, keeps it
        at = np.searchsorted(known, rules)
        has_rule = known[np.minimum(at, len(known) - 1)] == rules if len(known) else rules != rules
        name = np.empty(len(rules), np.int64)
        name[has_rule] = known_name[at[has_rule]]
        name[~has_rule] = symbol + np.arange(np.count_nonzero(~has_rule))
        new = rules[~has_rule]
        left.append((new >> U64(24)).astype(np.int64))
        right.append((new & U64((1 << 24) - 1)).astype(np.int64))
        order = np.argsort(new)
        at = np.searchsorted(known, new[order])
        known = np.insert(known, at, new[order])
        known_name = np.insert(known_name, at, symbol + order)
        seq[place] = name[number]
        symbol += len(new)
        if symbol >= 1 << 24:
            raise ValueError("a shard's symbols must fit 24 bits")
        gone = follow[place]
        after = follow[gone]
        alive[gone] = False
        follow[place] = after
        inside = after < n
        before[after[inside]] = place[inside]
        wanted = np.zeros(n + 1, bool)
        wanted[every[alive[every]]] = wanted[place] = True
        wanted[before[place]] = True  # before the first place: the entry at the end
        renewed += [name[has_rule]] if has_rule.any() else []
        to_count = np.flatnonzero(wanted[:n]).astype(np.int32)
        to_count = to_count[follow[to_count] < n]
    return terminals, np.concatenate(left), np.concatenate(right), seq[alive]


def expansions(terminals: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many ids each rule stands for, found for all rules at once that refer to symbols
    known before them."""
    size = np.ones(terminals + len(left), np.int64)
    at, reach = 0, np.maximum.accumulate(np.maximum(left, right)) if len(left) else left
    while at < len(left):
        stop = int(np.searchsorted(reach, terminals + at))  # rules that need none from here on
        size[terminals + at : terminals + stop] = size[left[at:stop]] + size[right[at:stop]]
        at = stop
    return size[terminals:]


def to_bytes(doc_ids: list[int | None], lengths: list[int], ids: bytes) -> bytes:
    """The file form of some documents."""
    terminals, left, right, seq = compress(np.frombuffer(ids, "<u4"))
    planes = seq.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3].T
    return b"".join(
        [
            MAGIC,
            struct.pack("<4I", terminals, len(left), len(seq), len(doc_ids)),
            left.astype("<u4").tobytes(),
            right.astype("<u4").tobytes(),
            expansions(terminals, left, right).astype("<u4").tobytes(),
            np.array([x or 0 for x in doc_ids], "<i8").tobytes(),
            np.array(lengths, "<u4").tobytes(),
            bytes(x is not None for x in doc_ids),
            np.ascontiguousarray(planes).tobytes(),
        ]
    )


def from_bytes(data: bytes) -> Shard:
    """The parts of a shard, without decoding it."""
    if data[:4] != MAGIC:
        raise ValueError("not a token shard")
    terminals, rules, symbols, docs = struct.unpack("<4I", data[4:20])
    sizes = [("<u4", rules)] * 3 + [("<i8", docs), ("<u4", docs), ("u1", docs)]
    ends = list(accumulate((np.dtype(t).itemsize * n for t, n in sizes), initial=20))
    arrays = [np.frombuffer(data, t, n, at) for (t, n), at in zip(sizes, ends)]
    planes = np.frombuffer(data, np.uint8, 3 * symbols, ends[-1]).reshape(3, -1)
    seq = planes[0].astype(np.int64) | planes[1].astype(np.int64) << 8 | planes[2].astype(np.int64) << 16
    return Shard(terminals, *arrays, seq)


def decode(shard: Shard) -> bytes:
    """All ids of a shard: what each rule stands for is laid out once, then copied for every
    symbol."""
    rules: list[bytes] = []
    own = lambda x: x.to_bytes(4, "little") if x < shard.terminals else rules[x - shard.terminals]
    for a, b in zip(shard.left.tolist(), shard.right.tolist()):
        rules.append(own(a) + own(b))
    single = np.arange(shard.terminals, dtype="<u4")
    laid_out = np.frombuffer(single.tobytes() + b"".join(rules), "<u4")
    size = np.r_[np.ones(shard.terminals, np.int32), shard.expansion.astype(np.int32)]
    begin = np.cumsum(size) - size
    lengths = size[shard.symbols]
    ends = np.cumsum(lengths)
    place = np.repeat(begin[shard.symbols] - (ends - lengths), lengths)
    place += np.arange(len(place))
    return laid_out[place].tobytes()


class Access:
    """Random access to the ids of a shard, by the expansion lengths of its symbols."""

    def __init__(self, shard: Shard):
        self.shard = shard
        self.size = np.r_[np.ones(shard.terminals, np.int64), shard.expansion.astype(np.int64)]
        self.ends = np.cumsum(self.size[shard.symbols])

    def range(self, start: int, n: int) -> list[int]:
        """ids[start : start + n]; only symbols that overlap the range are expanded, and of
        these only the parts that do."""
        shard, size = self.shard, self.size
        at = int(np.searchsorted(self.ends, start, "right"))
        skip = start - (int(self.ends[at - 1]) if at else 0)
        out: list[int] = []
        while len(out) < n and at < len(shard.symbols):
            stack = [int(shard.symbols[at])]
            while stack and len(out) < n:
                x = stack.pop()
                if skip >= size[x]:
                    skip -= int(size[x])
                elif x < shard.terminals:
                    out.append(x)
                else:
                    rule = x - shard.terminals
                    stack += [int(shard.right[rule]), int(shard.left[rule])]
            at += 1
        return out


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str = TOKENIZER,
    end_id: int = END_ID,
    shard_tokens: int = SHARD_TOKENS,
) -> None:
    """Write the ids of all documents, each followed by ``end_id``, in doc_id order.

    Texts are dealt by ranges of doc_id, so parts follow one another; each part cuts its
    documents into shards of about ``shard_tokens`` ids and compresses each on its own. Rows
    of the Parquet files at ``path``: part, shard, n_tokens, data. Spark's writer commits
    them, so a lost executor leaves no half file. A null text is empty, null doc_ids
    come first; rows that share a doc_id, or have none, follow each other by a hash of their text
    and may lie in several parts. An empty table gives no shard. Other columns are not read.
    A task holds one shard's ids, and a slice of texts.
    """
    last = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        part_no, shard = TaskContext.get().partitionId(), 0
        doc_ids: list[int | None] = []
        lengths: list[int] = []
        ids = bytearray()

        def row() -> pa.RecordBatch:
            values = [part_no], [shard], [len(ids) // 4], [to_bytes(doc_ids, lengths, bytes(ids))]
            kinds = pa.int32(), pa.int32(), pa.int64(), pa.binary()
            return pa.RecordBatch.from_arrays(
                [pa.array(x, kind) for x, kind in zip(values, kinds)],
                names=["part", "shard", "n_tokens", "data"],
            )

        for part in text_slices(batches):
            found = encode(part["text"].to_pylist())
            for doc_id, own in zip(part["doc_id"].to_pylist(), found):
                own += last
                doc_ids.append(doc_id)
                lengths.append(len(own) // 4)
                ids += own
                if len(ids) >= 4 * shard_tokens:
                    yield row()
                    shard += 1
                    doc_ids, lengths, ids = [], [], bytearray()
        if doc_ids:
            yield row()

    tie = F.xxhash64("text").alias("tie")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", tie)
    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text")
    ordered.mapInArrow(run, SHARDS).write.parquet(path)


DECODED = "doc_id long, start long, n_tokens long, ids binary, middle_id long"
DECODED_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("n_tokens", pa.int64()),
        ("ids", pa.binary()),
        ("middle_id", pa.int64()),
    ]
)


def _shard_starts(files: DataFrame) -> DataFrame:
    """(part, shard, shard_start): ids before each shard. Summed over the shards of its part
    and over whole parts, of which there is a row each."""
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("total").over(earlier), F.lit(0))
    parts = parts.select("part", before.alias("part_start"))
    inside = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    own = F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))
    shards = files.select("part", "shard", own.alias("own_start")).join(parts, "part")
    return shards.select("part", "shard", (F.col("own_start") + F.col("part_start")).alias("shard_start"))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Every document of the files at ``path``: doc_id, start (ids of all documents before
    it), n_tokens, ids (little-endian unsigned 32-bit) and middle_id (the id in its middle,
    found by random access), all from the files.

    Shards learn where they start before they are decoded, so no decoded id is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, before in zip(batch["data"], batch["shard_start"].to_pylist()):
                shard = from_bytes(data.as_py())
                ids, access = decode(shard), Access(shard)
                ends = np.cumsum(shard.lengths.astype(np.int64))
                starts = ends - shard.lengths
                places = list(zip(starts.tolist(), ends.tolist()))
                columns = [
                    pa.array(shard.doc_ids, mask=shard.has_id == 0),
                    starts + before,
                    shard.lengths.astype(np.int64),
                    [ids[4 * a : 4 * b] for a, b in places],
                    [access.range((a + b) // 2, 1)[0] for a, b in places],
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, f.type) for x, f in zip(columns, DECODED_ARROW)], schema=DECODED_ARROW
                )

    files = spark.read.schema(SHARDS).parquet(path)
    starts = _shard_starts(files.select("part", "shard", "n_tokens"))
    shards = files.select("part", "shard", "data").join(starts, ["part", "shard"])
    return shards.select("data", "shard_start").mapInArrow(run, DECODED)
