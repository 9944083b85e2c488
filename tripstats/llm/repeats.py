"""Repeated passages by fixed-block anchors.

A passage of ``length`` words that two documents share covers, wherever it lies, at least
one whole block of the earlier document when that document is cut into blocks of
``(length + 1) // 2`` words. So only those non-overlapping blocks are indexed, and every
rolling window of that size is a probe. Where a probe meets a block, the windows of
``length`` words around it are compared; adjoining ones that match are one maximal repeat.

Documents are dealt to parts, and a part sends each key once, whatever the number of its
documents that hold it: a passage in a third of all documents costs a key for each part. The
answers come back as a bit for each key, in the order in which the part sent them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cached_property
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstats.llm.arrays import U64, Words, give_back, mix, text_slices, windows, words
from tripstats.llm.groups import parts_for, written

LENGTH = 13
#: Bytes of the input files in one part, about.
PART_BYTES = 8 << 20
#: Text of a part looked at together.
SLICE_BYTES = 1 << 20

SENT = "bucket int, part int, info binary, keys binary"
SENT_ARROW = pa.schema(
    [("bucket", pa.int32()), ("part", pa.int32()), ("info", pa.binary()), ("keys", pa.binary())]
)
BLOCKS, PASSAGES = 0, 1
FOUND = "of int, step int, bucket int, bits binary"
FOUND_ARROW = pa.schema(
    [("of", pa.int32()), ("step", pa.int32()), ("bucket", pa.int32()), ("bits", pa.binary())]
)
SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
RESULT = (
    "doc_id long, n_words long, n_removed long, "
    "repeats array<struct<start: long, end: long>>, kept_text string"
)
RESULT_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("n_removed", pa.int64()),
        ("repeats", SPANS),
        ("kept_text", pa.string()),
    ]
)
#: A passage: 64 bits of its words, and 32 others.
PASSAGE = np.dtype([("value", "<u8"), ("more", "<u4")])


def _batch(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(x, f.type) for x, f in zip(columns, schema)], schema=schema
    )


def _ids(batch) -> np.ndarray:
    """Document ids; 0 for null, which has_id tells apart."""
    return batch["doc_id"].fill_null(0).to_numpy(zero_copy_only=False)


def _second_hash(found: Words, length: int, place: np.ndarray) -> np.ndarray:
    """Further hash bits of the windows at these places."""
    value = np.zeros(len(place), U64)
    for k in range(length):
        value = mix(value, k) + found.hash[place + k]
    return mix(value, 5)


def _bits(packed: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(packed, np.uint8), count=n).astype(bool)


def _kept_words(texts: pa.Array) -> Words:
    """The words of texts without their byte places, which no step needs."""
    found, none = words(texts), np.zeros(0, np.int64)
    return found._replace(start=none, end=none, doc=found.doc.astype(np.int32))


class Part:
    """The documents of one part: their blocks and probes, and the passages around meetings."""

    def __init__(self, rows: pa.Table, block: int, length: int, buckets: int):
        self.block, self.length, self.buckets = block, length, buckets
        self.number = rows["part"][0].as_py() if rows.num_rows else 0
        self.batches = list(text_slices(rows.select(["doc_id", "text"]).to_batches(), max_bytes=SLICE_BYTES))
        self.words = [_kept_words(x["text"]) for x in self.batches]
        self.has_id = [x["doc_id"].is_valid().to_numpy(zero_copy_only=False) for x in self.batches]

    def _probes(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(place, bucket and 32 bits) of every rolling window of a slice; rows without an id
        have none."""
        found = self.words[k]
        place, value = windows(found, self.block)
        own = self.has_id[k][found.doc[place]]
        place, value = place[own], value[own]
        bucket = (value >> U64(32)) % U64(self.buckets)
        return place, (bucket << U64(32)) | (value & U64(0xFFFFFFFF))

    @cached_property
    def _numbered(self) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], list[np.ndarray]]:
        """The distinct keys of all rolling windows, in the order in which they are sent, whether
        each occurs twice, and by slice the place of each window and the number of its key."""
        places, keys = [], [np.zeros(0, U64)]
        for k in range(len(self.batches)):
            place, key = self._probes(k)
            places.append(place.astype(np.int32))
            keys.append(key)
        sizes = [len(x) for x in places]
        keys = np.concatenate(keys)
        order = np.argsort(keys)
        keys = keys[order]
        head = np.ones(len(keys), bool)
        head[1:] = keys[1:] != keys[:-1]
        known = keys[head]
        del keys
        twice = np.diff(np.r_[np.flatnonzero(head), len(head)]) > 1
        rank = np.cumsum(head, dtype=np.int32 if len(head) < 1 << 31 else np.int64)
        number = np.empty_like(rank)
        number[order] = rank - 1
        return known, twice, places, np.split(number, np.cumsum(sizes)[:-1])

    def block_rows(self) -> list[tuple]:
        known, twice, places, numbers = self._numbered
        anchor = np.zeros(len(known), bool)
        for found, place, number in zip(self.words, places, numbers):
            anchor[number[(place - found.first[found.doc[place]]) % self.block == 0]] = True
        rows = []
        for b, i, j in self._cuts(known >> U64(32)):
            info = np.packbits(anchor[i:j]).tobytes() + np.packbits(twice[i:j]).tobytes()
            rows.append((b, self.number, info, known[i:j].astype("<u4").tobytes()))
        return rows

    def _cuts(self, bucket: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(bucket, from, to) of sorted buckets."""
        cuts = np.searchsorted(bucket, np.arange(self.buckets + 1, dtype=np.uint64)).tolist()
        yield from ((b, i, j) for b, (i, j) in enumerate(zip(cuts, cuts[1:])) if j > i)

    def _answers(self, found: pa.Table, step: int, bucket: np.ndarray) -> np.ndarray:
        """The bit of every key of a step; keys of buckets without an answer have none."""
        bits = {
            b: x
            for s, b, x in zip(*(found[c].to_pylist() for c in ("step", "bucket", "bits")))
            if s == step
        }
        out = np.zeros(len(bucket), bool)
        for b, i, j in self._cuts(bucket):
            if b in bits:
                out[i:j] = _bits(bits[b], j - i)
        return out

    def passages(self, found: pa.Table) -> None:
        """Find the windows of ``length`` words around meetings, and their distinct keys in
        the order in which they are sent, with the least document of each."""
        known, _, places, numbers = self._numbered
        del self._numbered  # not needed any more
        met = self._answers(found, BLOCKS, known >> U64(32))
        near = []
        for k, (batch, own) in enumerate(zip(self.batches, self.words)):
            hit = np.zeros(len(own.hash) + 1, np.int64)
            hit[places[k]] = met[numbers[k]]
            before = np.r_[0, np.cumsum(hit)]
            place, value = windows(own, self.length)
            close = before[place + self.length - self.block + 1] > before[place]
            place, value = place[close], value[close]
            other = _second_hash(own, self.length, place)
            near.append((np.full(len(place), k), place, value, other, _ids(batch)[own.doc[place]]))
        del known, places, numbers, met
        none = [np.zeros(0, t) for t in (np.int64, np.int64, U64, U64, np.int64)]
        self.slice, self.place, value, other, self.doc = map(np.concatenate, zip(none, *near))
        del near
        bucket = other % U64(self.buckets)
        more = (other >> U64(32)).astype("<u4")
        order = np.lexsort((self.doc, more, value, bucket))
        value, more, bucket = value[order], more[order], bucket[order]
        head = np.ones(len(order), bool)
        head[1:] = (value[1:] != value[:-1]) | (more[1:] != more[:-1]) | (bucket[1:] != bucket[:-1])
        self.number_of = np.empty(len(order), np.int64)
        self.number_of[order] = np.cumsum(head) - 1
        self.keys = np.empty(int(head.sum()), PASSAGE)
        self.keys["value"], self.keys["more"] = value[head], more[head]
        self.bucket, self.least = bucket[head], self.doc[order][head]

    def passage_rows(self) -> list[tuple]:
        return [
            (b, self.number, zlib.compress(self.least[i:j].tobytes(), 1), self.keys[i:j].tobytes())
            for b, i, j in self._cuts(self.bucket)
        ]

    def repeated(self, found: pa.Table) -> list[np.ndarray]:
        """For every slice, the places of passages that a smaller doc_id also has: elsewhere, as
        the answers say, or in this part."""
        elsewhere = self._answers(found, PASSAGES, self.bucket)
        hit = elsewhere[self.number_of] | (self.doc > self.least[self.number_of])
        return [self.place[hit & (self.slice == k)] for k in range(len(self.batches))]


def _meetings(sent: DataFrame) -> DataFrame:
    """For every key of a part whether it is a block somewhere and occurs in two places."""

    def run(rows: pa.Table) -> pa.Table:
        keys = [np.frombuffer(x, "<u4") for x in rows["keys"].to_pylist()]
        sizes = [len(x) for x in keys]
        flags = [
            (_bits(x[: (n + 7) // 8], n), _bits(x[(n + 7) // 8 :], n))
            for x, n in zip(rows["info"].to_pylist(), sizes)
        ]
        anchor, twice = (np.concatenate(x) for x in zip(*flags))
        known, number = np.unique(np.concatenate(keys), return_inverse=True)
        is_block = np.bincount(number, weights=anchor) > 0
        met = (is_block & (np.bincount(number, weights=1.0 + twice) > 1))[number]
        return _answered(rows, sizes, met, BLOCKS)

    return sent.groupBy("bucket").applyInArrow(run, FOUND)


def _answered(rows: pa.Table, sizes: list[int], bits: np.ndarray, step: int) -> pa.Table:
    """A row of bits for each row of keys; rows of which no bit is set need none."""
    ends = np.cumsum(sizes).tolist()
    out = [
        (part, step, bucket, np.packbits(bits[j - n : j]).tobytes())
        for part, bucket, n, j in zip(rows["part"].to_pylist(), rows["bucket"].to_pylist(), sizes, ends)
        if bits[j - n : j].any()
    ]
    return pa.Table.from_batches([_batch(out, FOUND_ARROW)])


def _earlier(sent: DataFrame) -> DataFrame:
    """For every passage of a part whether another part has it in a smaller document."""

    def run(rows: pa.Table) -> pa.Table:
        keys = [np.frombuffer(x, PASSAGE) for x in rows["keys"].to_pylist()]
        least = np.frombuffer(b"".join(map(zlib.decompress, rows["info"].to_pylist())), np.int64)
        every = np.concatenate(keys)
        order = np.lexsort((every["more"], every["value"]))
        ordered = every[order]
        head = np.ones(len(order), bool)
        head[1:] = (ordered["value"][1:] != ordered["value"][:-1]) | (ordered["more"][1:] != ordered["more"][:-1])
        first = np.minimum.reduceat(least[order], np.flatnonzero(head))
        bits = np.empty(len(order), bool)
        bits[order] = first[np.cumsum(head) - 1] < least[order]
        return _answered(rows, [len(x) for x in keys], bits, PASSAGES)

    return sent.groupBy("bucket").applyInArrow(run, FOUND)


def _cut_part(part: Part, repeated: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Words, removed words, maximal repeats and kept text of every document."""
    length = part.length
    for batch, own, hit in zip(part.batches, part.words, repeated):
        edge = np.zeros(len(own.hash) + 1, np.int64)
        np.add.at(edge, hit, 1)
        np.add.at(edge, hit + length, -1)
        gone = np.cumsum(edge)[:-1] > 0
        total = np.r_[0, np.cumsum(gone)]
        n_removed = total[own.first[1:]] - total[own.first[:-1]]
        rows = []
        for i, text in enumerate(batch["text"].to_pylist()):
            kept, spans = text.encode().split(), []
            if n_removed[i]:
                mask = gone[own.first[i] : own.first[i + 1]]
                turn = np.flatnonzero(np.diff(np.r_[False, mask, False]))
                spans = [{"start": int(s), "end": int(e)} for s, e in turn.reshape(-1, 2)]
                kept = compress(kept, ~mask)
            rows.append((spans, b" ".join(kept).decode()))
        spans, kept = zip(*rows)
        columns = [
            batch["doc_id"],
            pa.array(np.diff(own.first), pa.int64()),
            pa.array(n_removed, pa.int64()),
            pa.array(spans, SPANS),
            pa.array(kept, pa.string()),
        ]
        yield pa.RecordBatch.from_arrays(columns, schema=RESULT_ARROW)


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, buckets: int | None = None, parts: int | None = None
) -> DataFrame:
    """Remove from every document each word of a passage that a smaller doc_id also has.

    A passage is ``length`` or more consecutive words. All documents are judged on the
    input. Texts cross the network once, dealt to ``parts`` (default: one for each shuffle
    partition, more where one would hold over PART_BYTES of files); all three steps read that
    one exchange. Keys go to ``buckets`` (default: as many as shuffle partitions). A task holds
    the words of one part, some 50 bytes each, or the keys of one bucket.

    A null text has no words. A row with a null doc_id is returned unchanged and is no
    reference for others. Rows that share a doc_id don't remove each other's words. An empty
    table gives no rows. Returns doc_id, n_words, n_removed, repeats (word spans of the
    maximal repeats, end exclusive) and kept_text (kept words joined by one space). Other
    columns are not read. Passages are compared by 96 hash bits within a bucket of further ones.
    """
    spark = docs.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = parts or parts_for(docs, 1, PART_BYTES)
    block = (length + 1) // 2
    part = F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts)).cast("int").alias("part")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").select("doc_id", "text", part)

    def blocks(rows: pa.Table) -> pa.Table:
        own = Part(rows, block, length, buckets)
        out = pa.Table.from_batches([_batch(own.block_rows(), SENT_ARROW)])
        del own
        give_back()
        return out

    def passages(rows: pa.Table, found: pa.Table) -> pa.Table:
        own = Part(rows, block, length, buckets)
        own.passages(found)
        out = pa.Table.from_batches([_batch(own.passage_rows(), SENT_ARROW)])
        del own
        give_back()
        return out

    def cut(rows: pa.Table, found: pa.Table) -> pa.Table:
        own = Part(rows, block, length, buckets)
        own.passages(found)
        out = pa.Table.from_batches(_cut_part(own, own.repeated(found)), RESULT_ARROW)
        del own
        give_back()
        return out

    met = written(_meetings(texts.groupBy("part").applyInArrow(blocks, SENT)), "met")

    def with_texts(found: DataFrame, run, schema: str) -> DataFrame:
        return texts.groupBy("part").cogroup(found.groupBy("of")).applyInArrow(run, schema)

    earlier = _earlier(with_texts(met, passages, SENT))
    return with_texts(met.union(earlier), cut, RESULT)
