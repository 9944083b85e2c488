"""Bounded-space online best-fit packing of token sequences."""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import from_arrow_schema

from tripstats.llm.arrays import text_slices
from tripstats.llm.tokens import encoder

CAPACITY = 1024
OPEN_BINS = 1024
END_ID = 2
TOKENIZER = "byte_bpe_50k.json"
#: Text encoded together; a byte takes some 25 bytes on the way.
SLICE_BYTES = 1 << 20

SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids", pa.binary()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
    ]
)


def _schema(checksums: bool) -> pa.Schema:
    """SCHEMA, or with checksums the same with ids_crc32 for ids."""
    at = SCHEMA.get_field_index("ids")
    return SCHEMA.set(at, pa.field("ids_crc32", pa.int64())) if checksums else SCHEMA



class BestFit:
    """At most ``open_bins`` bins, found by their free space.

    ``free`` is a bitset: bit f is set while some open bin has f places left. The lowest
    set bit at or above a piece's length is the tightest bin. With all bins open and
    none that fits, the fullest closes.
    """

    def __init__(self, capacity: int, open_bins: int):
        self.capacity, self.open_bins = capacity, open_bins
        self.free = 0
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.n_open = self.n_made = 0

    def _take(self, space: int) -> int:
        chosen = self.bins[space].pop()
        if not self.bins[space]:
            self.free ^= 1 << space
        return chosen

    def place(self, length: int) -> tuple[int, int]:
        """(bin, offset) of a piece of 1 to capacity tokens."""
        fits = self.free >> length
        if fits:
            space = length + (fits & -fits).bit_length() - 1
            chosen = self._take(space)
        else:
            if length < self.capacity:
                if self.n_open == self.open_bins:
                    self._take((self.free & -self.free).bit_length() - 1)
                    self.n_open -= 1
                self.n_open += 1
            chosen, space = self.n_made, self.capacity
            self.n_made += 1
        left = space - length
        if left:
            self.bins[left].append(chosen)
            self.free |= 1 << left
        elif space < self.capacity:
            self.n_open -= 1
        return chosen, self.capacity - space


def pack(
    docs: DataFrame,
    tokenizer: str = TOKENIZER,
    end_id: int = END_ID,
    capacity: int = CAPACITY,
    open_bins: int = OPEN_BINS,
    checksums: bool = False,
) -> DataFrame:
    """Pieces of every document with the sequence and offset where each lies.

    A document is its token ids and ``end_id``; a null text has the end id alone. Documents
    above ``capacity`` are cut into pieces of that length of which the first may be
    shorter; others stay whole. Every partition of docs packs its own pieces as they come,
    so no row moves and a lost task is simply run again; sequence ids hold the partition
    number in their high bits. Repeated rows are packed once each, a null doc_id stays
    null, an empty table gives no rows. Other columns of docs are not read. Returns
    doc_id, piece, start, length, ids (little-endian unsigned 32-bit), sequence_id, offset;
    with ``checksums`` the unsigned CRC-32 of the ids, ids_crc32, in their place. A task holds
    the ids of a slice of texts, or of one text above the slice bound.
    """
    schema = _schema(checksums)
    last = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        bins = BestFit(capacity, open_bins)
        base = TaskContext.get().partitionId() << 40
        for part in text_slices(batches, max_bytes=SLICE_BYTES):
            rows = []
            for doc_id, ids in zip(part["doc_id"].to_pylist(), encode(part["text"].to_pylist())):
                ids += last
                n = len(ids) // 4
                start = piece = 0
                while start < n:
                    length = (n - start) % capacity or capacity
                    chosen, offset = bins.place(length)
                    cut = ids[4 * start : 4 * (start + length)]
                    cut = crc32(cut) if checksums else cut
                    rows.append((doc_id, piece, start, length, cut, base | chosen, offset))
                    start, piece = start + length, piece + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, f.type) for x, f in zip(zip(*rows), schema)], schema=schema
            )

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, from_arrow_schema(schema))
