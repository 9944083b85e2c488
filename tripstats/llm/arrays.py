"""Words and word windows of Arrow text columns as numpy arrays.

A word is a maximal run of bytes other than ``[\\x20\\x09-\\x0D]``. Words are found and
hashed for a whole slice of documents at once; nothing loops over words in Python.
"""

from __future__ import annotations

import ctypes
import zlib
from collections.abc import Iterator
from hashlib import blake2b
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20
SLICE_ROWS = 20_000
U64 = np.uint64

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """Scramble 64-bit values; one to one for a given seed."""
    x = values.astype(U64) + U64(((seed + 1) * 0x9E3779B97F4A7C15) % 2**64)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_malloc_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only


def give_back() -> None:
    """Return memory that is free to the system; a Python worker holds on to it otherwise, beside
    the JVM and the other workers of its executor."""
    pa.default_memory_pool().release_unused()
    if _malloc_trim:
        _malloc_trim(0)


def text_slices(
    batches: Iterator[pa.RecordBatch],
    column: str = "text",
    max_bytes: int = SLICE_BYTES,
    max_rows: int = SLICE_ROWS,
) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of bounded text, so that memory does not follow batch size.

    A text above the bound is a slice of its own. Null texts become empty.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        at = batch.schema.get_field_index(column)
        texts = pc.fill_null(batch.column(at), "")
        batch = batch.set_column(at, batch.schema.field(at), texts)
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = int(np.searchsorted(ends, base + max_bytes, "right"))
            stop = min(max(stop, start + 1), start + max_rows)
            yield batch.slice(start, stop - start)
            start = stop
        give_back()  # what a batch took, and a finished task


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a slice, and where each text starts (one more entry for the end)."""
    wide = pa.types.is_large_string(texts.type)
    buffers = texts.buffers()
    n = len(texts)
    if not n or buffers[1] is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(buffers[1], np.int64 if wide else np.int32)
    offsets = offsets[texts.offset : texts.offset + n + 1].astype(np.int64)
    if buffers[2] is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    data = np.frombuffer(buffers[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


class Words(NamedTuple):
    """start and end: byte places; doc: the row of each word; first: the place of each
    row's first word among all words, with one more entry for the end."""

    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    first: np.ndarray
    hash: np.ndarray


#: Spans above this many bytes are hashed one by one.
LONG = 4096
_KEPT = np.array([(1 << 8 * n) - 1 for n in range(9)], U64)


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64 bits of the bytes of each span, taken eight at a time from its own start.

    Memory follows the bytes and spans given. Spans of one size up to eight bytes never clash.
    """
    size = end - start
    value = mix(size, 13)
    lanes = np.ndarray((len(data) + 1,), "<u8", data.tobytes() + bytes(8), strides=(1,))
    live, done = np.flatnonzero((size > 0) & (size <= LONG)), 0
    while len(live):
        left = size[live] - done
        own = lanes[start[live] + done] & _KEPT[np.minimum(left, 8)]
        value[live] = mix(value[live] ^ own)
        done += 8
        live = live[left > 8]
    for i in np.flatnonzero(size > LONG).tolist():
        digest = blake2b(data[start[i] : end[i]], digest_size=8).digest()
        value[i] = int.from_bytes(digest, "little")
    return value


def words(
    texts: pa.Array, breaks: np.ndarray = IS_SPACE, fold: np.ndarray | None = None
) -> Words:
    """Every word of every text, hashed by content to 64 bits.

    ``breaks`` tells for each byte whether it parts words; words that ``fold`` maps to the same
    bytes have the same hash.
    """
    data, offsets = text_bytes(texts)
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(none, none, none, np.zeros(len(texts) + 1, np.int64), np.zeros(0, U64))
    inside = ~breaks[data]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    filled = offsets[1:] > offsets[:-1]
    heads, tails = offsets[:-1][filled], offsets[1:][filled] - 1
    opens[heads] = inside[heads]
    closes[tails] = inside[tails]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    first = np.searchsorted(start, offsets)
    doc = np.repeat(np.arange(len(texts)), np.diff(first))
    return Words(start, end, doc, first, hash_spans(data if fold is None else fold[data], start, end))


def windows(found: Words, n: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(place of the first word, hash) of every n consecutive words of one text."""
    total = len(found.hash) - n + 1
    if total <= 0:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    factor = U64((0xD6E8FEB86659FD93 + 2 * seed) % 2**64)
    value = found.hash[:total].copy()
    for k in range(1, n):
        value *= factor
        value += found.hash[k : k + total]
    place = np.flatnonzero(found.doc[:total] == found.doc[n - 1 :])
    return place, mix(value[place], seed)


def pack_keys(bucket: np.ndarray, doc_ids: np.ndarray, keys: np.ndarray):
    """Yield (bucket, docs, keys) with the keys of each bucket as bytes, in the given order.

    docs holds the document ids of the keys, run by run. Millions of keys so travel in few
    rows, at little more than the bytes of the keys.
    """
    small = bucket.astype(np.uint16) if bucket.max(initial=0) < 65536 else bucket
    order = np.argsort(small, kind="stable")
    bucket, doc_ids, keys = bucket[order], doc_ids[order], keys[order]
    cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else []
    for i, j in zip(cuts, [*cuts[1:], len(bucket)]):
        runs = np.flatnonzero(np.r_[True, doc_ids[i + 1 : j] != doc_ids[i : j - 1]])
        counts = np.diff(np.r_[runs, j - i])
        packed = np.r_[np.diff(doc_ids[i:j][runs], prepend=0), counts].astype(np.int64)
        yield int(bucket[i]), zlib.compress(packed.tobytes(), 1), keys[i:j].tobytes()


def unpack_docs(packed: bytes) -> np.ndarray:
    """The document id of every key of a row that pack_keys made."""
    ids, counts = np.split(np.frombuffer(zlib.decompress(packed), np.int64), 2)
    return np.repeat(np.cumsum(ids), counts)


def distinct_pairs(doc_ids: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (document id, key) pairs, sorted."""
    order = np.lexsort((keys, doc_ids))
    doc_ids, keys = doc_ids[order], keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = (doc_ids[1:] != doc_ids[:-1]) | (keys[1:] != keys[:-1])
    return doc_ids[new], keys[new]


class PairSet:
    """Membership of (document id, key) pairs, by 64 bits of both."""

    def __init__(self, doc_ids: np.ndarray, keys: np.ndarray):
        self.pool = np.sort(mix(keys) + mix(doc_ids, 1))

    def has(self, doc_ids: np.ndarray, keys: np.ndarray) -> np.ndarray:
        if not len(self.pool):
            return np.zeros(len(keys), bool)
        wanted = mix(keys) + mix(doc_ids, 1)
        at = np.minimum(np.searchsorted(self.pool, wanted), len(self.pool) - 1)
        return self.pool[at] == wanted
