"""Counting quotient filters over packed word-id n-grams, lossless and sorted.

An n-gram is a number: its ids side by side in fields of ``id_bits``. A Feistel network
permutes these numbers, so they spread evenly and the permutation can be undone. The high
bits of a permuted number name a bucket, the next ones its quotient in the bucket's
filter, and all bits that are left are the remainder. Nothing is dropped, so a filter
counts exactly and gives its n-grams back.
"""

from __future__ import annotations

import struct
from typing import NamedTuple

import numpy as np

from tripstats.llm.arrays import U64, mix

ROUNDS = 4
#: Ids of three words take two halves of 63 bits.
MOST_ID_BITS = 42


class Counts(NamedTuple):
    """Distinct permuted n-grams as two halves, in order, and how often each occurs."""

    left: np.ndarray
    right: np.ndarray
    n: np.ndarray


class Permutation:
    """One-to-one scrambling of (first, second, third) with ids below 2 ** id_bits."""

    def __init__(self, id_bits: int):
        if id_bits > MOST_ID_BITS:
            raise ValueError(f"word ids of {id_bits} bits do not fit")
        self.id_bits = id_bits
        self.half = (3 * id_bits + 1) // 2
        self.mask = U64((1 << self.half) - 1)

    def of(self, first: np.ndarray, second: np.ndarray, third: np.ndarray):
        """(left, right) of n-grams; a third id of 0 stands for none."""
        first, second, third = (x.astype(U64) for x in (first, second, third))
        b, h = self.id_bits, self.half
        low = U64(h - b)
        left = first << U64(2 * b - h) | second >> low
        right = (second & ((U64(1) << low) - U64(1))) << U64(b) | third
        for k in range(ROUNDS):
            left, right = right, left ^ (mix(right, k) & self.mask)
        return left, right

    def undone(self, left: np.ndarray, right: np.ndarray):
        """The ids of what ``of`` gave."""
        for k in reversed(range(ROUNDS)):
            left, right = right ^ (mix(left, k) & self.mask), left
        b, h = self.id_bits, self.half
        low = U64(h - b)
        ids = U64((1 << b) - 1)
        first = left >> U64(2 * b - h)
        second = (left << low | right >> U64(b)) & ids
        return tuple(x.astype(np.int64) for x in (first, second, right & ids))


def counted(left: np.ndarray, right: np.ndarray, n: np.ndarray | None = None) -> Counts:
    """Equal n-grams added up, in order."""
    order = np.lexsort((right, left))
    left, right = left[order], right[order]
    new = np.ones(len(left), bool)
    new[1:] = (left[1:] != left[:-1]) | (right[1:] != right[:-1])
    heads = np.flatnonzero(new)
    if n is None:
        total = np.diff(np.r_[heads, len(left)])
    else:
        total = np.add.reduceat(n[order], heads) if len(heads) else n[:0]
    return Counts(left[heads], right[heads], total)


def merged(parts: list[Counts]) -> Counts:
    """Sorted counts of several shards as one."""
    return counted(*(np.concatenate(x) for x in zip(*parts)))


def _to_planes(values: np.ndarray, width: int) -> bytes:
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _from_planes(data: bytes, n: int, width: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(n, width)
    return out.reshape(-1).view("<u8")


_HEAD = "<IIBBB"


def to_filter(found: Counts, left_bits: int) -> bytes:
    """A filter of sorted counts, whose left halves have ``left_bits`` bits.

    Head: entries, counters above a byte, quotient bits, and bytes of the two remainder parts.
    Then a bit for each quotient (is it taken), a bit for each entry (is it the last of its
    quotient), the remainders, a counter byte for each entry, and the counters that a byte
    can't hold (255 in it).
    """
    n = len(found.left)
    q = min(left_bits, n.bit_length())
    rest = U64(left_bits - q)
    quotient = (found.left >> rest).astype(np.int64) if q else np.zeros(n, np.int64)
    remainder = found.left & ((U64(1) << rest) - U64(1)) if rest < 64 else found.left
    taken = np.zeros(1 << q, bool)
    taken[quotient] = True
    last = np.ones(n, bool)
    last[:-1] = quotient[1:] != quotient[:-1]
    widths = [(max(int(x.max(initial=0)), 0).bit_length() + 7) // 8 for x in (remainder, found.right)]
    many = found.n[found.n >= 255].astype("<i8")
    return b"".join(
        [
            struct.pack(_HEAD, n, len(many), q, *widths),
            np.packbits(taken).tobytes(),
            np.packbits(last).tobytes(),
            _to_planes(remainder, widths[0]),
            _to_planes(found.right, widths[1]),
            np.minimum(found.n, 255).astype(np.uint8).tobytes(),
            many.tobytes(),
        ]
    )


def from_filter(data: bytes, left_bits: int) -> Counts:
    """The sorted counts that a filter holds."""
    n, n_many, q, *widths = struct.unpack_from(_HEAD, data)
    sizes = [((1 << q) + 7) // 8, (n + 7) // 8, n * widths[0], n * widths[1], n, 8 * n_many]
    at, parts = struct.calcsize(_HEAD), []
    for size in sizes:
        parts.append(data[at : at + size])
        at += size
    taken = np.flatnonzero(np.unpackbits(np.frombuffer(parts[0], np.uint8), count=1 << q))
    last = np.unpackbits(np.frombuffer(parts[1], np.uint8), count=n).astype(np.int64)
    quotient = taken[np.cumsum(last) - last].astype(U64)
    remainder, right = (_from_planes(p, n, w) for p, w in zip(parts[2:4], widths))
    left = quotient << U64(left_bits - q) | remainder if q else remainder
    counts = np.frombuffer(parts[4], np.uint8).astype(np.int64)
    counts[counts == 255] = np.frombuffer(parts[5], "<i8")
    return Counts(left, right, counts)


def split(found: Counts, half: int, bucket_bits: int):
    """Yield (bucket, filter) of sorted counts: buckets are ranges of the left half."""
    bits = min(bucket_bits, half)
    low = U64(half - bits)
    bucket = (found.left >> low).astype(np.int64)
    cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else []
    for i, j in zip(cuts, [*cuts[1:], len(bucket)]):
        own = Counts(*(x[i:j] for x in found))
        inside = own._replace(left=own.left & ((U64(1) << low) - U64(1)))
        yield int(bucket[i]), to_filter(inside, half - bits)


def joined(bucket: int, data: bytes, half: int, bucket_bits: int) -> Counts:
    """What ``split`` gave for a bucket, with the bucket's bits in place again."""
    bits = min(bucket_bits, half)
    found = from_filter(data, half - bits)
    return found._replace(left=found.left | U64(bucket << (half - bits)))
