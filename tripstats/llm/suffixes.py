"""Suffix order by the difference-cover algorithm, on whole arrays.

The suffixes that begin at places 1 and 2 modulo 3 are a difference cover: any two places
reach it together within two steps. Their triples of symbols are sorted and named; while two
triples share a name, the string of names is sorted the same way. The remaining suffixes are
sorted by a symbol and the rank behind it, and merged in.
"""

from __future__ import annotations

import numpy as np

from tripstats.llm.arrays import U64


def _keys(*columns: np.ndarray) -> np.ndarray:
    """A number for each row that orders rows as their columns do, first column first."""
    bits = [int(x.max(initial=0)).bit_length() for x in columns]
    if sum(bits) <= 63:
        key = np.zeros(len(columns[0]), np.int64)
        for x, n in zip(columns, bits):
            key = (key << n) | x
        return key
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), bool)
    for x in columns:
        own = x[order]
        new[1:] |= own[1:] != own[:-1]
    key = np.zeros(len(order), np.int64)
    key[order] = np.cumsum(new)
    return key


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """The places of all suffixes of positive whole numbers, in order."""
    n = len(symbols)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: symbols[i:].tolist()), np.int64)
    s = np.concatenate([symbols.astype(np.int64), np.zeros(4, np.int64)])
    m = n + (n % 3 == 1)  # one suffix of nothing, so that those at 1 modulo 3 end apart
    ones, twos, zeros = np.arange(1, m, 3), np.arange(2, m, 3), np.arange(0, n, 3)
    sample = np.concatenate([ones, twos])
    triples = _keys(s[sample], s[sample + 1], s[sample + 2])
    names, name = np.unique(triples, return_inverse=True)
    if len(names) == len(sample):
        in_order = np.empty(len(sample), np.int64)
        in_order[name] = np.arange(len(sample))
    else:
        in_order = suffix_array(name + 1)
    rank = np.zeros(n + 4, np.int64)
    rank[sample[in_order]] = np.arange(1, len(sample) + 1)
    sample = sample[in_order]
    sample = sample[sample < n]

    after_one = _keys(s[:n], rank[1 : n + 1])
    zeros = zeros[np.argsort(after_one[zeros], kind="stable")]
    after_two = _keys(s[:n], s[1 : n + 1], rank[2 : n + 2])
    before = np.arange(len(zeros))
    is_one = sample % 3 == 1
    before += np.searchsorted(after_one[sample[is_one]], after_one[zeros])
    before += np.searchsorted(after_two[sample[~is_one]], after_two[zeros])
    out = np.empty(n, np.int64)
    rest = np.ones(n, bool)
    rest[before] = False
    out[before], out[rest] = zeros, sample
    return out


def shared_prefixes(texts: list[bytes], length: int) -> list[np.ndarray]:
    """For every text, which of its places begin ``length`` bytes that begin at another place
    too, here or in another of the texts.

    Suffixes end with their text; neighbours in the order are compared byte by byte, so no
    answer rests on a hash.
    """
    sizes = np.array([len(x) for x in texts], np.int64)
    ends = np.cumsum(sizes + 1) - 1
    data = np.frombuffer(b"\0".join([*texts, b""]), np.uint8)
    symbols = data.astype(np.int64) + 1
    symbols[ends] = 257 + np.arange(len(texts))  # an end of its own for each text
    order = suffix_array(symbols)
    left = np.repeat(ends, sizes + 1) - np.arange(len(data))
    order = order[left[order] >= length]
    a, b = order[:-1], order[1:]
    whole = data.tobytes() + bytes(8)
    lanes = np.ndarray((len(data) + 1,), "<u8", whole, strides=(1,))
    same = np.arange(len(a))
    for k in [*range(0, length - 7, 8), *([length - 8] if length % 8 and length > 8 else [])]:
        same = same[lanes[a[same] + k] == lanes[b[same] + k]]
    if length < 8:
        low = U64((1 << 8 * length) - 1)
        same = same[(lanes[a[same]] & low) == (lanes[b[same]] & low)]
    found = np.zeros(len(data), bool)
    found[a[same]] = found[b[same]] = True
    return np.split(found, ends + 1)[:-1]
