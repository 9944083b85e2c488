"""Repeated byte strings by distributed suffix sorting.

Equal strings must meet before their suffixes can be compared. So every string of
``length`` bytes has an anchor, the run of GRAM bytes in it with the least hash, which depends
on its content alone; neighbouring strings mostly share one. Anchors that occur once in all
texts can't belong to a repeat. The text around the others goes to the bucket of its
anchor, where its suffixes are sorted by a difference cover and neighbours compared.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstats.llm.arrays import U64, mix, text_bytes, text_slices
from tripstats.llm.groups import parts_for
from tripstats.llm.suffixes import shared_prefixes

LENGTH = 200
GRAM = 32
#: Bytes of text looked at together.
PIECE = 1 << 18
#: Bytes of passages whose suffixes are sorted together; those of one anchor always are.
SORT_BYTES = 1 << 18
#: An anchor with so many places is split: its strings go to buckets of their own hash.
HOT = 4096
#: Parts of the texts for each shuffle partition, at least, and bytes of their files in one.
PARTS, PART_BYTES = 1, 16 << 20
#: Buckets of passages for each shuffle partition; anchors, far less text, have one.
BUCKETS = 4

ANCHORED, PASSAGE, WINDOW, SETTLED = range(4)
SENT = "bucket int, part int, kind int, places binary, data binary"
SENT_ARROW = pa.schema(
    [("bucket", pa.int32()), ("part", pa.int32()), ("kind", pa.int32()), ("places", pa.binary()), ("data", pa.binary())]
)
FOUND = "of int, places binary, data binary"
FOUND_ARROW = pa.schema([("of", pa.int32()), ("places", pa.binary()), ("data", pa.binary())])
SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
RESULT = (
    "doc_id long, n_bytes long, n_removed long, "
    "repeats array<struct<start: long, end: long>>, kept binary"
)
RESULT_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_bytes", pa.int64()),
        ("n_removed", pa.int64()),
        ("repeats", SPANS),
        ("kept", pa.binary()),
    ]
)


def _table(rows: list, schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.Table.from_arrays([pa.array(x, f.type) for x, f in zip(columns, schema)], schema=schema)


def _rows(texts: pa.Table) -> pa.Table:
    """The rows of a part in an order that does not depend on how they came."""
    return texts.select(["doc_id", "text"]).sort_by([("doc_id", "ascending"), ("text", "ascending")])


def _pieces(texts: pa.Table, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
    """(bytes, where each text starts, number of the first row, place in its text).

    Texts come many at a time; one above PIECE alone, in pieces that overlap.
    """
    row = 0
    for batch in text_slices(_rows(texts).to_batches(), max_bytes=PIECE):
        data, offsets = text_bytes(batch["text"])
        if len(data) <= 2 * PIECE:
            yield data, offsets, row, 0
        else:
            for at in range(0, len(data) - length + 1, PIECE):
                piece = data[at : at + PIECE + length - 1]
                yield piece, np.array([0, len(piece)]), row, at
        row += batch.num_rows


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """64 bits of every GRAM bytes."""
    lanes = np.ndarray((len(data) - 7,), "<u8", data.tobytes(), strides=(1,))
    n = len(data) - GRAM + 1
    value = np.zeros(n, U64)
    for k, factor in zip(range(0, GRAM, 8), (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)):
        value += lanes[k : k + n] * U64(factor)
        value ^= value >> U64(29)
    return mix(value)


def _anchors(data: np.ndarray, offsets: np.ndarray, length: int):
    """(first, stop, key) of runs of strings with one anchor: places of strings in data."""
    n = len(data) - length + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U64)
    value = _gram_hashes(data)
    span, width = length - GRAM + 1, 1
    # high bits of the hash above the place: the least is an anchor, the first one on ties
    least = (value & U64(0xFFFFFFFF00000000)) | np.arange(len(value), dtype=U64)
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[:n], least[span - width : span - width + n])
    anchor = (least & U64(0xFFFFFFFF)).astype(np.int64)
    edge = np.zeros(len(data) + 1, np.int64)
    starts, stops = offsets[:-1], np.maximum(offsets[1:] - length + 1, offsets[:-1])
    np.add.at(edge, starts, 1)
    np.add.at(edge, stops, -1)
    own = np.flatnonzero(np.cumsum(edge)[:n] > 0)
    if not len(own):
        return own, own, value[:0]
    head = np.ones(len(own), bool)
    head[1:] = (own[1:] != own[:-1] + 1) | (anchor[own[1:]] != anchor[own[:-1]])
    heads = np.flatnonzero(head)
    last = np.r_[heads[1:], len(own)] - 1
    return own[heads], own[last] + 1, value[anchor[own[heads]]]


def _part_id(texts: pa.Table) -> int:
    return texts["part"][0].as_py()


def _send_anchors(texts: DataFrame, length: int, buckets: int) -> DataFrame:
    """The anchors of every part by bucket, with how often the part has each (up to 255)."""

    def run(rows: pa.Table) -> pa.Table:
        keys = [key for *piece, _, _ in _pieces(rows, length) for key in [_anchors(*piece, length)[2]]]
        known, n = np.unique(np.concatenate([np.zeros(0, U64), *keys]), return_counts=True)
        bucket = (known % U64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
        many = np.minimum(n, 255).astype(np.uint8)
        part, out = _part_id(rows), []
        for b in range(buckets):
            own = order[cuts[b] : cuts[b + 1]]
            if len(own):
                out.append((b, part, ANCHORED, many[own].tobytes(), known[own].tobytes()))
        return _table(out, SENT_ARROW)

    return texts.groupBy("part").applyInArrow(run, SENT)


def _met(anchors: DataFrame, hot: int) -> DataFrame:
    """By part, its anchors that occur twice or more, and which of them are hot."""

    def run(rows: pa.Table) -> pa.Table:
        keys = [np.frombuffer(x, U64) for x in rows["data"].to_pylist()]
        n = np.frombuffer(b"".join(rows["places"].to_pylist()), np.uint8)
        known, number = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(number, weights=n)[number]
        out, at = [], 0
        for part, own in zip(rows["part"].to_pylist(), keys):
            mine = total[at : at + len(own)]
            at += len(own)
            kept = mine > 1
            if kept.any():
                out.append((part, (mine[kept] >= hot).astype(np.uint8).tobytes(), own[kept].tobytes()))
        return _table(out, FOUND_ARROW)

    return anchors.groupBy("bucket").applyInArrow(run, FOUND)


def _window_hashes(data: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """16 bytes of the strings at these places, as two columns."""
    lanes = np.ndarray((len(data) - 7,), "<u8", data.tobytes(), strides=(1,))
    one, two = np.full(len(at), 1, U64), np.full(len(at), 2, U64)
    for k in [*range(0, length - 7, 8), length - 8]:
        own = lanes[at + k]
        one = mix(one ^ own, 3)
        two = mix(two + own, 4)
    return np.stack([one, two], axis=1)


def _send_texts(texts: DataFrame, met: DataFrame, length: int, buckets: int) -> DataFrame:
    """The text around every anchor met, to the anchor's bucket.

    A part sends each passage once. One that it has twice is settled there: all its strings
    repeat. So a passage in a third of all documents costs each part one row. Strings of hot
    anchors go by their own hash, each once, for what surrounds a hot passage differs
    from text to text and would all meet in one bucket.
    """

    def run(rows: pa.Table, found: pa.Table) -> pa.Table:
        if not rows.num_rows or not found.num_rows:
            return SENT_ARROW.empty_table()
        keys = np.frombuffer(b"".join(found["data"].to_pylist()), U64)
        is_hot = np.frombuffer(b"".join(found["places"].to_pylist()), np.uint8) > 0
        order = np.argsort(keys)
        keys, is_hot = keys[order], is_hot[order]
        part = _part_id(rows)
        passages: dict[bytes, list] = {}
        settled, strings, string_places = [], [], []
        for data, offsets, row, base in _pieces(rows, length):
            first, stop, key = _anchors(data, offsets, length)
            at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            hit = keys[at] == key
            first, stop, key, hot = first[hit], stop[hit], key[hit], is_hot[at[hit]]
            doc = np.searchsorted(offsets, first, "right") - 1
            doc = np.minimum(doc, len(offsets) - 2)
            shift = base - offsets[doc]  # from places in data to places in the text
            if hot.any():
                size = (stop - first)[hot]
                own = np.repeat(first[hot] - np.cumsum(size) + size, size) + np.arange(size.sum())
                strings.append(_window_hashes(data, own, length))
                string_places.append(np.stack([np.repeat(row + doc[hot], size), own + np.repeat(shift[hot], size)], axis=1))
            raw = data.tobytes()
            scrambled = mix(key, 3)
            bucket = (scrambled % U64(buckets)).astype(np.int64)
            anchor = (scrambled >> U64(32)).astype(np.int64)
            cold = np.flatnonzero(~hot)
            columns = (cold, first[cold], stop[cold], bucket[cold], anchor[cold])
            for i, a, b, *of in zip(*(x.tolist() for x in columns)):
                place = (row + int(doc[i]), a + int(shift[i]), b + int(shift[i]))
                known = passages.setdefault(raw[a : b - 1 + length], [of, place, False])
                if known[1] != place:
                    if not known[2]:
                        settled.append(known[1])
                        known[2] = True
                    settled.append(place)
        by_bucket = defaultdict(list)
        for content, ((bucket, anchor), place, twice) in passages.items():
            by_bucket[bucket].append((*place, twice, anchor, content))
        out = []
        for bucket, own in by_bucket.items():
            places = np.array([x[:5] for x in own], "<i8").tobytes()
            out.append((bucket, part, PASSAGE, places, b"".join(x[5] for x in own)))
        if strings:
            both, places = np.concatenate(strings), np.concatenate(string_places)
            order = np.lexsort((both[:, 1], both[:, 0]))
            both, places = both[order], places[order]
            new = np.ones(len(both), bool)
            new[1:] = (both[1:] != both[:-1]).any(1)
            twice = ~new
            twice[:-1] |= ~new[1:]
            settled += [(r, p, p + 1) for r, p in places[twice].tolist()]
            both, places, twice = both[new], places[new], twice[new]
            # they are few next to passages, and so are their buckets
            bucket = (both[:, 0] % U64(max(buckets // BUCKETS, 1))).astype(np.int64)
            for b in np.unique(bucket).tolist():
                own = bucket == b
                rest = np.column_stack([places[own], places[own][:, 1] + 1, twice[own]]).astype("<i8")
                out.append((b, part, WINDOW, rest.tobytes(), both[own].tobytes()))
        if settled:
            out.append((part % buckets, part, SETTLED, np.array(settled, "<i8").tobytes(), b""))
        return _table(out, SENT_ARROW)

    return texts.groupBy("part").cogroup(met.groupBy("of")).applyInArrow(run, SENT)


def _shared(contents: list[bytes], anchors: list[int], length: int) -> list[np.ndarray]:
    """shared_prefixes of the passages of each anchor, for some anchors at a time."""
    out: list = [None] * len(contents)
    batch, size, last = [], 0, None
    for i in [*sorted(range(len(contents)), key=anchors.__getitem__), None]:
        if batch and (i is None or size > SORT_BYTES and anchors[i] != last):
            for k, found in zip(batch, shared_prefixes([contents[k] for k in batch], length)):
                out[k] = found
            batch, size = [], 0
        if i is not None:
            batch.append(i)
            size, last = size + len(contents[i]), anchors[i]
    return out


def _repeated(sent: DataFrame, length: int) -> DataFrame:
    """By part, the places (row, first, stop) of strings that repeat."""

    def windows(rows: pa.Table) -> dict[int, list]:
        out = defaultdict(list)
        if not rows.num_rows:
            return out
        places = [np.frombuffer(x, "<i8").reshape(-1, 4) for x in rows["places"].to_pylist()]
        both = np.frombuffer(b"".join(rows["data"].to_pylist()), U64).reshape(-1, 2)
        part = np.repeat(rows["part"].to_numpy(), [len(x) for x in places])
        places = np.concatenate(places)
        order = np.lexsort((both[:, 1], both[:, 0]))
        new = np.ones(len(both), bool)
        new[1:] = (both[order][1:] != both[order][:-1]).any(1)
        group = np.empty(len(both), np.int64)
        group[order] = np.cumsum(new) - 1
        twice = (np.bincount(group) > 1)[group] & (places[:, 3] == 0)
        for p in np.unique(part[twice]).tolist():
            out[p].append(places[twice & (part == p)][:, :3])
        return out

    def passages(rows: pa.Table) -> dict[int, list]:
        contents: dict[bytes, int] = {}
        records, copies, anchors = [], [], []
        for part, places, data in zip(*(rows[x].to_pylist() for x in ("part", "places", "data"))):
            at = 0
            for row, first, stop, settled, anchor in np.frombuffer(places, "<i8").reshape(-1, 5).tolist():
                size = stop - first - 1 + length
                number = contents.setdefault(data[at : at + size], len(contents))
                at += size
                if number == len(copies):
                    copies.append(0)
                    anchors.append(anchor)
                copies[number] += 1 + settled
                if not settled:
                    records.append((part, row, first, stop, number))
        shared = _shared(list(contents), anchors, length)
        out = defaultdict(list)
        for part, row, first, stop, number in records:
            if copies[number] > 1:
                out[part].append([(row, first, stop)])
            elif (own := shared[number]).any():
                turn = np.flatnonzero(np.diff(np.r_[False, own, False])).reshape(-1, 2)
                out[part].append([(row, first + a, first + b) for a, b in turn.tolist()])
        return out

    def run(rows: pa.Table) -> pa.Table:
        kind = {k: rows.filter(pc.equal(rows["kind"], k)) for k in (PASSAGE, WINDOW, SETTLED)}
        out = []
        for found in (passages(kind[PASSAGE]), windows(kind[WINDOW])):
            for part, places in found.items():
                out.append((part, np.concatenate(places).astype("<i8").tobytes(), b""))
        settled = kind[SETTLED]
        out += [(p, x, b"") for p, x in zip(settled["part"].to_pylist(), settled["places"].to_pylist())]
        return _table(out, FOUND_ARROW)

    return sent.groupBy("bucket").applyInArrow(run, FOUND)


def _cut(texts: DataFrame, repeated: DataFrame, length: int) -> DataFrame:
    """Bytes, removed bytes, their spans and the bytes kept of every document."""

    def run(rows: pa.Table, found: pa.Table) -> pa.Table:
        rows = _rows(rows)
        places = np.frombuffer(b"".join(found["places"].to_pylist()), "<i8").reshape(-1, 3)
        places = places[np.lexsort((places[:, 1], places[:, 0]))]
        cuts = np.searchsorted(places[:, 0], np.arange(rows.num_rows + 1))
        out = []
        for i, (doc_id, text) in enumerate(zip(rows["doc_id"].to_pylist(), rows["text"].cast(pa.binary()).to_pylist())):
            text = text or b""
            own = places[cuts[i] : cuts[i + 1]]
            if not len(own):
                out.append((doc_id, len(text), 0, [], text))
                continue
            reach = np.maximum.accumulate(own[:, 2] - 1 + length)
            opens = np.r_[True, own[1:, 1] > reach[:-1]]
            start, end = own[opens, 1].tolist(), reach[np.r_[opens[1:], True]].tolist()
            kept = b"".join(text[a:b] for a, b in zip([0, *end], [*start, len(text)]))
            spans = [{"start": a, "end": b} for a, b in zip(start, end)]
            out.append((doc_id, len(text), len(text) - len(kept), spans, kept))
        return _table(out, RESULT_ARROW)

    return texts.groupBy("part").cogroup(repeated.groupBy("of")).applyInArrow(run, RESULT)


def remove_substrings(
    docs: DataFrame,
    length: int = LENGTH,
    hot: int = HOT,
    parts: int | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Remove every byte that a string of ``length`` bytes covers which also begins elsewhere.

    Texts are UTF-8 bytes; elsewhere is any other place of any text, the same one included;
    strings don't cross texts, may overlap, and are judged on the input. ``length`` is at least
    twice GRAM. Texts cross the network once, dealt to ``parts`` (default: PARTS for each shuffle
    partition, more where one would hold over PART_BYTES); passages around anchors go to
    ``buckets`` (BUCKETS for each). A task holds one part or one bucket at a time. Anchors with
    ``hot`` places or more are split by string.

    A null text is empty; a null doc_id stays null; repeated rows are documents of their own, so
    long ones remove each other; an empty table gives no rows; other columns are not read. A
    long text is looked at PIECE by PIECE. Returns doc_id, n_bytes, n_removed, repeats
    (byte spans of the maximal removed runs, end exclusive) and kept (the remaining bytes).
    Passages are compared by content; strings of hot anchors by 128 hash bits.
    """
    if length < 2 * GRAM:
        raise ValueError(f"length must be at least {2 * GRAM}")
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts, buckets = parts or parts_for(docs, PARTS, PART_BYTES), buckets or BUCKETS * partitions
    part = F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts)).cast("int").alias("part")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").select("doc_id", "text", part)
    met = _met(_send_anchors(texts, length, partitions), hot)
    repeated = _repeated(_send_texts(texts, met, length, buckets), length)
    return _cut(texts, repeated, length)
