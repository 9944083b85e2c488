"""What a Python worker holds while it works, and that it gives it back."""

import platform
import random
import tracemalloc
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from corpus_frames import prose

from tripstats.llm import arrays, jaccard, packing

WORDS, PER_TEXT = 700_000, 700


class Frame:
    """Stands for a frame of documents; gives the function of mapInArrow to the test."""

    def __init__(self, *dtypes):
        self.dtypes = list(dtypes)

    def __getitem__(self, column):
        return self

    def select(self, *columns):
        return self

    alias = cast = select

    def mapInArrow(self, run, schema):
        return run


def one_batch():
    """One batch of several slices: its rows, and the bytes of its texts."""
    words = prose(random.Random(1), WORDS, 20_000).split()
    texts = [" ".join(words[i : i + PER_TEXT]) for i in range(0, WORDS, PER_TEXT)]
    ids = list(range(len(texts)))
    hashes = pa.array(ids, pa.int64())
    return pa.record_batch({"doc_id": ids, "text_hash": hashes, "text": texts}), sum(map(len, texts))


def traced_peak(rows) -> tuple[int, int]:
    """The number of rows, and the most bytes that Python and numpy held while they were made."""
    tracemalloc.start()
    try:
        made = sum(x.num_rows for x in rows)
        return made, tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_packing_holds_a_small_slice(monkeypatch):
    class Task:
        get = classmethod(lambda cls: cls)
        partitionId = staticmethod(lambda: 0)

    monkeypatch.setattr(packing, "TaskContext", Task)
    batch, size = one_batch()
    made, peak = traced_peak(packing.pack(Frame(), checksums=True)(iter([batch])))
    assert made >= batch.num_rows
    assert peak < 10 * size  # was 18 times at this size


def test_shingles_hold_a_small_slice():
    batch, size = one_batch()
    frame = Frame(("doc_id", "bigint"), ("text_hash", "bigint"), ("text", "string"))
    for run in (jaccard._sketches(frame, 5), jaccard._with_shingles(frame, 5)):
        made, peak = traced_peak(run(iter([batch])))
        assert made == batch.num_rows
        assert peak < 11 * size


def test_a_part_of_anchors_holds_few_bytes_a_word():
    from tripstats.llm.repeats import SENT_ARROW, Part, _batch

    batch, _ = one_batch()
    rows = pa.Table.from_batches([batch]).append_column("part", pa.array([1] * batch.num_rows, pa.int32()))
    kept = []

    def sent():
        kept.append(Part(rows, 7, 13, 12))
        yield _batch(kept[0].block_rows(), SENT_ARROW)

    _, peak = traced_peak(sent())
    assert peak < 75 * WORDS  # was 99
    held = chain.from_iterable((x.start, x.end, x.doc, x.first, x.hash) for x in kept[0].words)
    assert sum(x.nbytes for x in held) < 15 * WORDS  # was 32


@pytest.mark.skipif(platform.libc_ver()[0] != "glibc", reason="other memory allocators")
def test_what_is_free_goes_back():
    def used():
        return int(Path("/proc/self/statm").read_text().split()[1]) * 4096

    own = [np.ones(10_000, np.uint8) for _ in range(20_000)]  # too small to be mapped alone
    own = own[::100]  # what stays keeps the heap long
    before = used()
    (batch,) = arrays.text_slices(iter([pa.record_batch({"text": ["a b"]})]))
    assert batch.num_rows == 1 and len(own) == 200
    assert before - used() > 100 << 20
