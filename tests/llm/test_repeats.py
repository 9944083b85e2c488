"""Fixed-block anchors against a brute-force search."""

import random

import pytest
from corpus_frames import WORD, documents, odd_documents, prose

from tripstats.llm.repeats import remove_repeats


def brute(rows, length):
    first = {}
    words = [(d, WORD.findall(t or "")) for d, t in rows]
    for d, w in words:
        for i in range(len(w) - length + 1):
            key = tuple(w[i : i + length])
            first[key] = min(first.get(key, d), d)
    out = {}
    for d, w in words:
        gone = set()
        for i in range(len(w) - length + 1):
            if first[tuple(w[i : i + length])] < d:
                gone.update(range(i, i + length))
        out[d] = (len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone))
    return out


@pytest.mark.parametrize("length", [13, 6, 3])
def test_as_brute_force(spark, length):
    rng = random.Random(length)
    passage = [prose(rng, n) for n in (12, 13, 14, 30, 60)]
    texts = []
    for _ in range(120):
        parts = [prose(rng, rng.randrange(0, 40)) for _ in range(3)]
        for p in rng.sample(passage, rng.randrange(0, 3)):
            parts.insert(rng.randrange(len(parts)), p)
        texts.append(rng.choice([" ", "\n", "\t "]).join(parts))
    texts += [texts[5]] * 4 + [passage[3] + " " + passage[3]]
    ids = rng.sample(range(-50, 5000), len(texts))
    rows = list(zip(ids, texts))
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in remove_repeats(documents(spark, rows), length).collect()}
    assert got == brute(rows, length)


def test_spans_are_maximal_repeats(spark):
    a, b = prose(random.Random(1), 40), prose(random.Random(2), 30)
    rows = remove_repeats(documents(spark, [a, b + " " + a + " " + b])).collect()
    later = next(r for r in rows if r.doc_id == 1)
    assert [(s.start, s.end) for s in later.repeats] == [(30, 70)]
    assert later.kept_text == b + " " + b


def test_windows_are_judged_on_the_input(spark):
    # the third text shares windows with the second only where the second itself loses them
    a, b = prose(random.Random(3), 20), prose(random.Random(4), 20)
    rows = {r.doc_id: r for r in remove_repeats(documents(spark, [a, a + " " + b, b])).collect()}
    assert rows[1].kept_text == b and rows[2].kept_text == ""


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = remove_repeats(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        if r.doc_id is None:
            assert r.n_removed == 0
    long = next(r for r in rows if r.doc_id == 8)
    assert (long.n_words, long.n_removed) == (48_000, 0)  # repeats inside a text are no matter
    assert remove_repeats(docs.limit(0)).collect() == []


def test_a_passage_in_every_document(spark):
    shared = prose(random.Random(9), 25)
    texts = [f"{prose(random.Random(100 + i), 10)} {shared}" for i in range(300)]
    rows = remove_repeats(documents(spark, texts)).collect()
    assert sum(r.n_removed >= 25 for r in rows) == 299


def test_a_part_sends_a_key_once():
    """However many of its documents hold it, and whichever they are."""
    import numpy as np
    import pyarrow as pa

    from tripstats.llm.repeats import PASSAGES, Part

    rng = random.Random(6)
    passage = prose(rng, 30, 9000)
    texts = [f"{prose(rng, 5, 9000)} {passage} {prose(rng, 5, 9000)}" for _ in range(300)]
    rows = pa.table({"doc_id": list(range(300)), "text": texts, "part": pa.array([2] * 300, pa.int32())})
    part = Part(rows, 7, 13, 4)
    sent = part.block_rows()
    found = [(2, 0, b, np.packbits(np.ones(len(k) // 4, bool)).tobytes()) for b, _, _, k in sent]
    part.passages(pa.table([list(x) for x in zip(*found)], names=["of", "step", "bucket", "bits"]))
    n = sum(len(k) // 12 for *_, k in part.passage_rows())
    windows = {tuple(w[i : i + 13]) for w in map(str.split, texts) for i in range(len(w) - 12)}
    assert n == len(windows) < 300 * 13
    assert sum(len(k) // 4 for *_, k in sent) == len({tuple(w[i : i + 7]) for w in map(str.split, texts) for i in range(len(w) - 6)})
    none = pa.table([[], [], [], []], names=["of", "step", "bucket", "bits"])
    hit = part.repeated(none)  # within the part all but the first document lose the passage
    seen, later = set(), 0
    for w in map(str.split, texts):
        own = [tuple(w[i : i + 13]) for i in range(len(w) - 12)]
        later += sum(x in seen for x in own)
        seen.update(own)
    assert len(np.concatenate(hit)) == later >= 299 * 18
    assert PASSAGES == 1
