"""Repeated byte strings: suffix order and removal against brute force, odd rows."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from corpus_frames import ODD, documents, odd_documents, prose

from tripstats.llm import queries
from tripstats.llm import substrings as S
from tripstats.llm.suffixes import shared_prefixes, suffix_array

SF_DIR = "/root/testdata/sf0.001"


def plain(texts, length=200):
    """(n_bytes, n_removed, n_spans, kept) of every text."""
    texts = [(x or "").encode() for x in texts]
    count = Counter(x[i : i + length] for x in texts for i in range(len(x) - length + 1))
    out = []
    for x in texts:
        gone = bytearray(len(x))
        for i in range(len(x) - length + 1):
            if count[x[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(c for c, g in zip(x, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(x), sum(gone), spans, kept))
    return out


def found(df):
    rows = df.collect()
    for r in rows:
        assert r.n_removed == sum(s.end - s.start for s in r.repeats) == r.n_bytes - len(r.kept)
        assert all(a.end < b.start for a, b in zip(r.repeats, r.repeats[1:]))
    return Counter((r.doc_id, r.n_bytes, r.n_removed, len(r.repeats), bytes(r.kept)) for r in rows)


def expected(docs, length=200):
    rows = docs.collect()
    return Counter((r.doc_id, *x) for r, x in zip(rows, plain([r.text for r in rows], length)))


@pytest.mark.parametrize("alphabet", [1, 2, 5, 1 << 40])
def test_suffix_order(alphabet):
    rng = np.random.default_rng(alphabet % 97)
    for n in [0, 1, 2, 3, 4, 5, 6, 7, 50, 51, 52, 400]:
        s = rng.integers(1, alphabet + 1, n)
        assert suffix_array(s).tolist() == sorted(range(n), key=lambda i: s[i:].tolist())


@pytest.mark.parametrize("length", [3, 8, 13, 24])
def test_shared_prefixes(length):
    rng = random.Random(length)
    texts = [bytes(rng.choice(b"ab\0") for _ in range(rng.randrange(60))) for _ in range(30)] + [b"", b"a" * 70]
    count = Counter(x[i : i + length] for x in texts for i in range(len(x) - length + 1))
    for x, own in zip(texts, shared_prefixes(texts, length)):
        assert [i for i in range(len(x)) if own[i]] == [i for i in range(len(x) - length + 1) if count[x[i : i + length]] > 1]


def mosaic(seed, n=60):
    """Texts that share passages of many lengths, in themselves too, cut within letters."""
    rng = random.Random(seed)
    pool = [prose(rng, 90, 9000) + "é日" * rng.randrange(40) for _ in range(12)]
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randrange(5)):
            x = rng.choice(pool)
            a = rng.randrange(len(x))
            parts += [x[a : a + rng.randrange(20, 420)], prose(rng, rng.randrange(30), 9000)]
        texts.append("".join(parts))
    return texts + [texts[3], texts[3], None, "", "ab" * 150, "c" * 199, "c" * 150 + "d", "q" * 201]


@pytest.mark.parametrize("hot, parts, buckets", [(4096, 7, 3), (2, 5, 4), (6, 1, 1)])
def test_same_as_plain(spark, hot, parts, buckets):
    docs = documents(spark, mosaic(hot) + [(2, "z " * 130), (None, "z " * 140)])
    assert found(S.remove_substrings(docs, 200, hot, parts, buckets)) == expected(docs)


def test_short_strings_and_small_batches(spark, monkeypatch):
    docs = documents(spark, mosaic(5, 25))
    assert found(S.remove_substrings(docs, 64, 9, 3, 2)) == expected(docs, 64)
    with pytest.raises(ValueError, match="at least"):
        S.remove_substrings(docs, 63)


def test_pieces_of_a_long_text():
    import pyarrow as pa

    rng = random.Random(1)
    text = prose(rng, 900, 9000).encode()
    whole = S._anchors(np.frombuffer(text, np.uint8), np.array([0, len(text)]), 200)
    size, S.PIECE = S.PIECE, 500
    try:
        table = pa.table({"doc_id": [1, 2], "text": ["short", text.decode()]})
        pieces = [(base, S._anchors(d, o, 200)) for d, o, row, base in S._pieces(table, 200) if row == 1]
    finally:
        S.PIECE = size
    assert len(pieces) > 3
    by_place = lambda runs: {(base + i): k for base, (a, b, key) in runs for x, y, k in zip(a, b, key) for i in range(x, y)}
    assert by_place(pieces) == by_place([(0, whole)])
    assert len(by_place(pieces)) == len(text) - 199


def test_query_same_as_plain(spark):
    df = queries.op13_suffix_dedup(spark, SF_DIR)
    assert df.dtypes[:5] == [("doc_id", "bigint"), ("n_bytes", "bigint"), ("n_removed", "bigint"), ("n_spans", "bigint"), ("kept_sha256", "string")]
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    want = Counter(
        (r.doc_id, a, b, c, hashlib.sha256(kept).hexdigest())
        for r, (a, b, c, kept) in zip(rows, plain([r.text for r in rows]))
    )
    assert Counter(tuple(r[:5]) for r in df.collect()) == want
    assert sum(b > 0 for _, _, b, _, _ in want) > 5


def test_odd_rows(spark):
    docs = odd_documents(spark)
    got = found(S.remove_substrings(docs))
    assert got == expected(docs) and sum(got.values()) == len(ODD) + 4
    assert S.remove_substrings(docs.limit(0)).collect() == []
