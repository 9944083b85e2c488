"""Importance resampling against a plain computation, by hand and on odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from corpus_frames import documents, odd_documents, prose

from tripstats.llm import importance as I
from tripstats.llm import queries

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SMALL = {c: c + 32 for c in range(65, 91)}


def plain_features(text):
    words = WORD.findall((text or "").translate(SMALL))
    grams = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(x.encode()) for x in grams]


def plain_resample(docs, target, percent=5, min_words=20, buckets=10_000):
    """docs: (doc_id, text). Returns {(doc_id, n_words, n_features, weight, score, rank)}."""
    found = [(d, *plain_features(x)) for d, x in docs]
    own = Counter(c % buckets for _, _, cs in found for c in cs)
    aim = Counter(c % buckets for x in target for c in plain_features(x)[1])
    S, T = float(sum(own.values())), float(sum(aim.values()))
    gain = [
        math.floor(1000 * math.log((aim[b] + 1.0) * (S + buckets) / ((own[b] + 1.0) * (T + buckets))))
        for b in range(buckets)
    ]
    rows = []
    for d, n, cs in found:
        weight = sum(gain[c % buckets] for c in cs)
        h = int(hashlib.sha256(f"42:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((d, n, len(cs), weight, score))
    able = sorted((-r[4], r[0] is None, r[0] or 0, r[1], r[2], i) for i, r in enumerate(rows) if r[1] >= min_words)
    rank = {x[-1]: k + 1 for k, x in enumerate(able[: percent * len(able) // 100])}
    return Counter((*r, rank.get(i)) for i, r in enumerate(rows))


def test_checksums_join():
    rng = random.Random(4)
    parts = [(bytes(rng.randrange(256) for _ in range(rng.choice([1, 3, 60, 300]))), b"x" * rng.choice([0, 1, 7, 5000])) for _ in range(50)]
    left, right = (np.array([zlib.crc32(x[k]) for x in parts], np.uint32) for k in (0, 1))
    joined = I.joined_crc(left, right, np.array([len(b) for _, b in parts]))
    assert joined.tolist() == [zlib.crc32(a + b) for a, b in parts]


def test_features_do_not_cross_texts():
    texts = ["Über A-b 3", "", "one", "  ", "x\0y z", "日本 and Ā", "last words here"]
    words, sums, doc = I.features([x.encode() for x in texts])
    for i, x in enumerate(texts):
        n, expected = plain_features(x)
        assert words[i] == n and sorted(sums[doc == i].tolist()) == sorted(expected)


def as_counter(df):
    return Counter((r.doc_id, r.n_words, r.n_features, r.weight, r.score, r["rank"]) for r in df.collect())


@pytest.mark.parametrize("percent", [0, 5, 50, 100])
def test_same_as_plain(spark, percent):
    rng = random.Random(percent)
    texts = [prose(rng, rng.randrange(0, 60), 300) for _ in range(150)]
    texts += [(7, texts[7]), (500, texts[7]), (None, texts[9])]  # repeated rows, ties, no id
    docs = documents(spark, texts)
    target = [prose(rng, 30, 100) for _ in range(9)] + [None]
    aim = spark.createDataFrame([(i, x) for i, x in enumerate(target)], "item_id long, text string")
    found = as_counter(I.resample(docs, aim, percent=percent))
    assert found == plain_resample([(r.doc_id, r.text) for r in docs.collect()], target, percent)


def test_query_same_as_plain(spark):
    found = queries.op11_importance_resampling(spark, SF_DIR)
    assert found.columns[:5] == ["doc_id", "n_features", "weight", "score", "rank"]
    assert {t for _, t in found.dtypes} == {"bigint"}
    docs, target = (spark.read.parquet(f"{SF_DIR}/{x}.parquet").collect() for x in ("documents", "benchmark"))
    expected = plain_resample([(r.doc_id, r.text) for r in docs], [r.text for r in target])
    assert as_counter(found) == expected
    ranks = sorted(r for *_, r in expected if r)
    assert ranks == list(range(1, len(ranks) + 1)) and ranks


def test_odd_rows(spark):
    docs, none = odd_documents(spark), odd_documents(spark).limit(0)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    for aim in (docs, none):
        expected = plain_resample(rows, [x for _, x in rows] if aim is docs else [], 50)
        assert as_counter(I.resample(docs, aim, percent=50)) == expected
    assert I.resample(none, docs).collect() == []
