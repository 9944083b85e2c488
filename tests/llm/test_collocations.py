"""Phrase collocations: filters by round trip, results against a plain count, odd rows."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from corpus_frames import documents, odd_documents

from tripstats.llm import collocations as C
from tripstats.llm import quotient as Q

SMALL = {c: c + 32 for c in range(65, 91)}


def plain(rows, least=10, top=2000, percent=50):
    """rows: (text, lang). The whole answer by plain counting."""
    counts, total = {}, Counter()
    for text, lang in rows:
        f = counts.setdefault(lang or "und", Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(SMALL)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang or "und"] += len(words)
            for n in (1, 2, 3):
                f.update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    out = set()
    for lang, f in counts.items():
        found = []
        for x, a in f.items():
            if len(x) < 2 or a < least:
                continue
            if len(x) == 2 and any(len(y) == 3 and b >= least and x in (y[:2], y[1:]) and 100 * b >= percent * a for y, b in f.items()):
                continue
            score, k = min((10**6 * a * a // (f[x[:k]] * f[x[k:]]), k) for k in range(1, len(x)))
            found.append((-score, -a, " ".join(x).encode(), f[x[:k]], f[x[k:]]))
        for rank, (s, a, x, l, r) in enumerate(sorted(found)[:top]):
            out.add((lang, rank + 1, x.decode(), -a, l, r, total[lang], -s))
    return out


def found(df):
    rows = df.collect()
    out = {tuple(r) for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("id_bits", [2, 3, 17, 21, 31, 42])
def test_permutation_can_be_undone(id_bits):
    rng = np.random.default_rng(id_bits)
    ids = [rng.integers(0, 1 << id_bits, 3000) for _ in range(3)]
    p = Q.Permutation(id_bits)
    left, right = p.of(*ids)
    assert int(left.max()) >> p.half == 0 == int(right.max()) >> p.half
    for a, b in zip(ids, p.undone(left, right)):
        assert np.array_equal(a, b)
    if id_bits > 8:  # the top bits are spread
        assert np.bincount((left >> np.uint64(p.half - 4)).astype(int), minlength=16).min() > 100


@pytest.mark.parametrize("id_bits", [2, 5, 20, 42])
@pytest.mark.parametrize("bucket_bits", [0, 1, 6])
def test_filters_lose_nothing_and_merge(id_bits, bucket_bits):
    rng = np.random.default_rng(7)
    p, shards, expected = Q.Permutation(id_bits), [], Counter()
    for _ in range(4):
        most = min(1 << id_bits, 12)
        grams = [tuple(x) for x in rng.integers(0, most, (900, 3)).tolist()] + [(1, 1, 0)] * 400
        expected.update(grams)
        shards.append(dict(Q.split(Q.counted(*p.of(*(np.array(x) for x in zip(*grams)))), p.half, bucket_bits)))
    got = Counter()
    for bucket in set().union(*shards):
        both = Q.merged([Q.joined(bucket, x[bucket], p.half, bucket_bits) for x in shards if bucket in x])
        for *gram, n in zip(*(x.tolist() for x in p.undone(both.left, both.right)), both.n.tolist()):
            got[tuple(gram)] += n
    assert got == expected and expected[(1, 1, 0)] >= 1600  # more than a byte counts


def corpus(seed, n=120):
    rng = random.Random(seed)
    words = ["The", "the", "a", "new", "York", "york", "big-apple", "Ünder", "日本", "x", "of", "in"]
    texts = []
    for _ in range(n):
        own = [rng.choice(words) + rng.choice(["", "", "", "", ",", ".", "\t", "\n", " "]) for _ in range(rng.randrange(60))]
        texts.append(" ".join(own) + (" new york city hall" if rng.random() < 0.6 else ""))
    return texts


@pytest.mark.parametrize("least, top, percent", [(10, 2000, 50), (3, 7, 90), (25, 30, 1)])
def test_same_as_plain(spark, least, top, percent):
    texts = corpus(least)
    lang = {i: ["en", "de", None][i % 3] for i in range(len(texts))}
    docs = documents(spark, texts, lang=lang)
    expected = plain([(r.text, r.lang) for r in docs.collect()], least, top, percent)
    got = found(C.collocations(docs, least, top, percent, shard_words=500))
    assert got == expected and expected


def test_piece_of_a_long_text(spark, monkeypatch):
    shard = C.Shard()
    monkeypatch.setattr(C, "PIECE_BYTES", 40)
    shard.add([b"Ab c. " * 50, b"", b"d\tE"])
    names = {v: k for k, v in shard.known.items()}
    text = b" ".join(names[x] for x in np.concatenate(shard.parts).tolist())
    assert text == b"ab c . " * 50 + b". . d e ."


def test_exact_beyond_64_bits(spark):
    big = 3_000_000_000_000
    known = spark.createDataFrame([("en", "a", big + 1, 1), ("en", "b", big + 7, 2)], "lang string, word string, n long, id long")
    grams = spark.createDataFrame([(1, 2, 0, big)], C.GRAMS)
    (row,) = C.scored(grams, known).collect()
    assert row.score == 10**6 * big * big // ((big + 1) * (big + 7)) and row.phrase == "a b"


def test_odd_rows(spark):
    docs = odd_documents(spark)
    expected = plain([(r.text, r.lang) for r in docs.collect()])
    assert found(C.collocations(docs)) == expected and expected
    assert C.collocations(docs.limit(0)).collect() == []
