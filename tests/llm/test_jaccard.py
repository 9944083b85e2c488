"""Near duplicates against all pairs."""

import random
from itertools import combinations

import numpy as np
import pytest
from corpus_frames import WORD, documents, odd_documents, prose

from tripstats.llm import jaccard
from tripstats.llm.groups import components
from tripstats.llm.jaccard import matches_needed, near_duplicates, without_near_duplicates


def brute(rows, size=5, threshold=0.8):
    sets = {}
    for d, t in rows:
        w = WORD.findall(t or "")
        grams = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}
        sets[d] = grams or ({tuple(w)} if w else set())
    links = {d: 0 for d in sets}
    label = {d: d for d in sets}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in combinations(sets, 2):
        either = len(sets[a] | sets[b])
        if either and len(sets[a] & sets[b]) * 10 >= 8 * either:
            links[a] += 1
            links[b] += 1
            x, y = sorted((root(a), root(b)))
            label[y] = x
    return {d: (root(d), links[d]) for d in sets}


def edited(rng, text, n):
    words = text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("block", [1024, 7])
def test_as_brute_force(spark, block):
    rng = random.Random(block)
    texts = [prose(rng, rng.randrange(3, 200), 5000) for _ in range(60)]
    for _ in range(140):
        base = rng.choice(texts)
        texts.append(edited(rng, base, rng.randrange(0, 1 + len(base.split()) // 25)) if len(base) > 20 else base)
    rng.shuffle(texts)
    rows = list(zip(rng.sample(range(10_000), len(texts)), texts))
    got = {r.doc_id: (r.class_id, r.n_links) for r in near_duplicates(documents(spark, rows), block=block).collect()}
    assert got == brute(rows)


def test_a_large_group_in_tiles(spark):
    rng = random.Random(5)
    base = prose(rng, 120, 9000)
    texts = [edited(rng, base, rng.randrange(0, 4)) for _ in range(150)] + [base] * 40
    rows = list(enumerate(texts))
    got = {r.doc_id: (r.class_id, r.n_links) for r in near_duplicates(documents(spark, rows), block=16).collect()}
    assert got == brute(rows)


def test_rows_that_share_an_id(spark):
    """They are documents of their own; one row of each class stays, and no text is lost."""
    rng = random.Random(8)
    w, y, z = (prose(rng, 60, 9000) for _ in range(3))
    docs = documents(spark, [(2, w), (5, w), (5, z), (9, y), (7, edited(rng, z, 1)), (3, y + " more"), (3, y + " much"), (4, None), (4, "")])
    rows = near_duplicates(docs).collect()
    assert sorted((r.doc_id, r.class_id) for r in rows) == [(2, 2), (3, 3), (3, 3), (4, 4), (4, 4), (5, 2), (5, 5), (7, 5), (9, 3)]
    kept = without_near_duplicates(docs).collect()
    assert sorted((r.doc_id, r.text or "") for r in kept if r.doc_id != 3) == sorted([(2, w), (5, z), (4, ""), (4, "")])
    assert [r.doc_id for r in kept].count(3) == 1 and kept[0].asDict().keys() == set(docs.columns)
    stay = [r for r in rows if r.stays]
    assert len(stay) == len(kept) == 5 and all(r.doc_id == r.class_id for r in stay)


def test_one_row_of_each_class_stays(spark):
    rng = random.Random(9)
    base = [prose(rng, 80, 9000) for _ in range(12)]
    rows = [(rng.randrange(40), edited(rng, rng.choice(base), rng.randrange(3))) for _ in range(150)]
    found = near_duplicates(documents(spark, rows)).collect()
    by_row = dict(enumerate(rows))
    root = brute([(i, t) for i, (_, t) in by_row.items()])
    classes = {}
    for i, (d, _) in by_row.items():
        classes.setdefault(root[i][0], []).append(d)
    want = sorted((d, min(ds)) for ds in classes.values() for d in ds)
    assert sorted((r.doc_id, r.class_id) for r in found) == want
    assert sorted(r.doc_id for r in found if r.stays) == sorted(map(min, classes.values()))


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        if r.doc_id in (0, 1, 2):
            assert (r.class_id, r.n_links, r.n_shingles) == (r.doc_id, 0, 0)
        if r.doc_id is None:
            assert r.class_id is None and r.n_links == 0
    assert {r.class_id for r in rows if r.doc_id in (3, 4)} == {3}
    assert all(r.stays for r in rows if r.doc_id in (0, 1, 2, None)) and {r.stays for r in rows} == {True, False}
    assert near_duplicates(docs.limit(0)).collect() == [] == without_near_duplicates(docs.limit(0)).collect()


def test_pruning_keeps_links():
    needed = matches_needed(0.8, 1e-6)
    assert needed == sorted(needed) and needed[-1] < 0.8 * jaccard.VALUES
    # with four of five values equal, a pair is dropped less often than once in 10,000
    rng = np.random.default_rng(1)
    equal = (rng.random((20_000, jaccard.VALUES)) < 0.8).cumsum(1)[:, jaccard.STEP - 1 :: jaccard.STEP]
    assert (equal < np.array(needed)).any(1).mean() < 1e-4
    # and hardly any pair without likeness gets beyond the first step
    assert (rng.binomial(jaccard.STEP, 0.1, 20_000) >= needed[0]).mean() < 0.05


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(40)]
    label = {x: x for e in edges for x in e}
    for _ in range(400):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {x: y for x, y in label.items() if x in got}
    assert {x for a, b in edges if a != b for x in (a, b)} == set(got)
