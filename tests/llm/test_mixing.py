"""Budgets against water-filling by hand, and what is taken."""

import random
from collections import defaultdict
from fractions import Fraction

import pytest
from corpus_frames import documents, odd_documents, prose
from pyspark.sql import functions as F

from tripstats.llm import mixing as M

WEIGHTS = "domain string, lang string, source string, weight long"


def fill(budget, nodes):
    """{name: tokens} for {name: (weight, capacity)}: pour until all are full or it is gone."""
    got = {x: Fraction(0) for x in nodes}
    left = Fraction(budget)
    while left > 0:
        open_ = [x for x, (w, c) in nodes.items() if w and got[x] < c]
        if not open_:
            break
        total = sum(nodes[x][0] for x in open_)
        step = min(min((nodes[x][1] - got[x]) / Fraction(nodes[x][0]) for x in open_), left / total)
        for x in open_:
            got[x] += step * nodes[x][0]
        left -= step * total
    return got


@pytest.mark.parametrize("seed", range(4))
def test_budgets(spark, seed):
    rng = random.Random(seed)
    leaves = [(d, x, s, rng.randrange(1, 1000)) for d in "abc" for x in "pq" for s in "uvw" if rng.random() < 0.8]
    weights = [(d, None, None, rng.randrange(0, 5)) for d in "abc"]
    weights += [(d, x, None, rng.randrange(1, 5)) for d in "abc" for x in "pq"]
    weights += [(d, x, s, rng.randrange(1, 9)) for d in "ab" for x in "pq" for s in "uv"]
    table = spark.createDataFrame(leaves, "domain string, lang string, source string, available long")
    got = {tuple(r)[:3]: r.granted for r in M.budgets(table, spark.createDataFrame(weights, WEIGHTS), (3, 2), 2).select("domain", "lang", "source", "granted").collect()}
    weight = {tuple(x for x in w[:3] if x): w[3] for w in weights}
    budget = {(): Fraction(sum(x[3] for x in leaves) * 3 // 2)}
    for depth in (1, 2, 3):
        family = defaultdict(dict)
        for leaf in leaves:
            key = leaf[:depth]
            capacity = sum(2 * x[3] for x in leaves if x[:depth] == key)
            family[key[:-1]][key] = (weight.get(key, 1), capacity)
        budget = {k: v for p, nodes in family.items() if p in budget for k, v in fill(budget[p], nodes).items() if nodes[k][0]}
    assert set(got) == set(budget)
    for key, tokens in got.items():
        assert abs(tokens - budget[key]) <= 3  # whole tokens at three levels


def mixed(spark, docs, share, epochs, weights=()):
    return M.mix(docs, F.lit("d"), spark.createDataFrame(list(weights), WEIGHTS), share, epochs).collect()


def test_prefix_of_a_seeded_epoch(spark):
    rng = random.Random(1)
    docs = documents(spark, [prose(rng, rng.randrange(0, 50)) for _ in range(400)], source={i: "s" for i in range(400)})
    total = sum(len(r.text.split()) for r in docs.collect())
    rows = mixed(spark, docs, (7, 4), 2)
    assert sum(r.n_take for r in rows) == total * 7 // 4
    first, second = ([r for r in rows if r.epoch == e] for e in (0, 1))
    assert len(first) == 400 and all(r.n_take == r.n_tokens for r in first)
    assert len({r.doc_id for r in second}) == len(second) < 400
    assert sum(r.n_take < r.n_tokens for r in second) <= 1
    fewer = mixed(spark, docs, (6, 4), 2)
    assert {r.doc_id for r in fewer if r.epoch} <= {r.doc_id for r in second}  # a prefix of the same order


def test_shortage_goes_to_siblings_then_to_relations(spark):
    word = "w "
    texts = {0: ("en", "a", 10), 1: ("en", "b", 500), 2: ("de", "c", 20), 3: ("fr", "e", 900)}
    docs = documents(spark, [word * n for _, _, n in texts.values()], lang={i: x[0] for i, x in texts.items()}, source={i: x[1] for i, x in texts.items()})
    rows = {r.doc_id: r.n_take for r in mixed(spark, docs, (600, 1430), 1)}
    # each language has 200: a is 90 short, which b makes up; de is 180 short, which en and fr share
    assert rows == {0: 10, 1: 280, 2: 20, 3: 290}


def test_cut_text(spark):
    docs = documents(spark, ["a  b\tc d", "e f"], source={0: "s", 1: "t"})
    out = M.mix(docs, F.lit("d"), spark.createDataFrame([], WEIGHTS), (2, 3), 1)
    assert {r.doc_id: r.text for r in M.cut_text(out).collect()} == {0: "a b", 1: "e f"}


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = mixed(spark, docs, (1, 1), 1)
    assert len(rows) == docs.filter(F.col("text").rlike("[^\\s]")).count() + len([r for r in rows if not r.n_tokens])
    assert {"part", "bucket", "key"} <= set(M.mix(docs, F.lit("d"), spark.createDataFrame([], WEIGHTS), (1, 2), 2).columns)
    assert mixed(spark, docs.limit(0), (1, 1), 1) == []
