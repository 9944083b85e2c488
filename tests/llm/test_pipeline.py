"""The pipeline's stages, one by one and together."""

import random
import zlib
from collections import Counter, defaultdict

import corpus_pipeline as P
from corpus_frames import WORD, documents, odd_documents, prose

SF_DIR = "/root/testdata/sf0.01"


def test_stages_in_order():
    assert [f.__name__ for _, f in P.STAGES] == ["identified", "without_copies", "without_near_copies", "mixed", "packed"]


def test_what_each_stage_keeps(spark):
    rng = random.Random(2)
    clean = [prose(rng, 80, 5000) for _ in range(40)]
    near = clean[0].rsplit(" ", 1)[0] + " else"
    docs = documents(spark, [*clean, clean[1], clean[2] + " \n", near, "1234 5678", None])
    kept = P.identified(spark, docs, "")
    assert kept.columns == P.COLUMNS
    assert {r.doc_id for r in kept.collect()} == set(range(43))
    kept = P.without_copies(spark, kept, "")
    assert {r.doc_id for r in kept.collect()} == set(range(43)) - {40, 2}  # the longer copy stays
    kept = P.without_near_copies(spark, kept, "")
    assert {r.doc_id for r in kept.collect()} == set(range(42)) - {40, 2}
    assert sorted(kept.filter("doc_id < 40").select(*P.COLUMNS).collect()) == sorted(docs.filter("doc_id < 40 and doc_id <> 2").collect())
    mixed = P.mixed(spark, kept, "")
    rows = mixed.collect()
    tokens = sum(len(r.text.split()) for r in kept.collect())
    assert sum(len(r.text.split()) for r in rows) == tokens * 4 // 5
    assert all(r.n_chars == len(r.text) for r in rows)
    texts = {r.doc_id: " ".join(r.text.split()) for r in kept.collect()}
    assert all(texts[r.doc_id].startswith(" ".join(r.text.split())) for r in rows)
    packed = P.packed(spark, mixed, "").collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in rows}


def test_run(spark):
    rows = P.run(spark, SF_DIR).collect()
    bins = defaultdict(int)
    for r in rows:
        bins[r.sequence_id] += r.length
    assert max(bins.values()) <= 1024
    per_doc = Counter(r.doc_id for r in rows if r.piece == 0)
    assert max(per_doc.values()) == 1 and 500 < len(per_doc) < 1000


def test_near_copies_lose_no_text(spark):
    """Rows that share a doc_id with a copy stay when their own text has none."""
    rng = random.Random(4)
    w, y, z = (prose(rng, 60, 9000) for _ in range(3))
    docs = documents(spark, [(2, w), (5, w), (5, z), (9, y), (None, w)])
    kept = P.without_near_copies(spark, docs, "")
    assert kept.columns == P.COLUMNS
    assert sorted(((r.doc_id or 0, r.text) for r in kept.collect())) == sorted([(0, w), (2, w), (5, z), (9, y)])


def test_odd_rows(spark):
    docs = odd_documents(spark)
    texts = lambda df: Counter((r.doc_id, r.text) for r in df.collect())
    every = texts(docs)
    kept = texts(P.identified(spark, docs, ""))
    assert all(any(c.isalpha() for c in x or "") for _, x in kept)
    assert {(3, "one"), (4, "one"), (5, "on e"), (None, "no id " * 30)} <= set(kept) and not kept - every
    kept = texts(P.without_copies(spark, docs, ""))
    assert sum(kept.values()) == len({"".join((x or "").split()) for _, x in every})
    assert (2, " \t\n ") in kept and (5, "on e") in kept
    kept = texts(P.without_near_copies(spark, docs, ""))
    assert kept[3, "one"] == 3 and not kept[4, "one"] and kept[0, None] == kept[1, ""] == 1
    assert kept[None, None] == kept[None, "no id " * 30] == 1
    rows = P.mixed(spark, docs, "").collect()
    words = lambda x: len(WORD.findall(x or ""))
    assert sum(words(r.text) for r in rows) == sum(words(x) * n for (_, x), n in every.items()) * 4 // 5
    given = defaultdict(set)
    for r in docs.collect():
        given[r.doc_id, r.text].add(r.n_chars)
    assert all(r.n_chars in (given.get((r.doc_id, r.text)) or {len(r.text)}) for r in rows)
    rows = P.packed(spark, docs, "").collect()
    assert sum(r.piece == 0 for r in rows) == sum(every.values())
    assert all(len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32 for r in rows)
    for _, stage in P.STAGES:
        assert stage(spark, docs.limit(0), "").collect() == []
