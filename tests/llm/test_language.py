"""Viterbi against all paths, spans, held-out accuracy, odd rows."""

import zlib
from itertools import product

import numpy as np
from corpus_frames import documents, odd_documents

from tripstats.llm import language as L

SF_DIR = "/root/testdata/sf0.01"


def test_best_path_as_all_paths():
    rng = np.random.default_rng(1)
    lengths = [0, 1, 5, 3, 0, 6, 2]
    first = np.r_[0, np.cumsum(lengths)]
    score = rng.normal(0, 3, (first[-1], 3))
    score[rng.random(score.shape) < 0.2] = -np.inf
    score[np.isinf(score).all(1)] = 0
    got = L.best_paths(score, first, 2.0)
    for a, b in zip(first, first[1:]):
        value = lambda p: sum(score[a + i, x] for i, x in enumerate(p)) - 2.0 * sum(x != y for x, y in zip(p, p[1:]))  # noqa: B023, E731
        best = max(map(value, product(range(3), repeat=b - a)), default=0)
        assert np.isclose(value(got[a:b]), best)


def test_words_and_scripts():
    found = L.letter_words(["Ab c1d", "", "é日Я", "..."])
    assert list(zip(found.doc.tolist(), found.start.tolist(), found.end.tolist())) == [(0, 0, 2), (0, 3, 4), (0, 5, 6), (2, 0, 3)]
    assert L.SCRIPT_NAMES[found.script[0]] == "latin"
    same = L.letter_words(["ABC", "abc"])
    assert same.grams[: len(same.grams) // 2].tolist() == same.grams[len(same.grams) // 2 :].tolist()


def test_mixed_text_gets_spans(spark):
    en, de = "the thing with this that other when there ", "die schicht durch nicht über jäger ist zwischen "
    texts = [en * 3, de * 3] * 20 + ["мир и слово и дело " * 4] * 10 + [en * 4 + de * 4]
    lang = {i: "de" if i % 2 else "en" for i in range(40)} | {i: "ru" for i in range(40, 50)} | {50: None}
    docs = documents(spark, texts, lang=lang)
    model = L.fit(docs.filter("doc_id < 50"))
    assert model.langs == ["de", "en", "ru"]
    row = L.label_spans(docs.filter("doc_id = 50").select("doc_id", "text"), model).first()
    assert [s.lang for s in row.spans] == ["en", "de"]
    assert abs(row.spans[1].start - 4 * len(en)) < 8
    cyrillic = L.label_spans(documents(spark, ["the слово"]).select("doc_id", "text"), model).first()
    assert [s.lang for s in cyrillic.spans] == ["en", "ru"]  # scripts narrow the candidates


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = L.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert len(held) > 100 and sum(r.lang_pred == r.lang for r in held) >= 0.98 * len(held)


def test_lang_and_source_are_no_inputs(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(200)
    model = L.fit(docs)
    rows = L.label_spans(docs.select("doc_id", "text"), model).select("doc_id", "lang_pred")
    assert rows.count() == 200


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = L.identify(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        if r.doc_id in (0, 1, 2):
            assert (r.lang_pred, r.score, r.spans) == ("und", 0.0, [])
    assert L.identify(docs.limit(0)).collect() == []
    nothing = L.identify(documents(spark, ["some text"], lang={0: None})).first()
    assert nothing.lang_pred == "und"
