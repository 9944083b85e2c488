"""Salted exact dedup: cases, odd rows, and no Python in the plan."""

from corpus_frames import documents, odd_documents

from tripstats.llm.exact import deduplicated, exact_duplicates, winners


def test_longest_then_least_id_stays(spark):
    docs = documents(spark, [(5, "a b"), (2, "ab"), (9, "a  b"), (7, " a b "), (8, "a\tb\n "), (1, "c")])
    rows = {r.doc_id: r for r in exact_duplicates(docs).collect()}
    assert {d: r.keep_id for d, r in rows.items()} == {5: 7, 2: 7, 9: 7, 7: 7, 8: 7, 1: 1}
    assert [d for d, r in rows.items() if r.kept] in ([7, 1], [1, 7])
    assert rows[5].group_size == 5


def test_code_points_count_and_negative_ids(spark):
    docs = documents(spark, [(-3, "é 日"), (4, "é日"), (-(2**63), "z"), (2**63 - 1, "z ")])
    rows = {r.doc_id: r.keep_id for r in exact_duplicates(docs).collect()}
    assert rows == {-3: -3, 4: -3, -(2**63): 2**63 - 1, 2**63 - 1: 2**63 - 1}


def test_other_white_space_is_content(spark):
    rows = exact_duplicates(documents(spark, ["a b", "ab"])).collect()
    assert all(r.group_size == 1 for r in rows)


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = exact_duplicates(docs).collect()
    assert len(rows) == docs.count()
    empty = [r for r in rows if r.doc_id in (0, 1, 2)]
    assert {r.group_size for r in empty} == {4} and {r.keep_id for r in empty} == {2}
    one = [r for r in rows if r.doc_id == 3]
    assert len(one) == 3 and all((r.keep_id, r.kept, r.group_size) == (5, False, 5) for r in one)
    assert sum(r.kept for r in rows) == len({r.text_sha256 for r in rows})
    no_id = [r for r in rows if r.doc_id is None]
    assert sorted(r.kept for r in no_id) == [False, True]
    assert exact_duplicates(docs.limit(0)).collect() == []


def test_one_of_the_rows_that_share_an_id_stays(spark):
    docs = documents(spark, [(1, "a")] * 5 + [(2, "a"), (1, "b"), (1, "b "), (7, "c"), (7, "d")] + [(None, "e")] * 3).repartition(4)
    rows = exact_duplicates(docs).collect()
    assert len(rows) == docs.count()
    kept = sorted(((r.doc_id or 0, r.text_sha256) for r in rows if r.kept))
    assert len(kept) == len({r.text_sha256 for r in rows}) == 5 and [d for d, _ in kept] == [0, 1, 1, 7, 7]
    assert {r.group_size for r in rows if r.doc_id == 2} == {6}
    assert sorted((r.doc_id or 0, r.text) for r in deduplicated(docs).collect()) == [(0, "e"), (1, "a"), (1, "b "), (7, "c"), (7, "d")]


def test_whole_rows_stay(spark):
    docs = documents(spark, ["x y", "xy", "z"])
    assert sorted(tuple(r) for r in deduplicated(docs).collect()) == sorted(
        tuple(r) for r in docs.filter("doc_id <> 1").collect()
    )


def test_native_and_pre_aggregated(spark):
    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    docs = documents(spark, ["a"])
    for df in (exact_duplicates(docs), winners(docs), deduplicated(docs)):
        assert not any(x in plan(df) for x in ("Python", "Pandas", "Arrow"))
    assert plan(winners(docs)).count("HashAggregate") >= 4
