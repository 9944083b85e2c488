"""Prompts and masked completions of preference pairs."""

from pyspark.sql import functions as F

from tripstats.llm.preference import format_pairs, pair_rows, pairs_of

TURNS = "pair_id long, turn long, role string, text string"


def side(spark, *rows):
    return spark.createDataFrame([(p, t, r, x) for p, t, r, x in rows], TURNS)


def shown(df, pair):
    rows = [r for r in df.collect() if r.pair_id == pair]
    order = {"prompt": 0, "chosen": 1, "rejected": 2}
    return [(r.part, r.turn, r.trained) for r in sorted(rows, key=lambda r: (order[r.part], r.turn))]


def test_longest_common_prefix(spark):
    good = side(spark, (1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 2, "user", "more"), (1, 3, "assistant", "good"))
    bad = side(spark, (1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 2, "user", "more"), (1, 3, "assistant", "bad"), (1, 4, "user", "?"))
    df = format_pairs(good, bad)
    assert shown(df, 1) == [("prompt", 0, False), ("prompt", 1, False), ("prompt", 2, False), ("chosen", 3, True), ("rejected", 3, True), ("rejected", 4, False)]
    row = next(r for r in df.collect() if r.part == "chosen")
    assert row.rendered == "<|im_start|>assistant\ngood<|im_end|>\n"
    assert row.rendered[row.learn_from :] == "good<|im_end|>\n"
    masked = next(r for r in df.collect() if r.turn == 4)
    assert masked.learn_from == len(masked.rendered)


def test_equal_missing_and_shorter_sides(spark):
    good = side(spark, (1, 0, "user", "q"), (2, 0, "user", "q"), (3, 0, "user", "q"), (3, 1, "assistant", "a"))
    bad = side(spark, (1, 0, "user", "q"), (3, 0, "user", "q"), (4, 0, "user", "z"))
    df = format_pairs(good, bad)
    assert shown(df, 1) == [("prompt", 0, False)]
    assert shown(df, 2) == [("chosen", 0, False)]
    assert shown(df, 3) == [("prompt", 0, False), ("chosen", 1, True)]
    assert shown(df, 4) == [("rejected", 0, False)]


def test_nulls_repeats_ties_and_other_columns(spark):
    good = side(spark, (1, None, None, None), (1, 0, "user", "q"), (1, 0, "user", "q"), (1, 0, "user", "p"), (None, 0, "user", "x"), (1, 1, "assistant", None))
    bad = side(spark, (1, None, None, None), (1, 0, "user", "p"), (1, 0, "user", "q"), (1, 1, "assistant", "é" * 100_000))
    df = format_pairs(good.withColumn("part", F.lit(1)), bad.withColumn("trained", F.lit(2)))
    assert shown(df, 1) == [("prompt", -1, False), ("prompt", 0, False), ("prompt", 0, False), ("chosen", 1, True), ("rejected", 1, True)]
    assert df.filter("pair_id is null").count() == 0
    assert format_pairs(good.limit(0), bad.limit(0)).collect() == []


def test_pairs_of_a_group_are_one_fewer_than_its_members(spark):
    rows = []
    for c in range(200):
        rows += [(c, 0, "user", "same"), (c, 1, "assistant", "x" * (c % 50))]
    rows += [(900, 0, "user", "alone"), (900, 1, "assistant", "a"), (900, 2, "user", "b"), (900, 3, "assistant", "c"), (900, 4, "user", "d")]
    rows += [(901, 0, "user", "no answer"), (902, 0, "assistant", "only answer")]
    conversations = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    good, bad = pairs_of(conversations)
    df = format_pairs(good, bad)
    assert {r.pair_id for r in df.select("pair_id").distinct().collect()} == set(range(200)) - {49} | {900, 901, 902}
    assert shown(df, 900) == [("prompt", 0, False), ("prompt", 1, False), ("prompt", 2, False), ("chosen", 3, True), ("rejected", 3, True)]
    assert {r.text for r in df.collect() if r.pair_id == 900 and r.part == "rejected"} == {"a"}
    assert shown(df, 901) == [("prompt", 0, False)]
    assert shown(df, 902) == [("chosen", 0, True)]
    # equal to the preferred one
    assert [x[0] for x in shown(df, 99)] == ["prompt", "prompt"]


def test_ids_of_any_type(spark):
    rows = [("b", 0, "user", "q"), ("b", 1, "assistant", "yes"), ("a", 0, "user", "q"), ("a", 1, "assistant", "no!"), (None, 0, "user", "q")]
    conversations = spark.createDataFrame(rows, "conv_id string, turn long, role string, text string")
    rows = format_pairs(*pairs_of(conversations)).collect()
    assert {(r.pair_id, r.part, r.text) for r in rows} == {("b", "prompt", "q"), ("b", "chosen", "no!"), ("b", "rejected", "yes")}
    assert pairs_of(conversations.limit(0))[0].collect() == []


def test_one_row_per_pair(spark):
    """Prompt, both completions, and spans that cover just what is learned."""
    rows = [(c, t, ("user", "assistant")[t % 2], f"é{c % 3}-{t}" + "x" * (c * t % 5)) for c in range(40) for t in range(c % 7)]
    rows += [(50, 0, "user", "q"), (50, 1, "assistant", "one"), (50, 2, "user", None), (50, 3, "assistant", "two"), (50, 3, "assistant", "too")]
    conversations = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    formatted = format_pairs(*pairs_of(conversations))
    by_part = {}
    for r in sorted(formatted.collect(), key=lambda r: (r.turn, r.role, r.text)):
        text, learned = by_part.setdefault(r.pair_id, {}).setdefault(r.part, ["", ""])
        by_part[r.pair_id][r.part] = [text + r.rendered, learned + (r.rendered[r.learn_from :] if r.trained else "")]
    pairs = pair_rows(formatted).collect()
    assert {p.pair_id for p in pairs} == set(by_part) and len(pairs) == len(by_part) > 20
    for p in pairs:
        parts = by_part[p.pair_id]
        assert p.prompt == parts.get("prompt", [""])[0]
        for part in ("chosen", "rejected"):
            text, learned = parts.get(part, ["", ""])
            assert p[part] == text
            assert "".join(text[s.start : s.end] for s in p[f"{part}_mask"]) == learned
    few = pair_rows(formatted, most_turns=6).collect()
    assert 0 < len(few) < len(pairs)
    assert pair_rows(formatted.limit(0)).collect() == []


def scans(df):
    import re

    return len(re.findall(r"Scan parquet", df._jdf.queryExecution().executedPlan().toString()))


def test_few_scans(spark):
    good, bad = pairs_of(spark.read.parquet("/root/testdata/sf0.001/conversations.parquet"))
    df = format_pairs(good, bad)
    assert scans(df) <= 6 and scans(good) + scans(bad) <= 8


def test_native(spark):
    good, bad = pairs_of(spark.read.parquet("/root/testdata/sf0.001/conversations.parquet"))
    plan = format_pairs(good, bad)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Cartesian", "collect_list"))
