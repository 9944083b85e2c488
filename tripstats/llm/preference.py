"""Preference pairs of conversations as prompt and masked completions, with DataFrame
functions only.

All work is on rows of single turns: nothing gathers a conversation, so one of any length
costs no more than its turns. Turns, pairs and the turns where pairs part are written tables, so
each is read where it is needed, and joins with a hot opening or conversation have exchanges
of their own, which adaptive execution can split. ``pair_rows`` puts a pair into one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripstats.llm.groups import written

# The marks of a rendered turn.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
ASSISTANT = "assistant"
NO_TURN = -1
#: Rows of a pair that are put into one row; a longer pair keeps its rows.
MOST_TURNS = 10_000


def turns_of(conversations: DataFrame, key: str) -> DataFrame:
    """Distinct turns (key, turn, role, text) with nulls named: turn -1, an empty role and an
    empty text. Rows with a null key belong to no conversation."""
    return (
        conversations.filter(F.col(key).isNotNull())
        .select(
            key,
            F.coalesce(F.col("turn").cast("long"), F.lit(NO_TURN)).alias("turn"),
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        )
        .distinct()
    )


def _signed(turns: DataFrame, side: str) -> DataFrame:
    """One row per turn number: how many rows it has, the least and greatest of them, and the
    sum of their hashes. With one row a turn, as usual, that is its whole content."""
    row = F.struct("role", "text")
    return turns.groupBy("pair_id", "turn").agg(
        F.struct(
            F.count(F.lit(1)),
            F.min(row),
            F.max(row),
            F.sum(F.xxhash64("role", "text").cast("decimal(20,0)")),
        ).alias(side)
    )


def _rendered() -> dict[str, Column]:
    """A turn as text, and the code point from which a model learns it."""
    head = F.concat(F.lit(OPEN), F.col("role"), F.lit("\n"))
    whole = F.concat(head, F.col("text"), F.lit(CLOSE))
    start = F.when(F.col("trained"), F.length(head)).otherwise(F.length(whole))
    return {"rendered": whole, "learn_from": start.cast("long")}


def format_pairs(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """Prompt, chosen and rejected completion of every pair, a row per turn.

    Both inputs have pair_id, turn, role and text. The prompt is the longest common prefix:
    the turns before the first turn number at which the two differ in any row. It is rendered once.
    The remaining turns are the completions; of these the assistant's are trained from
    behind their heading on, everything else is masked. Two equal conversations give a
    prompt and no completions; a side that is missing or ends first gives none for itself.

    Returns pair_id, part (prompt, chosen or rejected), turn, role, text, rendered, learn_from (code points
    of rendered before it are masked) and trained. Nulls: see turns_of; repeated rows count
    once; several rows of one turn number are all rendered and compared together. Other
    columns are not read.
    """
    good = written(turns_of(chosen, "pair_id"), "chosen")
    bad = written(turns_of(rejected, "pair_id"), "rejected")
    return _formatted(good, bad)


def _formatted(good: DataFrame, bad: DataFrame) -> DataFrame:
    """format_pairs of written tables of distinct turns."""
    both = _signed(good, "good").join(_signed(bad, "bad"), ["pair_id", "turn"], "full")
    first = both.filter(~F.col("good").eqNullSafe(F.col("bad"))).groupBy("pair_id")
    first = written(first.agg(F.min("turn").alias("splits_at")), "splits")

    def of(side: DataFrame, part: str) -> DataFrame:
        cut = side.join(first, "pair_id", "left")
        common = F.col("splits_at").isNull() | (F.col("turn") < F.col("splits_at"))
        return cut.withColumn("part", F.when(common, F.lit("prompt")).otherwise(F.lit(part)))

    rows = of(good, "chosen").union(of(bad, "rejected").filter("part = 'rejected'"))
    trained = (F.col("part") != "prompt") & (F.col("role") == ASSISTANT)
    rows = rows.withColumn("trained", trained).withColumns(_rendered())
    return rows.select(
        "pair_id", "part", "turn", "role", "text", "rendered", "learn_from", "trained"
    )


def pairs_of(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chosen and rejected turns from plain conversations: one pair a conversation.

    Of conversations with the same opening turn, the one with most assistant text
    (then the least id) is preferred to each of the others; a pair is named after
    the other. So a group costs a row per member, not per two members. A conversation with
    an opening of its own is preferred to itself with the last answer replaced by the one
    before, or left out if there is none; both end with that answer. conv_id may be of any type
    that can be sorted; rows where it is null are in no pair. An empty table gives no turns.
    Other columns are not read.
    """
    turns = written(turns_of(conversations, "conv_id"), "turns")
    answer = F.col("role") == ASSISTANT
    known = turns.groupBy("conv_id").agg(
        F.min(F.struct("turn", "role", "text")).alias("first"),
        F.coalesce(F.sum(F.when(answer, F.length("text"))), F.lit(0)).alias("said"),
        F.max(F.when(answer, F.col("turn"))).alias("last"),
    )
    opening = ["open_role", "open_text"]
    known = known.select(
        "conv_id", F.col("first.role").alias("open_role"), F.col("first.text").alias("open_text"), "said", "last"
    )
    known = written(known, "conversations")
    best = known.groupBy(*opening).agg(
        F.min(F.struct((-F.col("said")).alias("less"), "conv_id")).alias("best"), F.count(F.lit(1)).alias("n")
    )
    best = written(best.select(*opening, F.col("best.conv_id").alias("best_id"), "n"), "openings")
    known = written(known.join(best, opening).select("conv_id", "last", "n", "best_id"), "pairs")
    paired = known.filter("n > 1 and conv_id <> best_id").select(F.col("conv_id").alias("pair_id"), "best_id")
    alone = known.filter("n = 1").select("conv_id", "last")

    own = turns.join(alone, "conv_id").withColumnRenamed("conv_id", "pair_id")
    own = written(own.filter("last is null or turn <= last"), "alone")
    earlier = (
        own.filter(answer & (F.col("turn") < F.col("last")))
        .groupBy("pair_id")
        .agg(F.max(F.struct("turn", "text")).alias("x"), F.first("last").alias("last"))
        .select("pair_id", F.col("last").alias("turn"), F.lit(ASSISTANT).alias("role"), F.col("x.text").alias("text"))
    )
    columns = ["pair_id", "turn", "role", "text"]
    chosen = turns.join(paired, turns["conv_id"] == paired["best_id"]).select(*columns)
    rejected = turns.withColumnRenamed("conv_id", "pair_id").join(paired, "pair_id")
    cut = own.filter(F.col("last").isNull() | (F.col("turn") < F.col("last")))
    return (
        chosen.union(own.select(*columns)),
        rejected.select(*columns).union(cut.select(*columns)).union(earlier.select(*columns)),
    )


def pair_rows(formatted: DataFrame, most_turns: int = MOST_TURNS) -> DataFrame:
    """One row per pair: what a trainer reads.

    Takes the rows of format_pairs. Returns pair_id, prompt, chosen and rejected (texts, the
    prompt once), and chosen_mask and rejected_mask: the spans (start, end, in code points of the
    completion) that are learned; all else is masked, the prompt wholly. A pair without a
    prompt or a completion has an empty text there. A pair of more than ``most_turns`` rows is
    left out here and keeps its rows in ``formatted``, so no row grows without bound.
    """
    size = formatted.groupBy("pair_id").agg(F.count(F.lit(1)).alias("n"))
    small = written(size.filter(F.col("n") <= most_turns).select("pair_id"), "pair-sizes")
    order = ["turn", "role", "text"]
    length = F.length("rendered").cast("long")
    earlier = Window.partitionBy("pair_id", "part").orderBy(*order)
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(length).over(earlier), F.lit(0))
    rows = formatted.join(small, "pair_id").withColumn("before", start)
    learned = F.struct(
        (F.col("before") + F.col("learn_from")).alias("start"), (F.col("before") + length).alias("end")
    )
    turn = F.struct(*order, "rendered", F.when(F.col("trained"), learned).alias("learned"))
    parts = ("prompt", "chosen", "rejected")
    of_part = [
        F.array_sort(F.collect_list(F.when(F.col("part") == part, turn))).alias(part) for part in parts
    ]
    rows = rows.groupBy("pair_id").agg(*of_part)
    texts = [F.expr(f"concat_ws('', {x}.rendered)").alias(x) for x in parts]
    masks = [F.array_compact(f"{x}.learned").alias(f"{x}_mask") for x in parts[1:]]
    return rows.select("pair_id", *texts, *masks)
