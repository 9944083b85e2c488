"""Exact duplicates by skew-safe combining, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripstats.llm.groups import written

WHITE_SPACE = r"[\x20\x09-\x0D]"
SALTS = 8
# A rank is n_chars * SCALE - doc_id: the largest is the longest text, then the smallest id.
SCALE = "100000000000000000000"
HALF = "50000000000000000000"
NO_ID = "9223372036854775808"


def _prepared(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.char_length(text).alias("n_chars"),
        F.regexp_replace(text, WHITE_SPACE, "").alias("content"),
    ).withColumn("digest", F.unhex(F.sha2("content", 256)))


def _rank():
    length = F.col("n_chars").cast("decimal(12,0)") * F.lit(SCALE).cast("decimal(21,0)")
    own = F.coalesce(F.col("doc_id").cast("decimal(20,0)"), _no_id())
    return (length - own).cast("decimal(38,0)")


def winners(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """One row per distinct content: digest, best (rank of the row that stays), copies.

    Three stages, each of which groups by the digest and the whole content:
    inside every task before the shuffle, over the tasks within one salt of a digest, and
    over the at most ``salts`` rows of a digest that are then left. A content that a third
    of all rows share so costs one row per task and salt. Two contents with one
    digest stop the job instead of being merged.
    """
    salted = (
        _prepared(docs)
        .withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)))
        .groupBy("digest", "salt", "content")
        .agg(F.max(_rank()).alias("best"), F.count(F.lit(1)).alias("copies"))
    )
    merged = (
        salted.repartition("digest")
        .groupBy("digest", "content")
        .agg(F.max("best").alias("best"), F.sum("copies").alias("copies"))
        .groupBy("digest")
        .agg(
            F.max("best").alias("best"),
            F.sum("copies").alias("copies"),
            F.count(F.lit(1)).alias("contents"),
        )
    )
    clash = F.raise_error(F.lit("two contents have one SHA-256 digest"))
    return merged.select(
        "digest",
        F.when(F.col("contents") > 1, clash.cast("decimal(38,0)")).otherwise(F.col("best")).alias("best"),
        "copies",
    )


def exact_duplicates(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """Every document with the document that stays for its content.

    Texts are equal when the same after deleting ``[\\x20\\x09-\\x0D]``; a null text is
    empty. Of equal texts the one with most code points stays, then the smallest doc_id; a
    null doc_id ranks last. Of rows that also share their doc_id and length, one is kept; which
    one can't be told. An empty table gives no rows. Returns doc_id, keep_id, group_size, kept
    and text_sha256, a row for each input row; other columns of docs are not read.
    """
    keep_id, stays = _decided()
    columns = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    rows = (
        _prepared(docs)
        .select("doc_id", "digest", "n_chars")
        .join(_settled(docs, salts), "digest")
        .select(
            "doc_id",
            keep_id.alias("keep_id"),
            F.col("copies").alias("group_size"),
            stays.alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
            "shared",
        )
    )
    # Rows that can't be told apart are counted where they lie and given back, one as kept.
    same = rows.filter("kept and shared").groupBy(*columns, F.spark_partition_id().alias("part"))
    same = same.agg(F.count(F.lit(1)).alias("n"))
    by_content = Window.partitionBy("text_sha256")
    same = same.withColumn("first", F.min("part").over(by_content))
    one = (F.col("part") == F.col("first")) & (F.col("i") == 1)
    same = same.withColumn("i", F.explode(F.sequence(F.lit(1), F.col("n")))).withColumn("kept", one)
    return rows.filter("not (kept and shared)").select(*columns).union(same.select(*columns))


def _settled(docs: DataFrame, salts: int) -> DataFrame:
    """The winners as a written table: how long the text that stays is, the rank of its id,
    and whether several rows share that id. A join with a table has an exchange of its own on
    either side, so adaptive execution can split the rows of a hot digest."""
    ids = docs.select(F.col("doc_id").cast("long").alias("id")).groupBy("id")
    several = ids.agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    several = several.select(F.coalesce(F.col("id").cast("decimal(20,0)"), _no_id()).alias("keep_rank"))
    best = _readable(written(winners(docs, salts), "winners"))
    best = best.join(several.withColumn("shared", F.lit(True)), "keep_rank", "left")
    return written(best.withColumn("shared", F.coalesce("shared", F.lit(False))), "settled")


def _no_id() -> Column:
    return F.lit(NO_ID).cast("decimal(20,0)")


def _readable(best: DataFrame) -> DataFrame:
    """The ranks of winners taken apart into length and id."""
    rounded = f"(best + cast('{HALF}' as decimal(20,0))) div cast('{SCALE}' as decimal(21,0))"
    chars = F.expr(rounded)
    scale = F.lit(SCALE).cast("decimal(21,0)")
    keep_rank = (chars.cast("decimal(12,0)") * scale - F.col("best")).cast("decimal(20,0)")
    return best.select("digest", "copies", chars.alias("keep_chars"), keep_rank.alias("keep_rank"))


def _decided() -> tuple[Column, Column]:
    """(keep_id, whether the row stays)."""
    own = F.col("keep_rank") != _no_id()
    keep_id = F.when(own, F.col("keep_rank").cast("long"))
    stays = F.col("doc_id").eqNullSafe(keep_id) & (F.col("n_chars") == F.col("keep_chars"))
    return keep_id, stays


def deduplicated(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """The rows of docs that exact_duplicates keeps, with all their columns. Of rows that share
    doc_id, length and content the one with the least hash of all columns stays."""
    row = F.struct(*(F.col(f"`{x}`") for x in docs.columns)).alias("row")
    text = F.coalesce(F.col("text"), F.lit(""))
    content = F.regexp_replace(text, WHITE_SPACE, "")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.char_length(text).alias("n_chars"),
        F.unhex(F.sha2(content, 256)).alias("digest"),
        row,
    )
    _, stays = _decided()
    kept = rows.join(_settled(docs, salts), "digest").filter(stays)
    same = kept.filter("shared").groupBy("digest").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return kept.filter("not shared").select("row.*").union(same.select("row.*"))
