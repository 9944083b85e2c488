"""The corpus pipeline: language, exact and near duplicates, mix, and packed sequences.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept. All but
the last return the columns of documents; extra columns of their input are dropped. An empty
table gives an empty one at every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstats.llm import exact, jaccard, language, mixing, packing
from tripstats.llm.queries import domain, mix_weights
from tripstats.sources.workspace import new_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Least share of a document's letters that its language must have.
LEAST_SHARE = 0.5
#: The mix takes four fifths of the tokens that are left, and no document twice.
SHARE, MAX_EPOCHS = (4, 5), 1


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters of which one language has at least LEAST_SHARE.

    Texts that are null or have no letter go. A null lang is not learned from, a null doc_id
    neither; both kinds of rows are judged like others. Repeated rows are judged alike.
    """
    docs = docs.select(*COLUMNS)
    model = language.fit(docs.filter(~language.held_out()))
    labelled = language.label_spans(docs, model, keep_text=True)
    clear = (F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= LEAST_SHARE)
    return labelled.filter(clear).select(*COLUMNS)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each content: the longest text, then the smallest doc_id, which a null one
    follows. Null texts count as empty; of rows that agree in all this one stays."""
    return exact.deduplicated(docs.select(*COLUMNS))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the least doc_id of each class of near duplicates, whatever other rows
    share its doc_id. Rows with a null doc_id or without words are in no class and stay; rows
    that share doc_id and text stay or go together."""
    return jaccard.without_near_duplicates(docs.select(*COLUMNS)).select(*COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the target weights take, the last one of each leaf cut.

    Null langs and sources form a leaf of their own; texts without tokens come along where the
    texts around them are taken. Rows that share a doc_id are taken one by one; n_chars is that
    of a cut text.
    """
    chosen = mixing.mix(docs.select(*COLUMNS), domain(), mix_weights(spark), SHARE, MAX_EPOCHS)
    is_cut = F.col("n_take") < F.col("n_tokens")
    chosen = mixing.cut_text(chosen)
    length = F.when(is_cut, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return chosen.withColumn("n_chars", length).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens with their ids and their places in sequences: all that a
    trainer needs. A null text is the end id alone, repeated rows are packed once each."""
    return packing.pack(docs).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("language", identified),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("mix", mixed),
    ("pack", packed),
]

#: SQL can't express language models, MinHash pruning and tokenizers.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents; what each keeps is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = new_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
