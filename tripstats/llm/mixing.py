"""Mixing sources to target weights by hierarchical budgeting, with DataFrame functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripstats.llm.groups import written

LEVELS = ("domain", "lang", "source")
WORD = r"[^\x20\x09-\x0D]+"
UNKNOWN = "unknown"
SEED = 42
#: Letters of an order key by which prefixes are narrowed: two rounds of two.
STEPS = (2, 4)


def _exact(value: Column | str) -> Column:
    return F.col(value).cast("decimal(18,0)") if isinstance(value, str) else value.cast("decimal(18,0)")


def _share_out(nodes: DataFrame, parents: list[str], name: str) -> DataFrame:
    """Split ``budget`` (of the parent, on every row) by ``weight`` over the nodes of each parent.

    No node gets more than its ``capacity``; what it can't take goes to its siblings by
    weight. In order of capacity over weight, a node is full exactly if the budget reaches
    its level for itself and all later ones. Whole tokens are dealt by cumulated
    weight, so they add up. Adds ``granted``.
    """
    by_level = Window.partitionBy(*parents).orderBy(
        F.col("capacity").cast("double") / F.col("weight"), name
    )
    earlier = by_level.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_level.rowsBetween(0, Window.unboundedFollowing)
    family = Window.partitionBy(*parents)
    by_name = family.orderBy(name).rowsBetween(Window.unboundedPreceding, 0)
    weight, capacity, budget = _exact("weight"), _exact("capacity"), _exact("budget")
    before = F.coalesce(F.sum("capacity").over(earlier), F.lit(0)).cast("decimal(18,0)")
    later = F.sum("weight").over(onward).cast("decimal(18,0)")
    open_weight = F.when(~F.col("full"), F.col("weight")).otherwise(0)
    return (
        nodes.filter("weight > 0")
        .withColumn("full", capacity * later + weight * before <= weight * budget)
        .withColumn("left", F.col("budget") - F.sum(F.when(F.col("full"), F.col("capacity")).otherwise(0)).over(family))
        .withColumn("open", F.sum(open_weight).over(family))
        .withColumn("upto", F.sum(open_weight).over(by_name))
        .withColumn("granted", F.when(F.col("full"), F.col("capacity")).otherwise(_dealt("upto") - _dealt("upto - weight")))
        .drop("full", "left", "open", "upto")
    )


def _dealt(upto: str) -> Column:
    return F.expr(f"cast(({upto}) as decimal(18,0)) * cast(left as decimal(18,0)) div open")


def budgets(leaves: DataFrame, weights: DataFrame, share: tuple[int, int], max_epochs: int) -> DataFrame:
    """The tokens granted to every leaf (domain, lang, source) with ``available`` tokens.

    The root's budget is ``share`` (a fraction) of all available tokens. A node can take
    ``max_epochs`` times the tokens below it; so a shortage is made up by siblings as long as
    they have tokens, and only then by relations of the parent. ``weights`` has rows
    (domain, lang, source, weight), null below the level a row is for; a node without a row
    weighs 1, one with 0 gets nothing.
    """
    granted = None
    for depth in range(len(LEVELS)):
        parents, keys = list(LEVELS[:depth]), list(LEVELS[: depth + 1])
        level = leaves.groupBy(*keys).agg(F.sum("available").alias("available"))
        level = level.withColumn("capacity", F.col("available") * max_epochs)
        rule = F.col(keys[-1]).isNotNull()
        for below in LEVELS[depth + 1 :]:
            rule &= F.col(below).isNull()
        own = weights.filter(rule).groupBy(*keys).agg(F.max("weight").cast("long").alias("weight"))
        level = level.join(own, keys, "left").fillna(1, ["weight"])
        if granted is None:
            every = F.sum("available").over(Window.partitionBy())
            level = level.withColumn("budget", F.floor(_exact(every) * share[0] / share[1]).cast("long"))
        else:
            level = level.join(granted, parents)
        shared = _share_out(level, parents, keys[-1])
        granted = shared.select(*keys, F.col("granted").cast("long").alias("budget"))
    return leaves.join(granted.withColumnRenamed("budget", "granted"), list(LEVELS))


def _order_key(seed: int, epoch: Column) -> Column:
    """The place of a document in a seeded shuffle of its leaf."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), name))


def _prefixes(rows: DataFrame, granted: DataFrame, seed: int) -> DataFrame:
    """Per leaf: whole epochs, and the key, size and taken tokens of the last document.

    The prefix of the last epoch is found by sums over key prefixes of growing length, at
    most 256 a leaf and round, then over the documents of one such bucket; so no
    leaf is sorted or gathered, however large.
    """
    leaf = list(LEVELS)
    state = granted.select(
        *leaf,
        F.expr("granted div available").alias("epochs"),
        F.expr("granted % available").alias("rest"),
        F.lit("").alias("bucket"),
        F.lit(0).cast("long").alias("before"),
    ).filter("available > 0")
    ordered = Window.partitionBy(*leaf).orderBy("key")
    for length in (*STEPS, None):
        inside = rows.join(state.filter("rest > 0"), leaf).withColumn("full_key", _order_key(seed, F.col("epochs")))
        inside = inside.filter(F.col("full_key").startswith(F.col("bucket")))
        key = F.col("full_key") if length is None else F.substring("full_key", 1, length)
        sums = inside.groupBy(*leaf, key.alias("key")).agg(
            F.sum("n_tokens").alias("size"), F.first("rest").alias("rest"), F.first("before").alias("before")
        )
        upto = sums.withColumn("upto", F.col("before") + F.sum("size").over(ordered))
        last = upto.filter((F.col("upto") >= F.col("rest")) & (F.col("upto") - F.col("size") < F.col("rest")))
        found = last.select(
            *leaf, F.col("key").alias("at"), "size", (F.col("upto") - F.col("size")).alias("passed")
        )
        state = (
            state.join(found, leaf, "left")
            .withColumn("bucket", F.coalesce("at", "bucket"))
            .withColumn("before", F.coalesce("passed", "before"))
            .withColumnRenamed("size", "last_size")
            .drop("at", "passed")
        )
        if length is not None:
            state = written(state.drop("last_size"), "prefixes")
    return state.select(
        *leaf, "epochs", "rest", F.col("bucket").alias("last_key"), "last_size", (F.col("rest") - F.col("before")).alias("last_take")
    )


def with_leaf(docs: DataFrame, domain: Column) -> DataFrame:
    """docs with domain, lang and source as leaf columns (null: ``unknown``) and n_tokens,
    the words of its text (null: none)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    named = {
        "_domain": F.coalesce(domain, F.lit(UNKNOWN)),
        "_lang": F.coalesce(F.col("lang"), F.lit(UNKNOWN)),
        "_source": F.coalesce(F.col("source"), F.lit(UNKNOWN)),
        "_n_tokens": F.regexp_count(text, F.lit(WORD)).cast("long"),
    }
    return docs.withColumns(named)


def mix(
    docs: DataFrame,
    domain: Column,
    weights: DataFrame,
    share: tuple[int, int],
    max_epochs: int,
    seed: int = SEED,
) -> DataFrame:
    """The rows of docs to train on, each as often as its leaf's budget has epochs.

    A leaf is a domain (an expression over docs), lang and source. ``budgets`` grants it tokens; it then
    runs through seeded shuffles of its documents, one an epoch, until they are used up:
    whole epochs take every document, the last takes a prefix whose final document is cut.
    Adds domain, epoch, n_tokens, n_take and takes docs' columns as they are; existing
    columns of these names are replaced. Documents without words are taken in whole epochs
    and before the end of a prefix. A null lang, source or domain is the leaf ``unknown``;
    a null doc_id is one more id; rows that share a doc_id are taken and cut together.
    """
    leafed = with_leaf(docs, domain)
    rows = leafed.select("doc_id", *(F.col(f"_{x}").alias(x) for x in (*LEVELS, "n_tokens")))
    rows = written(rows, "leaves")
    leaves = rows.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("available"))
    granted = written(budgets(leaves, weights, share, max_epochs), "budgets")
    state = written(_prefixes(rows, granted, seed), "prefixes")

    own = [F.col(x).alias(f"_{x}") for x in LEVELS]
    state = state.select(*own, *(F.col(x).alias(f"_{x}") for x in ("epochs", "rest", "last_key", "last_size", "last_take")))
    key = _order_key(seed, F.col("_epochs"))
    part = (
        F.when(F.col("_rest") == 0, F.lit(None))
        .when(key < F.col("_last_key"), F.col("_n_tokens"))
        .when(key == F.col("_last_key"), F.expr("_n_tokens * _last_take div _last_size"))
    )
    whole = F.transform(
        F.sequence(F.lit(1), F.col("_epochs")),
        lambda e: F.struct((e - 1).cast("int").alias("epoch"), F.col("_n_tokens").alias("n_take")),
    )
    none = F.array().cast("array<struct<epoch: int, n_take: long>>")
    takes = F.concat(
        F.when(F.col("_epochs") > 0, whole).otherwise(none),
        F.when(part.isNotNull(), F.array(F.struct(F.col("_epochs").cast("int").alias("epoch"), part.alias("n_take")))).otherwise(none),
    )
    keep = [x for x in docs.columns if x not in ("domain", "epoch", "n_tokens", "n_take")]
    chosen = leafed.join(state, [f"_{x}" for x in LEVELS]).withColumn("_take", F.explode(takes))
    return chosen.select(
        *keep,
        F.col("_domain").alias("domain"),
        F.col("_take.epoch").alias("epoch"),
        F.col("_n_tokens").alias("n_tokens"),
        F.col("_take.n_take").alias("n_take"),
    )


def cut_text(mixed: DataFrame) -> DataFrame:
    """mixed with the text of a cut document reduced to its first n_take words, joined by
    blanks; other texts stay as they are."""
    words = F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), 1, F.col("n_take").cast("int"))
    return mixed.withColumn(
        "text", F.when(F.col("n_take") < F.col("n_tokens"), F.array_join(words, " ")).otherwise(F.col("text"))
    )
