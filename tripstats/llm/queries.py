"""The operators on the given tables, each with its SQL twin where SQL can express it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstats.llm import (
    collocations,
    exact,
    grammar,
    importance,
    jaccard,
    language,
    mixing,
    packing,
    preference,
    quality,
    repeats,
    sanitise,
    substrings,
)
from tripstats.sources.workspace import new_path


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


#: Parameters of the mix: weights of domains and of languages in them; three quarters of all
#: tokens; no document more than twice.
DOMAIN_WEIGHTS = {"domain0": 4, "domain1": 3, "domain2": 2, "domain3": 1}
LANG_WEIGHTS = {"en": 3, "de": 2, "fr": 2, "es": 2}
SHARE, MAX_EPOCHS = (3, 4), 2
MIX_WEIGHTS = [(d, None, None, w) for d, w in DOMAIN_WEIGHTS.items()] + [
    (d, lang, None, w) for d in DOMAIN_WEIGHTS for lang, w in LANG_WEIGHTS.items()
]


def mix_weights(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        MIX_WEIGHTS, "domain string, lang string, source string, weight long"
    )


def domain() -> Column:
    """A domain for each source: sources are dealt to four by their number."""
    number = F.regexp_extract("source", "([0-9]+)$", 1).try_cast("long")
    return F.concat(F.lit("domain"), (number % 4).cast("string"))


def op1_hierarchical_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents to train on, by epoch, for the target weights."""
    docs = _documents(spark, sf_dir)
    mixed = mixing.mix(docs, domain(), mix_weights(spark), SHARE, MAX_EPOCHS)
    lang, source = (F.coalesce(x, F.lit(mixing.UNKNOWN)).alias(x) for x in ("lang", "source"))
    return mixed.select("doc_id", "domain", lang, source, "epoch", "n_tokens", "n_take")


def op2_fixed_block_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the passages of 13 words that an earlier document has."""
    found = repeats.remove_repeats(_documents(spark, sf_dir))
    return found.select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"), "repeats"
    ).withColumn("repeats", F.size("repeats").cast("long"))


def _joined(spans: Column) -> Column:
    """kind:start:end of every span, joined by commas."""
    one = lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])
    return F.array_join(F.transform(spans, one), ",")


def _of_kind(kind: str):
    return lambda x: x["kind"] == kind


def op3_information_sanitiser(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document, and the terms that reveal it."""
    found = sanitise.sanitise(_documents(spark, sf_dir))
    added = (sanitise.SECRET, sanitise.GENERALISED, sanitise.REMOVED)
    count = {
        f"n_{kind}": F.size(F.filter("spans", _of_kind(kind))).cast("long")
        for kind in (*sanitise.KINDS, *added)
    }
    base = F.filter("spans", lambda x: x["kind"].isin(*sanitise.KINDS))
    counted = {name: value.alias(name) for name, value in count.items()}
    return found.select(
        "doc_id",
        *(counted[f"n_{kind}"] for kind in sanitise.KINDS),
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
        *(counted[f"n_{kind}"] for kind in added),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("sanitised_text", 256).alias("sanitised_sha256"),
    )


def op4_salted_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one that stays for its content."""
    return exact.exact_duplicates(_documents(spark, sf_dir))


def op5_isolation_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its rule statistics and verdict."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    judged = quality.judge(_documents(spark, sf_dir), labels)
    return judged.select("doc_id", *quality.COUNTS, "base_failed", "kept", "anomaly", "threshold")


def op6_viterbi_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those that are not held out."""
    found = language.identify(_documents(spark, sf_dir))
    return found.withColumn("n_spans", F.size("spans").cast("long")).drop("spans")


def op7_bayesian_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its class of near duplicates and its number of links."""
    classes = jaccard.near_duplicates(_documents(spark, sf_dir))
    return classes.select("doc_id", "class_id", "n_links", "n_shingles", "representative")


def op8_bounded_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens and their places in sequences of 1024."""
    return packing.pack(_documents(spark, sf_dir), checksums=True).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def op9_repair_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, written to grammar-compressed files and read back."""
    path = new_path(spark, "tokens")
    grammar.write_tokens(_documents(spark, sf_dir), path)
    ids_crc32 = F.crc32("ids").alias("ids_crc32")
    return grammar.read_tokens(spark, path).select("doc_id", "start", "n_tokens", ids_crc32, "middle_id")


def op10_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of preference pairs: shared prompts and masked completions."""
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return preference.format_pairs(*preference.pairs_of(conversations)).drop("text")


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its weight towards the benchmark's texts and its rank in the draw."""
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = importance.resample(_documents(spark, sf_dir), target)
    return found.select("doc_id", "n_features", "weight", "score", "rank", "n_words")


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The closest phrases of each language."""
    return collocations.collocations(_documents(spark, sf_dir))


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the strings of 200 bytes that begin anywhere else too."""
    found = substrings.remove_substrings(_documents(spark, sf_dir))
    n_spans, kept = F.size("repeats").cast("long"), F.sha2("kept", 256)
    return found.select(
        "doc_id", "n_bytes", "n_removed", n_spans.alias("n_spans"), kept.alias("kept_sha256")
    )


QUERIES = {
    "op1_hierarchical_mix": op1_hierarchical_mix,
    "op2_fixed_block_anchors": op2_fixed_block_anchors,
    "op3_information_sanitiser": op3_information_sanitiser,
    "op4_salted_exact_dedup": op4_salted_exact_dedup,
    "op5_isolation_forest": op5_isolation_forest,
    "op6_viterbi_language": op6_viterbi_language,
    "op7_bayesian_jaccard": op7_bayesian_jaccard,
    "op8_bounded_best_fit": op8_bounded_best_fit,
    "op9_repair_tokens": op9_repair_tokens,
    "op10_preference_format": op10_preference_format,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_phrase_collocations": op12_phrase_collocations,
    "op13_suffix_dedup": op13_suffix_dedup,
}


def _level_sql(depth: int) -> str:
    """CTEs that grant the nodes of one level their tokens."""
    keys, parents = mixing.LEVELS[: depth + 1], mixing.LEVELS[:depth]
    key, by = keys[-1], f"PARTITION BY {', '.join(parents)}" if parents else ""
    own, null = ", ".join(keys), " AND ".join(f"{x} IS NULL" for x in mixing.LEVELS[depth + 1 :])
    rule = f"{key} IS NOT NULL" + (f" AND {null}" if null else "")
    root = f"(SELECT sum(available) * {SHARE[0]} // {SHARE[1]} AS granted FROM leaves)"
    above = f"JOIN b{depth - 1} USING ({', '.join(parents)})" if parents else f", {root}"
    order = f"{by} ORDER BY CAST(capacity AS DOUBLE) / weight, {key}"
    return f"""
        n{depth} AS (SELECT {own}, sum(available) * {MAX_EPOCHS} AS capacity FROM leaves GROUP BY {own}),
        w{depth} AS (SELECT {own}, max(weight) AS weight FROM weights WHERE {rule} GROUP BY {own}),
        m{depth} AS (SELECT n{depth}.*, coalesce(weight, 1) AS weight, granted AS budget
                     FROM n{depth} LEFT JOIN w{depth} USING ({own}) {above}),
        f{depth} AS (
            SELECT *, capacity * sum(weight) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
                + weight * coalesce(sum(capacity) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                <= weight * budget AS is_full
            FROM m{depth} WHERE weight > 0),
        g{depth} AS (
            SELECT *, budget - sum(CASE WHEN is_full THEN capacity ELSE 0 END) OVER ({by}) AS rest,
                sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER ({by}) AS open_weight,
                sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER ({by} ORDER BY {key}) AS upto
            FROM f{depth}),
        b{depth} AS (
            SELECT {own}, CASE WHEN is_full THEN capacity
                ELSE upto * rest // open_weight - (upto - weight) * rest // open_weight END AS granted
            FROM g{depth})"""


def _quoted(value) -> str:
    return "CAST(NULL AS VARCHAR)" if value is None else f"'{value}'"


_WEIGHTS = ", ".join(f"({', '.join(map(_quoted, row[:3]))}, {row[3]})" for row in MIX_WEIGHTS)

_MIX_SQL = rf"""
    WITH weights(domain, lang, source, weight) AS (VALUES {_WEIGHTS}),
    docs AS (
        SELECT doc_id, coalesce(lang, 'unknown') AS lang, coalesce(source, 'unknown') AS source,
            coalesce('domain' || TRY_CAST(regexp_extract(source, '([0-9]+)$', 1) AS BIGINT) % 4, 'unknown') AS domain,
            len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n_tokens
        FROM documents),
    leaves AS (SELECT domain, lang, source, sum(n_tokens) AS available FROM docs GROUP BY ALL),
    {", ".join(_level_sql(depth) for depth in range(3))},
    leaf AS (SELECT domain, lang, source, granted // available AS epochs, granted % available AS rest
             FROM b2 JOIN leaves USING (domain, lang, source) WHERE available > 0),
    placed AS (
        SELECT *, sum(n_tokens) OVER (
            PARTITION BY domain, lang, source
            ORDER BY md5(concat_ws(':', '{mixing.SEED}', epochs, doc_id))) AS upto
        FROM docs JOIN leaf USING (domain, lang, source)),
    taken AS (
        SELECT *, unnest(generate_series(0, CAST(epochs AS BIGINT) - 1)) AS epoch, n_tokens AS n_take FROM placed
        UNION ALL
        SELECT *, epochs AS epoch, least(n_tokens, rest - (upto - n_tokens)) AS n_take
        FROM placed WHERE rest > 0 AND upto - n_tokens < rest)
    SELECT doc_id, domain, lang, source, CAST(epoch AS INTEGER) AS epoch,
        CAST(n_tokens AS BIGINT) AS n_tokens, CAST(n_take AS BIGINT) AS n_take
    FROM taken
"""

SQL = {
    "op1_hierarchical_mix": _MIX_SQL,
    "op2_fixed_block_anchors": r"""
        WITH w AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
            FROM documents),
        p AS (SELECT doc_id, ws, unnest(generate_series(1, len(ws))) AS i FROM w),
        g AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS gram
              FROM p WHERE i + 12 <= len(ws)),
        f AS (SELECT gram, min(doc_id) AS first_id FROM g GROUP BY gram),
        hit AS (SELECT DISTINCT g.doc_id, g.i FROM g JOIN f USING (gram) WHERE f.first_id < g.doc_id),
        gone AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 12)) AS i FROM hit),
        runs AS (SELECT doc_id, count(*) AS n FROM gone a
                 WHERE NOT EXISTS (SELECT 1 FROM gone b WHERE b.doc_id = a.doc_id AND b.i = a.i - 1)
                 GROUP BY doc_id),
        kept AS (SELECT p.doc_id, count(*) AS n, string_agg(ws[i], ' ' ORDER BY i) AS t
                 FROM p ANTI JOIN gone USING (doc_id, i) GROUP BY p.doc_id)
        SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
               CAST(len(ws) - coalesce(kept.n, 0) AS BIGINT) AS n_removed,
               sha256(coalesce(kept.t, '')) AS kept_sha256,
               CAST(coalesce(runs.n, 0) AS BIGINT) AS repeats
        FROM w LEFT JOIN kept USING (doc_id) LEFT JOIN runs USING (doc_id)
    """,
    "op4_salted_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, length(coalesce(text, '')) AS n,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content
            FROM documents),
        r AS (SELECT *, first_value(doc_id) OVER best AS keep_id,
                     count(*) OVER (PARTITION BY content) AS group_size
              FROM d WINDOW best AS (PARTITION BY content ORDER BY n DESC, doc_id))
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(content) AS text_sha256
        FROM r
    """,
    "op7_bayesian_jaccard": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
            FROM documents),
        p AS (SELECT doc_id, ws, unnest(generate_series(1, greatest(len(ws) - 4, least(len(ws), 1)))) AS i
              FROM w),
        g AS MATERIALIZED (SELECT DISTINCT doc_id, hash(array_to_string(ws[i:i + 4], ' ')) AS gram FROM p),
        s AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
        c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common
              FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY ALL),
        link AS MATERIALIZED (
            SELECT x, y FROM c JOIN s sx ON x = sx.doc_id JOIN s sy ON y = sy.doc_id
            WHERE common * 10 >= 8 * (sx.n + sy.n - common)),
        reach AS (SELECT doc_id AS x, doc_id AS y FROM w
                  UNION SELECT reach.x, link.y FROM reach JOIN link ON reach.y = link.x),
        class AS (SELECT x AS doc_id, min(y) AS class_id FROM reach GROUP BY x),
        copies AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY sig) AS representative
                   FROM (SELECT doc_id, list(gram ORDER BY gram) AS sig FROM g GROUP BY doc_id)),
        degree AS (SELECT x AS doc_id, count(*) AS n FROM link GROUP BY x)
        SELECT w.doc_id, class_id, CAST(coalesce(degree.n, 0) AS BIGINT) AS n_links,
               CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles,
               coalesce(representative, w.doc_id) AS representative
        FROM w JOIN class USING (doc_id) LEFT JOIN s USING (doc_id)
        LEFT JOIN copies USING (doc_id) LEFT JOIN degree USING (doc_id)
    """,
    "op10_preference_format": """
        WITH t AS (
            SELECT DISTINCT conv_id, coalesce(turn, -1) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text
            FROM conversations WHERE conv_id IS NOT NULL),
        k AS (
            SELECT conv_id, first(role ORDER BY turn, role, text) AS open_role,
                first(text ORDER BY turn, role, text) AS open_text,
                coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS said,
                max(turn) FILTER (role = 'assistant') AS last
            FROM t GROUP BY conv_id),
        b AS (
            SELECT *, count(*) OVER (PARTITION BY open_role, open_text) AS n,
                first_value(conv_id) OVER (PARTITION BY open_role, open_text ORDER BY said DESC, conv_id) AS best_id
            FROM k),
        good AS (
            SELECT b.conv_id AS pair_id, turn, role, text FROM b JOIN t ON t.conv_id = best_id
            WHERE n > 1 AND b.conv_id <> best_id
            UNION ALL
            SELECT conv_id, turn, role, text FROM b JOIN t USING (conv_id)
            WHERE n = 1 AND (last IS NULL OR turn <= last)),
        bad AS (
            SELECT conv_id AS pair_id, turn, role, text FROM b JOIN t USING (conv_id)
            WHERE n > 1 AND conv_id <> best_id OR n = 1 AND (last IS NULL OR turn < last)
            UNION ALL
            SELECT conv_id, last, 'assistant', last(text ORDER BY turn, text) FROM b JOIN t USING (conv_id)
            WHERE n = 1 AND role = 'assistant' AND turn < last GROUP BY conv_id, last),
        sg AS (SELECT pair_id, turn, list(row(role, text) ORDER BY role, text) AS x FROM good GROUP BY ALL),
        sb AS (SELECT pair_id, turn, list(row(role, text) ORDER BY role, text) AS x FROM bad GROUP BY ALL),
        cut AS (
            SELECT pair_id, min(turn) AS splits_at FROM sg FULL JOIN sb USING (pair_id, turn)
            WHERE sg.x IS DISTINCT FROM sb.x GROUP BY pair_id),
        r AS (
            SELECT pair_id, turn, role, text,
                CASE WHEN splits_at IS NULL OR turn < splits_at THEN 'prompt' ELSE 'chosen' END AS part
            FROM good LEFT JOIN cut USING (pair_id)
            UNION ALL
            SELECT pair_id, turn, role, text, 'rejected' FROM bad JOIN cut USING (pair_id) WHERE turn >= splits_at)
        SELECT pair_id, part, turn, role, part <> 'prompt' AND role = 'assistant' AS trained,
            concat('<|im_start|>', role, chr(10), text, '<|im_end|>', chr(10)) AS rendered,
            CAST(length(concat('<|im_start|>', role, chr(10))) + CASE WHEN part <> 'prompt' AND role = 'assistant' THEN 0
                ELSE length(concat(text, '<|im_end|>', chr(10))) END AS BIGINT) AS learn_from
        FROM r
    """,
    "op13_suffix_dedup": r"""
        WITH d AS (SELECT row_number() OVER () AS d, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
        p AS (SELECT d, unnest(generate_series(1, len(x) // 2 - 199)) AS i FROM d WHERE len(x) >= 400),
        h AS MATERIALIZED (SELECT d, i, md5_number(substr(x, 2 * i - 1, 400)) AS w FROM p JOIN d USING (d)),
        twice AS (SELECT w FROM h GROUP BY w HAVING count(*) > 1),
        hit AS (SELECT d, i, lag(i) OVER (PARTITION BY d ORDER BY i) AS before FROM h SEMI JOIN twice USING (w)),
        runs AS (
            SELECT d, i, sum(CASE WHEN before IS NULL OR i > before + 200 THEN 1 ELSE 0 END)
                OVER (PARTITION BY d ORDER BY i) AS run
            FROM hit),
        span AS (SELECT d, run, min(i) AS a, max(i) + 200 AS b FROM runs GROUP BY d, run),
        gaps AS (
            SELECT d, a, b, coalesce(lag(b) OVER (PARTITION BY d ORDER BY a), 1) AS upto FROM span),
        kept AS (
            SELECT d, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS upto,
                string_agg(substr(x, 2 * upto - 1, 2 * (a - upto)), '' ORDER BY a) AS x
            FROM gaps JOIN d USING (d) GROUP BY d)
        SELECT doc_id, CAST(len(d.x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
            coalesce(n_spans, 0) AS n_spans,
            sha256(unhex(CASE WHEN kept.d IS NULL THEN d.x ELSE kept.x || substr(d.x, 2 * upto - 1) END)) AS kept_sha256
        FROM d LEFT JOIN kept USING (d)
    """,
    "op12_phrase_collocations": r"""
        WITH d AS (
            SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang,
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
            FROM documents),
        p AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
        w AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
        one AS (SELECT lang, unnest(ws) AS x FROM w),
        total AS (SELECT lang, count(*) AS n FROM one GROUP BY lang),
        grams AS (
            SELECT lang, unnest([ws[i:i + 1] FOR i IN generate_series(1, len(ws) - 1)]) AS ws FROM w
            UNION ALL
            SELECT lang, unnest([ws[i:i + 2] FOR i IN generate_series(1, len(ws) - 2)]) AS ws FROM w
            UNION ALL
            SELECT lang, [x] FROM one),
        f AS MATERIALIZED (
            SELECT lang, ws, array_to_string(ws, ' ') AS phrase, count(*) AS a FROM grams GROUP BY lang, ws HAVING count(*) >= 10),
        cuts AS (
            SELECT f.*, k, l.a AS l, r.a AS r,
                1000000::HUGEINT * f.a * f.a // (l.a::HUGEINT * r.a) AS score
            FROM (SELECT *, unnest(generate_series(1, len(ws) - 1)) AS k FROM f WHERE len(ws) > 1) f
            JOIN f l ON l.lang = f.lang AND l.ws = f.ws[1:k]
            JOIN f r ON r.lang = f.lang AND r.ws = f.ws[k + 1:]),
        low AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, ws ORDER BY score, k) = 1),
        longer AS (
            SELECT lang, part, max(a) AS most
            FROM (SELECT lang, unnest([ws[1:2], ws[2:3]]) AS part, a FROM f WHERE len(ws) = 3) GROUP BY lang, part),
        best AS (
            SELECT low.*, row_number() OVER (PARTITION BY low.lang ORDER BY score DESC, a DESC, phrase) AS rank
            FROM low LEFT JOIN longer ON longer.lang = low.lang AND longer.part = low.ws
            WHERE most IS NULL OR 100 * most < 50 * a)
        SELECT lang, rank, phrase, a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n, CAST(score AS BIGINT) AS score
        FROM best JOIN total USING (lang) WHERE rank <= 2000
    """,
}
