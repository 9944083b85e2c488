"""Small tables for the corpus operators."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, **columns):
    """Documents with ids from 0; texts may be pairs (doc_id, text)."""
    rows = []
    for i, text in enumerate(texts):
        doc_id, text = text if isinstance(text, tuple) else (i, text)
        lang = columns.get("lang", {}).get(doc_id, "en")
        source = columns.get("source", {}).get(doc_id, f"src{(doc_id or 0) % 3}")
        rows.append((doc_id, text, lang, source, len(text or "")))
    return spark.createDataFrame(rows, DOCS)


def prose(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    """n invented words."""
    out = []
    for _ in range(n):
        w = rng.randrange(vocabulary)
        out.append("".join("bdfgklmnprstvz"[(w >> k) % 14] + "aeiou"[(w >> k) % 5] for k in (0, 3, 6)))
    return " ".join(out)


#: Texts that every operator must bear: nothing, blanks only, one word, ties and repeated
#: rows, other scripts, very long words and very long texts.
ODD = [
    None,
    "",
    " \t\n ",
    "one",
    "one",
    "on e",
    "Ещё одно слово, и 語 ｆｕｌｌ",
    "x" * 50_000,
    "a b c d e f g h " * 6_000,
    "😀 mixed spaces here | and <|endoftext|> marks",
]


def odd_documents(spark):
    """ODD with null ids and columns, repeated rows, and extra columns with clashing names."""
    rows = [(i, x, None if i % 3 == 0 else "en", None if i % 2 else "src1", None) for i, x in enumerate(ODD)]
    rows += [(None, "no id " * 30, "en", "src0", 5), (None, None, None, None, None), (3, "one", "en", "src1", 3), (3, "one", "en", "src1", 3)]
    df = spark.createDataFrame(rows, DOCS)
    from pyspark.sql import functions as F

    clash = "kept score spans part bucket domain epoch n_tokens digest copies row rep cluster key size"
    return df.withColumns({x: F.lit(1) for x in clash.split()})


def rows_by_id(df):
    return {r["doc_id"]: r.asDict() for r in df.collect()}
