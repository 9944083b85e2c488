"""Language spans: script ranges, word scores, and Viterbi with a switching penalty."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstats.llm.arrays import U64, mix, text_slices

#: Code point ranges of scripts; a letter outside all of them is of script "other".
# Unicode blocks.
SCRIPTS = [
    ("latin", 0x0041, 0x024F),
    ("latin", 0x1E00, 0x1EFF),
    ("greek", 0x0370, 0x03FF),
    ("greek", 0x1F00, 0x1FFF),
    ("cyrillic", 0x0400, 0x052F),
    ("armenian", 0x0530, 0x058F),
    ("hebrew", 0x0590, 0x05FF),
    ("arabic", 0x0600, 0x077F),
    ("devanagari", 0x0900, 0x097F),
    ("bengali", 0x0980, 0x09FF),
    ("tamil", 0x0B80, 0x0BFF),
    ("thai", 0x0E00, 0x0E7F),
    ("georgian", 0x10A0, 0x10FF),
    ("hangul", 0x1100, 0x11FF),
    ("kana", 0x3040, 0x30FF),
    ("han", 0x3400, 0x4DBF),
    ("han", 0x4E00, 0x9FFF),
    ("hangul", 0xAC00, 0xD7AF),
]
SCRIPT_NAMES = list(dict.fromkeys(x for x, _, _ in SCRIPTS)) + ["other"]
GRAM_BITS = 14
GRAMS = 1 << GRAM_BITS
#: Log-probability that a change of language between two words costs.
SWITCH_PENALTY = 12.0
#: Share of its letters that a language must have in a script to be a candidate there.
SCRIPT_SHARE = 0.01
UNDETERMINED = "und"
#: Text looked at together; a code point takes some 60 bytes on the way.
SLICE_BYTES = 1 << 20
FOLDS = 5


@cache
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """For every code point, its script number (-1: no letter) and its small letter."""
    n = 0x110000
    script = np.full(n, -1, np.int8)
    small = np.arange(n, dtype=np.uint32)
    for c in range(n):
        x = chr(c)
        if x.isalpha():
            script[c] = len(SCRIPT_NAMES) - 1
            if len(y := x.lower()) == 1:
                small[c] = ord(y)
    for name, low, high in SCRIPTS:
        own = script[low : high + 1]
        own[own >= 0] = SCRIPT_NAMES.index(name)
    return script, small


class LetterWords(NamedTuple):
    """Runs of letters: row, code point span in the row, script, and hashed letter trigrams
    (a word's trigrams begin at ``gram_start`` and include its two edges)."""

    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    script: np.ndarray
    grams: np.ndarray
    gram_start: np.ndarray


def letter_words(texts: list[str]) -> LetterWords:
    """The words of every text: maximal runs of letters, whatever their case."""
    script_of, small_of = _letters()
    joined = "\n".join(texts) + "\n"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    script = script_of[points]
    inside = np.r_[False, script >= 0, False]
    turn = np.flatnonzero(inside[1:] != inside[:-1]).reshape(-1, 2)
    start, end = turn[:, 0], turn[:, 1]
    lengths = np.array([len(x) + 1 for x in texts], np.int64)
    heads = np.r_[0, np.cumsum(lengths)[:-1]]
    doc = np.searchsorted(heads, start, "right") - 1
    # small letters with one zero after each word, so that edges are letters of their own
    size = end - start + 1
    gram_start = np.r_[0, np.cumsum(size)]
    total = int(gram_start[-1])
    letters = np.zeros(total + 1, U64)
    ends = np.zeros(total, bool)
    ends[gram_start[1:] - 1] = True
    letters[1:][~ends] = small_of[points[script >= 0]]
    last, second = letters[1:], letters[:-1]
    third = np.r_[U64(0), letters[:-2]] if total else letters[:0]
    third = np.where(np.r_[True, ends[:-1]][:total], U64(0), third)
    code = (third << U64(42)) | (second << U64(21)) | last
    grams = (mix(code, 7) >> U64(64 - GRAM_BITS)).astype(np.int64)
    return LetterWords(doc, start - heads[doc], end - heads[doc], script[start] if len(start) else script[:0], grams, gram_start)


def count_grams(docs: DataFrame) -> DataFrame:
    """(lang, kind, item, n) over all rows of docs: trigrams (kind 0) and letters per script
    (kind 1). Each task adds up its rows before anything is sent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams: dict[str, np.ndarray] = {}
        scripts: dict[str, np.ndarray] = {}
        for part in text_slices(batches, max_bytes=SLICE_BYTES):
            langs = np.array(part["lang"].to_pylist(), object)
            for lang in dict.fromkeys(langs):
                own = part["text"].filter(pa.array(langs == lang)).to_pylist()
                found = letter_words(own)
                grams[lang] = grams.get(lang, 0) + np.bincount(found.grams, minlength=GRAMS)
                scripts[lang] = scripts.get(lang, 0) + np.bincount(
                    found.script, weights=found.end - found.start, minlength=len(SCRIPT_NAMES)
                ).astype(np.int64)
        for kind, counts in enumerate((grams, scripts)):
            for lang, n in counts.items():
                item = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(item), pa.string()),
                        pa.array(np.full(len(item), kind), pa.int32()),
                        pa.array(item, pa.int32()),
                        pa.array(n[item], pa.int64()),
                    ],
                    names=["lang", "kind", "item", "n"],
                )

    partial = docs.select("text", "lang").mapInArrow(run, "lang string, kind int, item int, n long")
    return partial.groupBy("lang", "kind", "item").agg(F.sum("n").alias("n"))


class Model(NamedTuple):
    """langs in order; scores[gram, lang]; allowed[script, lang]."""

    langs: list[str]
    scores: np.ndarray
    allowed: np.ndarray


def fit(docs: DataFrame) -> Model:
    """Learn from every row of docs with a lang. The model has at most GRAMS counts a
    language, whatever the number of rows."""
    counts = count_grams(docs.filter(F.col("lang").isNotNull())).toArrow()
    lang, kind, item, n = (counts[x].to_numpy() for x in ("lang", "kind", "item", "n"))
    langs = sorted(set(lang))
    grams = np.zeros((GRAMS, len(langs)))
    scripts = np.zeros((len(SCRIPT_NAMES), len(langs)))
    at = np.array([langs.index(x) for x in lang], np.int64)
    grams[item[kind == 0], at[kind == 0]] = n[kind == 0]
    scripts[item[kind == 1], at[kind == 1]] = n[kind == 1]
    scores = np.log((grams + 0.5) / (grams.sum(0) + 0.5 * GRAMS)) if langs else grams
    allowed = scripts > 0
    allowed &= scripts >= SCRIPT_SHARE * scripts.sum(0)
    return Model(langs, scores.astype(np.float32), allowed)


def word_scores(found: LetterWords, model: Model) -> np.ndarray:
    """Log-probability of each word in each language. Languages that do not use the word's
    script are out, unless no language does; then all are as likely."""
    if not len(found.doc):
        return np.zeros((0, len(model.langs)), np.float32)
    score = np.add.reduceat(model.scores[found.grams], found.gram_start[:-1], axis=0)
    allowed = model.allowed[found.script]
    some = allowed.any(1)
    score[~some] = 0
    score[some[:, None] & ~allowed] = -np.inf
    return score


def best_paths(score: np.ndarray, first: np.ndarray, penalty: float) -> np.ndarray:
    """The likeliest language of each word; a change between neighbours costs ``penalty``.

    ``first`` has the place of each text's first word, and the end. All texts of a slice
    take their k-th step together, the longest first, so that those still running are a
    prefix. Ties go to the earlier language, and to staying.
    """
    n_words, n_langs = score.shape
    length = np.diff(first)
    order = np.argsort(-length, kind="stable")
    start = first[:-1][order]
    steps = int(length.max(initial=0))
    running = np.searchsorted(-length[order], -np.arange(1, steps + 1), "right")
    back = np.zeros((n_words, n_langs), np.int8 if n_langs < 128 else np.int32)
    best = np.zeros((len(order), n_langs), np.float64)
    stay = np.arange(n_langs)
    for k in range(steps):
        own = start[: running[k]] + k
        now = best[: running[k]]
        if k:
            top = now.argmax(1)
            switched = now[np.arange(len(own)), top] - penalty
            turn = switched[:, None] > now
            back[own] = np.where(turn, top[:, None], stay)
            now = np.where(turn, switched[:, None], now)
        best[: running[k]] = now + score[own]
    path = np.zeros(n_words, np.int64)
    state = best.argmax(1) if n_langs else np.zeros(len(order), np.int64)
    for k in range(steps - 1, -1, -1):
        own = start[: running[k]] + k
        path[own] = state[: running[k]]
        state[: running[k]] = back[own, state[: running[k]]]
    return path


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))


def label_spans(
    docs: DataFrame, model: Model, penalty: float = SWITCH_PENALTY, keep_text: bool = False
) -> DataFrame:
    """The columns of docs, of text on request only, and lang_pred, score and spans.

    spans are stretches of words of one language (code points, end exclusive). lang_pred is
    the language of most letters, ties going to the first by name, and score its share of
    them. A text that is null or has no letter, and any text under a model that has
    learned nothing, has ``und``, score 0 and no spans. Texts are looked at SLICE_BYTES at a time;
    a single text above that takes some 60 bytes a code point while it is looked at. A language without a
    script of its own in training is never predicted for another script's words. A null text
    that is kept comes back empty.
    """
    others = [x for x in docs.columns if x != "text" or keep_text]
    langs = model.langs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, max_bytes=SLICE_BYTES):
            n = part.num_rows
            found = letter_words(part["text"].to_pylist())
            first = np.searchsorted(found.doc, np.arange(n + 1))
            pred, share, spans = [UNDETERMINED] * n, np.zeros(n), [[] for _ in range(n)]
            if langs and len(found.doc):
                path = best_paths(word_scores(found, model), first, penalty)
                letters = np.zeros((n, len(langs)))
                np.add.at(letters, (found.doc, path), found.end - found.start)
                total = letters.sum(1)
                top = letters.argmax(1)
                full = np.flatnonzero(total)
                share[full] = letters[full, top[full]] / total[full]
                new = np.ones(len(path), bool)
                new[1:] = (found.doc[1:] != found.doc[:-1]) | (path[1:] != path[:-1])
                opens = np.flatnonzero(new)
                closes = np.r_[opens[1:], len(path)] - 1
                for i in full:
                    pred[i] = langs[top[i]]
                for a, b in zip(opens.tolist(), closes.tolist()):
                    spans[found.doc[a]].append(
                        {"start": int(found.start[a]), "end": int(found.end[b]), "lang": langs[path[a]]}
                    )
            yield pa.RecordBatch.from_arrays(
                [*(part[x] for x in others), pa.array(pred), pa.array(share), pa.array(spans, SPANS)],
                names=[*others, "lang_pred", "score", "spans"],
            )

    kinds = dict(docs.dtypes)
    schema = ", ".join(f"`{x}` {kinds[x]}" for x in others) + (", " if others else "")
    schema += "lang_pred string, score double, spans array<struct<start: long, end: long, lang: string>>"
    return docs.mapInArrow(run, schema)


def held_out(doc_id: str = "doc_id"):
    """Whether a document is outside the rows to learn from: crc32 of its id as text is
    divisible by FOLDS. A null id is not learned from either."""
    remainder = F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS
    return F.coalesce(remainder == 0, F.lit(True))


def identify(docs: DataFrame, penalty: float = SWITCH_PENALTY) -> DataFrame:
    """Learn on the rows of docs that are not held out, then label all of them.

    Returns doc_id, held_out, lang_pred, score and spans, a row per input row. A null
    doc_id counts as held out; a null lang is not learned from. An empty table gives no rows;
    repeated rows are judged alike; other columns are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    model = fit(docs.filter(~held_out()))
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    return label_spans(rows, model, penalty)
