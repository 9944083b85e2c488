"""Personal data, and terms that give it away, by information content.

Base entities are found by pattern, secrets by the information in their letters. Every entity
lies in a lattice learned from the corpus: the entity, its part (a domain, a network, an area, an
issuer), its kind. How strongly a term near an entity reveals a node of the lattice is
estimated from the other documents that hold the term, backing off from entity to part
to kind where there are few, so that entities of one document only are reached too.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstats.llm.arrays import U64, Words, distinct_pairs, text_slices, words
from tripstats.llm.groups import written

KINDS = ("email", "ip", "card", "phone")
SECRET = "secret"
GENERALISED, REMOVED = "term", "removed"

# The patterns of the base entities. An address begins at the first digit of
# a run: if it does not match there, it does not match later in that run.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# An unbroken run of letters and digits that changes between the two again and again.
RUN = re.compile(r"[A-Za-z0-9_+=]{20,}")
CHANGE = re.compile(r"[A-Za-z][0-9]|[0-9][A-Za-z]")
#: Bits that the letters of a run must hold, by how often each comes in it, and changes.
SECRET_BITS, SECRET_CHANGES = 60, 3

#: Terms on each side of an entity that are looked at.
CONTEXT = 10
#: Documents that the next node of the lattice counts for when a node is estimated.
PRIOR = 1.0
#: Share of a node's information content that a term must reveal: of an entity or its part
#: to be replaced by a general mark, of an entity to be taken out.
GENERALISE, REMOVE = 0.7, 0.9
#: Distinct terms that one task adds up before it sends them on.
TERMS_AT_ONCE = 1_000_000

_DIGIT = re.compile(r"[0-9]")
_EMAIL_CHAR = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_RUN_FROM_AT = re.compile(r"[A-Za-z0-9._%+@-]*")

# Terms are runs of ASCII letters and of anything beyond ASCII; ASCII letters fold to small.
_BYTES = np.arange(256)
_LETTER = (_BYTES >= 128) | ((_BYTES | 32) >= 97) & ((_BYTES | 32) <= 122)
_FOLD = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)


def terms(texts: pa.Array) -> Words:
    return words(texts, ~_LETTER, _FOLD)


def _luhn(digits: str) -> bool:
    total = 0
    for i, x in enumerate(reversed(digits)):
        n = int(x) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of EMAIL, which all lie in runs of its characters around an @."""
    done = 0
    while (at := text.find("@", done)) >= 0:
        start = at
        while start > done and text[start - 1] in _EMAIL_CHAR:
            start -= 1
        end = _RUN_FROM_AT.match(text, at).end()
        for found in EMAIL.finditer(text, start, end):
            yield found.span()
        done = end


def _byte_sized(digits: str) -> bool:
    digits = digits.lstrip("0") or "0"
    return len(digits) <= 3 and int(digits) <= 255


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base entities: by kind as in KINDS, then by start.

    Matches of one kind are leftmost and don't overlap; those that fail the kind's test
    are dropped and not tried again. Places are code points, end exclusive.
    """
    spans = [("email", *x) for x in _emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return spans
    for found in IP.finditer(text):
        if all(map(_byte_sized, found.group().split("."))):
            spans.append(("ip", *found.span()))
    for found in CARD.finditer(text):
        digits = found.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and _luhn(digits):
            spans.append(("card", *found.span()))
    if "+" in text:
        for found in PHONE.finditer(text):
            if 9 <= len(_DIGIT.findall(found.group())) <= 15:
                spans.append(("phone", *found.span()))
    return spans


def secret_spans(text: str) -> list[tuple[str, int, int]]:
    """Runs that hold too much information to be words: keys, tokens, digests."""
    spans = []
    for found in RUN.finditer(text):
        run = found.group()
        if len(CHANGE.findall(run)) >= SECRET_CHANGES:
            bits = sum(n * log2(len(run) / n) for n in Counter(run).values())
            if bits >= SECRET_BITS:
                spans.append((SECRET, *found.span()))
    return spans


def lattice(kind: str, value: str) -> tuple[bytes, bytes, bytes]:
    """An entity (an email in small letters, the digits of a number), its part and its kind.

    Parts: an email's domain, an address's first two numbers, a phone's first four digits, a
    card's first six, a secret's length.
    """
    if kind in ("card", "phone"):
        value = "".join(_DIGIT.findall(value))
    value = value if kind == SECRET else value.lower()
    part = {
        "email": value.rpartition("@")[2],
        "ip": ".".join(value.split(".")[:2]),
        "card": value[:6],
        "phone": value[:4],
    }.get(kind, str(len(value)))
    return f"0:{kind}:{value}".encode(), f"1:{kind}:{part}".encode(), f"2:{kind}".encode()


def _hashed(keys: list[bytes]) -> np.ndarray:
    """One 64-bit hash a key, by its bytes."""
    none = np.zeros(256, bool)
    return words(pa.array([x.decode() for x in keys], pa.string()), none).hash


def _byte_spans(text: str, spans) -> np.ndarray:
    if text.isascii():
        return np.array([(a, b) for _, a, b in spans], np.int64)
    return np.array([(len(text[:a].encode()), len(text[:b].encode())) for _, a, b in spans])


def _free(found: Words, own: slice, base: int, taken: np.ndarray) -> np.ndarray:
    """Terms of a text that are outside the spans ``taken`` (bytes)."""
    start, end = found.start[own] - base, found.end[own] - base
    free = np.ones(len(start), bool)
    for a, b in taken:
        free &= (end <= a) | (start >= b)
    return np.arange(own.start, own.stop)[free]


SPANS = "array<struct<kind: string, start: long, end: long>>"
SPANS_ARROW = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
)
NODES = [("entity", pa.int64()), ("part", pa.int64()), ("kind", pa.int64())]
NODES_SQL = "entity: long, part: long, kind: long"
ENTITIES = (
    f"doc_id long, spans {SPANS}, nodes array<struct<{NODES_SQL}>>, "
    f"near array<struct<{NODES_SQL}, name: string, term: long>>, text string"
)
ENTITIES_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("spans", SPANS_ARROW),
        ("nodes", pa.list_(pa.struct(NODES))),
        ("near", pa.list_(pa.struct([*NODES, ("name", pa.string()), ("term", pa.int64())]))),
        ("text", pa.string()),
    ]
)


def _as_structs(spans) -> list[dict]:
    return [{"kind": k, "start": a, "end": b} for k, a, b in spans]


def _signed(values: np.ndarray) -> list[int]:
    return values.view(np.int64).tolist()


def _base_heads(part: pa.RecordBatch) -> np.ndarray:
    """Where each text of a slice begins among its bytes."""
    sizes = np.array([len(x.encode()) for x in part["text"].to_pylist()], np.int64)
    return np.r_[0, np.cumsum(sizes)]


def find_entities(docs: DataFrame, context: int = CONTEXT) -> DataFrame:
    """Every document's spans of base entities and secrets, the distinct nodes of their
    lattice, the distinct (node, nearby term) rows, and its text if it has a span."""

    def near(text: str, spans, found: Words, own: slice, base: int) -> tuple[list, list]:
        nodes = _signed(_hashed([x for k, a, b in spans for x in lattice(k, text[a:b])]))
        nodes = [tuple(nodes[i : i + 3]) for i in range(0, len(nodes), 3)]
        places = _byte_spans(text, spans)
        free = _free(found, own, base, places)
        starts = found.start[free] - base
        pairs = {}
        for node, (name, *_), (a, _) in zip(nodes, spans, places):
            at = int(np.searchsorted(starts, a))
            for term in _signed(found.hash[free[max(0, at - context) : at + context]]):
                pairs[*node, name, term] = None
        fields = ("entity", "part", "kind", "name", "term")
        as_rows = lambda rows, n: [dict(zip(fields[:n], x)) for x in rows]
        return as_rows(dict.fromkeys(nodes), 3), as_rows(pairs, 5)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            texts = part["text"].to_pylist()
            spans = [base_spans(x) + secret_spans(x) for x in texts]
            rows = [([], [], [], None)] * len(texts)
            if any(spans):
                found, heads = terms(part["text"]), _base_heads(part)
                for i in (i for i, x in enumerate(spans) if x):
                    own = slice(int(found.first[i]), int(found.first[i + 1]))
                    nodes, pairs = near(texts[i], spans[i], found, own, heads[i])
                    rows[i] = (_as_structs(spans[i]), nodes, pairs, texts[i])
            columns = [pa.array(x, f.type) for x, f in zip(zip(*rows), list(ENTITIES_ARROW)[1:])]
            yield pa.RecordBatch.from_arrays([part["doc_id"], *columns], schema=ENTITIES_ARROW)

    return docs.mapInArrow(run, ENTITIES)


def count_terms(docs: DataFrame) -> DataFrame:
    """(term, n_term): documents that hold each term, of those in two or more; a term of one
    document says nothing about another.

    The counts of a task travel as bytes, dealt by the term; the sums are taken per bucket.
    """
    buckets = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def sums(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        keys, counts = np.concatenate(keys), np.concatenate(counts)
        known, at = np.unique(keys, return_inverse=True)
        return known, np.bincount(at, weights=counts).astype(np.int64)

    def packed(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        bucket = (keys % U64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        bucket, keys, counts = bucket[order], keys[order], counts[order].astype(np.uint32)
        cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        ends = [*cuts[1:], len(bucket)]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(bucket[cuts], pa.int32()),
                pa.array([keys[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary()),
                pa.array([counts[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary()),
            ],
            names=["bucket", "terms", "counts"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = [], []
        for part in text_slices(batches):
            found = terms(part["text"])
            _, once = distinct_pairs(found.doc, found.hash)
            if len(once):
                known, n = np.unique(once, return_counts=True)
                keys.append(known)
                counts.append(n)
            if sum(map(len, keys)) > TERMS_AT_ONCE:
                known, n = sums(keys, counts)
                keys, counts = [known], [n]
                if 2 * len(known) > TERMS_AT_ONCE:
                    yield packed(known, n)
                    keys, counts = [], []
        if keys:
            yield packed(*sums(keys, counts))

    def total(table: pa.Table) -> pa.Table:
        known, n = sums(
            [np.frombuffer(x, U64) for x in table["terms"].to_pylist()],
            [np.frombuffer(x, np.uint32) for x in table["counts"].to_pylist()],
        )
        often = n > 1
        return pa.table({"term": known[often].view(np.int64), "n_term": n[often]})

    sent = docs.select("text").mapInArrow(run, "bucket int, terms binary, counts binary")
    return sent.groupBy("bucket").applyInArrow(total, "term long, n_term long")


def revealing_terms(
    found: DataFrame, counted: DataFrame, prior: float = PRIOR
) -> DataFrame:
    """(entity, term, of_entity, of_part): the shares of the information content of the
    entity and of its part that the term reveals.

    For a document with both, the chance of a node given the term is that among the other
    documents with the term, with ``prior`` documents more that go by the node above:
    p(node | term) = (n(node, term) - 1 + prior * p(above | term) * n(node) / n(above)) /
    (n(term) - 1 + prior), and n(kind) / n stands in above the kind. The share is
    log(p(node | term) / p(node)) / -log p(node): 0 for a term that says nothing, 1 for one that
    gives the node away. Counts are numbers of documents.
    """
    near = found.select(F.explode("near").alias("x")).select("x.*").drop("name")
    known = near.distinct().join(counted, "term")
    n = float(found.count())
    above, chance = F.lit(n), F.lit(1.0)
    shares = {}
    for level in ("kind", "part", "entity"):
        # rows are distinct in a document, but a document may have several entities of a node
        pair = F.expr(f"array_distinct(transform(near, x -> struct(x.{level}, x.term)))")
        pairs = found.select(F.explode(pair).alias("x")).groupBy(f"x.{level}", "x.term")
        known = known.join(pairs.agg(F.count(F.lit(1)).alias(f"n_{level}_term")), [level, "term"])
        node = F.expr(f"array_distinct(transform(nodes, x -> x.{level}))")
        own = found.select(F.explode(node).alias(level)).groupBy(level)
        known = known.join(own.agg(F.count(F.lit(1)).alias(f"n_{level}")), level)
        count, both = F.col(f"n_{level}"), F.col(f"n_{level}_term")
        chance = (both - 1 + prior * chance * count / above) / (F.col("n_term") - 1 + prior)
        content = F.log(n / count)
        shares[f"of_{level}"] = F.when(content > 0, 1 + F.log(chance) / content)
        above = count
    return known.select("entity", "term", shares["of_entity"].alias("of_entity"), shares["of_part"].alias("of_part"))


def _sanitised(text: str, spans: list[tuple[str, int, int]], names: dict | None = None) -> str:
    """The text with each span replaced by its mark; removed terms leave nothing, generalised
    ones the kind they would say more about. Of overlapping spans the first gives the
    mark and all are covered."""
    out, done = [], 0
    for kind, a, b in sorted(spans, key=lambda x: (x[1], -x[2])):
        if a >= done:
            out.append(text[done:a])
            mark = f"{names[a, b]} term" if kind == GENERALISED and names else kind
            out.append("" if kind == REMOVED else f"[{mark.upper()}]")
        done = max(done, b)
    return "".join(out) + text[done:]


RESULT = f"doc_id long, spans {SPANS}, sanitised_text string"
RESULT_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("spans", SPANS_ARROW), ("sanitised_text", pa.string())]
)


def _marked(rows: DataFrame) -> DataFrame:
    """Spans of entities and the places of each document's revealing terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            found, heads = terms(part["text"]), _base_heads(part)
            out = []
            columns = (part[x].to_pylist() for x in ("text", "spans", "revealing"))
            for i, (text, base, revealing) in enumerate(zip(*columns)):
                spans, names = [(x["kind"], x["start"], x["end"]) for x in base], {}
                if revealing:
                    of = {x["term"]: (REMOVED if x["remove"] else GENERALISED, x["name"]) for x in revealing}
                    own = slice(int(found.first[i]), int(found.first[i + 1]))
                    free = _free(found, own, heads[i], _byte_spans(text, spans))
                    raw, more = text.encode(), []
                    for at, key in zip(free.tolist(), _signed(found.hash[free])):
                        if key in of:
                            a = len(raw[: found.start[at] - heads[i]].decode())
                            b = a + len(raw[found.start[at] - heads[i] : found.end[at] - heads[i]].decode())
                            more.append((of[key][0], a, b))
                            names[a, b] = of[key][1]
                    spans += sorted(more, key=lambda x: (x[0] == REMOVED, x[1]))
                out.append((_as_structs(spans), _sanitised(text, spans, names)))
            spans, texts = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [part["doc_id"], pa.array(spans, SPANS_ARROW), pa.array(texts, pa.string())],
                schema=RESULT_ARROW,
            )

    return rows.mapInArrow(run, RESULT)


def sanitise(
    docs: DataFrame,
    context: int = CONTEXT,
    prior: float = PRIOR,
    generalise: float = GENERALISE,
    remove: float = REMOVE,
) -> DataFrame:
    """Every document's spans of personal data and of terms that reveal it.

    Entities are the base kinds and secrets. A term within ``context`` terms of an entity (runs
    of letters of any length, ASCII ones made small) is taken out of the document if it
    reveals at least ``remove`` of the entity's information content, and replaced by a mark
    that names only the kind if it reveals ``generalise`` of the entity's or of its part's
    (see revealing_terms). What a term says about the kind alone stays, as the entity's
    mark says it too. All places of such a term in the document become spans, of kind
    ``removed`` or ``term``, but those inside entities. All counts are over all documents, copies
    included.

    Returns doc_id, spans (kind, start, end: base kinds in the order of KINDS, then secrets,
    terms and removed ones; each by start; code points, end exclusive) and sanitised_text, in
    which spans are replaced by their mark; it is null where there is no span and the text
    stays. A null text is empty. Rows are kept one by one whatever their doc_id; other columns
    of docs are not read. A task holds a slice of texts, or one text above its bound; a
    document meets only terms of its own.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = find_entities(docs, context).withColumn("row", F.monotonically_increasing_id())
    found = written(found, "entities")
    dirty = found.filter(F.size("spans") > 0)
    shares = revealing_terms(found, count_terms(docs), prior)
    takes_out = F.coalesce(F.col("of_entity") >= remove, F.lit(False)).alias("remove")
    shows = (F.col("of_entity") >= generalise) | (F.col("of_part") >= generalise)
    revealing = shares.filter(shows | takes_out).select("entity", "term", takes_out)
    own = (
        dirty.select("row", F.explode("near").alias("x"))
        .select("row", "x.entity", "x.name", "x.term")
        .join(revealing, ["entity", "term"])
        .groupBy("row", "term")
        .agg(F.max("remove").alias("remove"), F.min("name").alias("name"))
        .groupBy("row")
        .agg(F.collect_list(F.struct("term", "remove", "name")).alias("revealing"))
    )
    marked = _marked(dirty.select("row", "doc_id", "spans", "text").join(own, "row", "left"))
    clean = found.filter(F.size("spans") == 0)
    return marked.union(clean.select("doc_id", "spans", F.lit(None).cast("string")))
