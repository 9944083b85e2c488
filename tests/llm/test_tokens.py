"""Encoder, packing and token files."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from corpus_frames import ODD, documents, odd_documents, prose
from tokenizers import Tokenizer

from tripstats.llm import grammar, packing, tokens
from tripstats.sources.workspace import new_path

NAMES = ["byte_bpe_50k.json", "word_bpe_49k.json"]


def library(name):
    return Tokenizer.from_file(tokens.tokenizer_path(name))


def plain_ids(name, texts):
    return [x.ids for x in library(name).encode_batch([t or "" for t in texts], add_special_tokens=False)]


@pytest.mark.parametrize("name", NAMES)
def test_pieces_encode_as_whole_texts(name, monkeypatch):
    rng = random.Random(7)
    bits = ["a", "Word", "'s", ".", ",", " ", "\n", "1", "é", "|", " |", "#", "<|endoftext|>", "\t", " ", "\0", "Σ"]
    texts = ["".join(rng.choices(bits, k=rng.randrange(30))) for _ in range(1500)]
    texts += [x or "" for x in ODD] + [prose(rng, 300) for _ in range(20)]
    monkeypatch.setattr(tokens, "MEMORY", 700)  # the memory overflows again and again
    encoder = tokens.Encoder(name)
    got = [y for i in range(0, len(texts), 100) for y in encoder.encode(texts[i : i + 100])]
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == plain_ids(name, texts)


@pytest.mark.parametrize("name", NAMES)
def test_marks_after_every_code_point(name):
    """Also after those that a vocabulary folds into a letter and a mark."""
    points = [chr(c) for c in range(0x21, 0x30000) if not 0xD800 <= c < 0xE000]
    encoder, bad = tokens.Encoder(name), []
    for form in ("{}.", "ax{},", " {}. b"):
        texts = [form.format(x) for x in points]
        for i in range(0, len(texts), 20_000):
            part = texts[i : i + 20_000]
            got = encoder.encode(part)
            expected = encoder.tokenizer.encode_batch_fast(part, add_special_tokens=False)
            bad += [t for t, x, y in zip(part, got, expected) if np.frombuffer(x, "<u4").tolist() != y.ids]
    assert not bad


def test_words_of_one_hash_are_told_apart(monkeypatch):
    """With hashes of three bits nearly all words clash, in a slice and with those remembered."""
    monkeypatch.setattr(tokens, "hash_spans", lambda data, start, end: (end - start).astype(np.uint64) % np.uint64(3))
    monkeypatch.setattr(tokens, "mix", lambda x: x % np.uint64(5))
    rng = random.Random(3)
    texts = [prose(rng, n) for n in (1, 1, 2, 1, 30, 1)] + ["a", "b", "b", "a b", "b a"]
    for name in NAMES:
        encoder = tokens.Encoder(name)
        for _ in range(2):
            got = [y for x in texts for y in encoder.encode([x])] + encoder.encode(texts)
            assert [np.frombuffer(x, "<u4").tolist() for x in got] == 2 * plain_ids(name, texts)


def test_best_fit_as_brute_force():
    """The tightest open bin takes a piece; with all open and none fitting the fullest closes."""
    rng = random.Random(2)
    bins = packing.BestFit(20, 4)
    free = {}
    for _ in range(3000):
        n = rng.randrange(1, 21)
        fits = [f for f in free.values() if f >= n]
        chosen, offset = bins.place(n)
        if fits:
            assert free[chosen] == min(fits)
        else:
            if n < 20 and len(free) == 4:
                closed = min(free.values())
                gone = next(b for b in reversed(list(free)) if free[b] == closed)
                open_now = {b for f in bins.bins for b in f}
                (gone,) = set(free) - open_now
                assert free.pop(gone) == closed
            free[chosen] = 20
        assert offset == 20 - free[chosen]
        free[chosen] -= n
        if not free[chosen]:
            del free[chosen]
        assert bins.n_open == len(free) <= 4


def test_packing(spark):
    rng = random.Random(1)
    texts = [prose(rng, rng.randrange(0, 700)) for _ in range(80)] + [prose(rng, 6000), None, ""]
    rows = packing.pack(documents(spark, texts)).collect()
    expected = [x + [packing.END_ID] for x in plain_ids(packing.TOKENIZER, texts)]
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        bins[r.sequence_id].append((r.offset, r.length))
        assert len(r.ids) == 4 * r.length <= 4 * packing.CAPACITY
    for d, ids in enumerate(expected):
        own = sorted(pieces[d], key=lambda r: r.piece)
        assert np.frombuffer(b"".join(r.ids for r in own), "<u4").tolist() == ids
        assert [r.start for r in own] == np.r_[0, np.cumsum([r.length for r in own])][:-1].tolist()
        assert all(r.length == packing.CAPACITY for r in own[1:])
    for own in bins.values():
        own.sort()
        assert [o for o, _ in own] == np.r_[0, np.cumsum([n for _, n in own])][:-1].tolist()
        assert sum(n for _, n in own) <= packing.CAPACITY
    total = sum(map(len, expected))
    assert len(bins) <= 1.1 * total / packing.CAPACITY + spark.sparkContext.defaultParallelism


def test_packing_odd_rows(spark):
    docs = odd_documents(spark)
    rows = packing.pack(docs).collect()
    assert Counter(r.doc_id for r in rows if r.piece == 0) == Counter(r.doc_id for r in docs.collect())
    assert packing.pack(docs.limit(0)).collect() == []


@pytest.mark.parametrize("ids", [[], [5], [7] * 1000, list(range(300)), [1, 2, 3, 1, 2] * 500])
def test_grammar_round_trip(ids):
    raw = np.array(ids, "<u4").tobytes()
    shard = grammar.from_bytes(grammar.to_bytes([None, -(2**63), 3], [len(ids), 0, 0], raw))
    assert grammar.decode(shard) == raw
    assert shard.has_id.tolist() == [0, 1, 1] and shard.doc_ids.tolist()[1:] == [-(2**63), 3]
    access = grammar.Access(shard)
    for start in range(0, len(ids), 37):
        assert access.range(start, 11) == ids[start : start + 11]
    assert len(shard.symbols) < len(ids) or len(set(ids)) == len(ids)


def occurrences(seq):
    """How often each neighbouring pair occurs without overlap, by a plain scan."""
    count, last = Counter(), {}
    for i, pair in enumerate(zip(seq, seq[1:])):
        if last.get(pair) != i - 1 or pair[0] != pair[1]:
            count[pair] += 1
            last[pair] = i
    return count


@pytest.mark.parametrize("seed", range(12))
@pytest.mark.parametrize("least", [2, 3, 6])
def test_grammar_leaves_no_frequent_pair(seed, least):
    rng = random.Random(seed)
    phrases = [[rng.randrange(1 + 3 * seed) for _ in range(rng.randrange(1, 9))] for _ in range(9)]
    ids = [x for _ in range(400) for x in rng.choice(phrases)] + [4] * rng.randrange(50)
    terminals, left, right, seq = grammar.compress(np.array(ids, np.uint32), least)
    assert max(occurrences(seq.tolist()).values(), default=0) < least
    rules = list(zip(left.tolist(), right.tolist()))
    assert len(set(rules)) == len(rules)
    n = grammar.expansions(terminals, left, right)
    used = Counter([*seq.tolist(), *left.tolist(), *right.tolist()])
    assert all(used[terminals + k] for k in range(len(n)))
    out, stack = [], seq.tolist()[::-1]
    while stack:
        x = stack.pop()
        if x < terminals:
            out.append(x)
        else:
            stack += [rules[x - terminals][1], rules[x - terminals][0]]
    assert out == ids


def test_the_most_frequent_pair_goes_first():
    ids = [1, 2] * 50 + [2, 3] * 20 + [9]
    _, left, right, _ = grammar.compress(np.array(ids, np.uint32), 6)
    assert (left[0], right[0]) == (2, 3) or (left[:2].tolist(), right[:2].tolist()) == ([2, 1], [3, 2])
    best = max(occurrences(ids).items(), key=lambda x: x[1])[0]
    assert best in list(zip(left.tolist(), right.tolist()))


QUERY_DIR = "/root/testdata/sf0.001"


def test_packing_query_columns(spark):
    from tripstats.llm import queries

    df = queries.op8_bounded_best_fit(spark, QUERY_DIR)
    kinds = ["bigint", "int", "bigint", "bigint", "bigint", "bigint", "bigint"]
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert df.dtypes == list(zip(names, kinds))
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{QUERY_DIR}/documents.parquet").collect()}
    ids = dict(zip(docs, plain_ids(packing.TOKENIZER, docs.values())))
    bins, seen = defaultdict(list), Counter()
    for r in df.collect():
        own = np.array(ids[r.doc_id] + [packing.END_ID], "<u4")
        n = len(own)
        first = (n - 1) % 1024 + 1
        assert r.start == (first + 1024 * (r.piece - 1) if r.piece else 0)
        assert r.length == (1024 if r.piece else first)
        assert r.ids_crc32 == zlib.crc32(own[r.start : r.start + r.length].tobytes())
        bins[r.sequence_id].append((r.offset, r.length))
        seen[r.doc_id] += r.length
    assert seen == {d: len(x) + 1 for d, x in ids.items()}
    for own in bins.values():
        own.sort()
        assert [o for o, _ in own] == np.r_[0, np.cumsum([n for _, n in own])][:-1].tolist()


def test_token_query_columns(spark):
    from tripstats.llm import queries

    df = queries.op9_repair_tokens(spark, QUERY_DIR)
    assert df.dtypes[:4] == [(x, "bigint") for x in ("doc_id", "start", "n_tokens", "ids_crc32")]
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{QUERY_DIR}/documents.parquet").collect())
    expected, start = [], 0
    for (d, _), ids in zip(docs, plain_ids(grammar.TOKENIZER, [x for _, x in docs])):
        own = np.array(ids + [grammar.END_ID], "<u4")
        expected.append((d, start, len(own), zlib.crc32(own.tobytes()), int(own[(start + start + len(own)) // 2 - start])))
        start += len(own)
    assert sorted(tuple(r) for r in df.collect()) == expected


def test_grammar_rules_come_in_order_and_shrink():
    rng = random.Random(1)
    phrases = [[rng.randrange(5000) for _ in range(6)] for _ in range(30)]
    ids = [x for _ in range(2000) for x in rng.choice(phrases)]
    terminals, left, right, seq = grammar.compress(np.array(ids, np.uint32))
    n = np.arange(len(left)) + terminals
    assert (left < n).all() and (right < n).all()
    assert len(seq) < len(ids) / 4
    assert sum(1 if x < terminals else grammar.expansions(terminals, left, right)[x - terminals] for x in seq.tolist()) == len(ids)


def test_token_files(spark):
    rng = random.Random(4)
    texts = [prose(rng, rng.randrange(0, 300)) for _ in range(120)] + [None, "", prose(rng, 5000)]
    ids = rng.sample(range(-100, 10_000), len(texts))
    path = new_path(spark, "test-tokens")
    grammar.write_tokens(documents(spark, list(zip(ids, texts))), path, shard_tokens=2000)
    files = spark.read.parquet(path)
    assert files.count() > 8
    start = 0
    encoded = dict(zip(ids, plain_ids(grammar.TOKENIZER, texts)))
    rows = {r.doc_id: r for r in grammar.read_tokens(spark, path).collect()}
    for d in sorted(ids):
        own = encoded[d] + [grammar.END_ID]
        assert (rows[d].start, rows[d].n_tokens) == (start, len(own))
        assert zlib.crc32(rows[d].ids) == zlib.crc32(np.array(own, "<u4").tobytes())
        start += len(own)


def test_token_files_odd_rows(spark):
    docs, path = odd_documents(spark), new_path(spark, "test-tokens")
    grammar.write_tokens(docs, path)
    rows = grammar.read_tokens(spark, path).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in docs.collect())
    spans = sorted((r.start, r.n_tokens) for r in rows)
    assert all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:])) and spans[0][0] == 0
    assert [r.doc_id for r in sorted(rows, key=lambda r: r.start)][:2] == [None, None]
    empty = new_path(spark, "test-tokens")
    grammar.write_tokens(docs.limit(0), empty)
    assert grammar.read_tokens(spark, empty).collect() == []
