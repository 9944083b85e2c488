"""Base spans against the plain patterns, and revealing terms by hand."""

import math
import random
import re

import pytest
from corpus_frames import documents, odd_documents, prose

from tripstats.llm import sanitise as S


def plain(text):
    """The rules as stated, each pattern over the whole text."""
    text = text or ""
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(x) for x in m.group() if x.isdigit()]
        total = sum(d[-1::-2]) + sum(sum(divmod(2 * x, 10)) for x in d[-2::-2])
        if 13 <= len(d) <= 19 and total % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(x.isdigit() for x in m.group()) <= 15:
            out.append(("phone", *m.span()))
    return out


def test_base_spans_as_plain_patterns():
    rng = random.Random(1)
    bits = ["a", "é", "@", ".", "b.c", "-", "_", "%", "+", "1", "25", "256", "0.", "12.34.5.6", " ", "(", ")", "4111 1111 1111 1111", "+1 (555) 123-4567", "x@y.zz", "日"]
    for _ in range(20_000):
        text = "".join(rng.choices(bits, k=rng.randrange(1, 16)))
        assert S.base_spans(text) == plain(text), text


def test_long_digit_runs_are_quick():
    assert S.base_spans("7" * 200_000 + " 1.2.3.4")[0][0] == "ip"
    assert S.base_spans("00000000255.1.1.1") == [("ip", 0, 17)]
    assert S.base_spans("9" * 5000 + ".1.1.1") == []


def secrets(text):
    """Runs of 20 or more letters and digits with three changes and 60 bits, as stated."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9_+=]{20,}", text or ""):
        x = m.group()
        changes, i = 0, 0
        while i < len(x) - 1:
            if x[i].isdigit() != x[i + 1].isdigit() and x[i].isalnum() and x[i + 1].isalnum():
                changes, i = changes + 1, i + 1
            i += 1
        if changes >= 3 and sum(-math.log2(x.count(c) / len(x)) for c in x) >= 60:
            out.append(("secret", *m.span()))
    return out


def test_every_document(spark):
    rng = random.Random(3)
    texts = [prose(rng, 40) + rng.choice(["", " mail me@x.org", " 10.1.2.3 é ", " +49 (30) 1234567", ' é token = "' + "%040x" % rng.getrandbits(160) + '"']) for _ in range(60)]
    rows = {r.doc_id: r for r in S.sanitise(documents(spark, texts)).collect()}
    for i, text in enumerate(texts):
        base = [tuple(s) for s in rows[i].spans if s.kind in (*S.KINDS, "secret")]
        assert base == plain(text) + secrets(text)
        if not base:
            assert rows[i].spans == [] and rows[i].sanitised_text is None
        else:
            assert f"[{base[0][0].upper()}]" in rows[i].sanitised_text


def test_words_and_numbers_are_no_secrets():
    for text in ("donaudampfschifffahrtsgesellschaft", "1" * 40, "a1" * 12, "abcdefghijklmnopqrstuvwxyz2024", "snake_case_name_of_a_function_2"):
        assert S.secret_spans(text) == secrets(text) == [], text
    assert S.secret_spans("x 9233A8ECF7C5B09FE5949719B6B82BC439E9329B y") == [("secret", 2, 42)]


def nodes_of(kind, value):
    digits = "".join(re.findall("[0-9]", value))
    if kind in ("card", "phone"):
        value = digits
    part = {"email": value.lower().split("@")[-1], "ip": ".".join(value.split(".")[:2]), "card": digits[:6], "phone": digits[:4], "secret": len(value)}[kind]
    return (0, kind, value if kind == "secret" else value.lower()), (1, kind, part), (2, kind)


def plain_shares(texts, context=10, prior=1.0):
    """{(entity, term): (share of the entity, share of its part)} by plain counting."""
    n, term_docs, node_docs, both = len(texts), {}, {}, {}
    near = set()
    for d, text in enumerate(texts):
        text = text or ""
        spans = plain(text) + secrets(text)
        words = [m for m in re.finditer(r"(?:[A-Za-z]|[^\x00-\x7f])+", text)]
        low = lambda m: re.sub("[A-Z]+", lambda x: x.group().lower(), m.group())
        for m in words:
            term_docs.setdefault(low(m), set()).add(d)
        free = [m for m in words if all(m.end() <= a or m.start() >= b for _, a, b in spans)]
        for kind, a, b in spans:
            nodes = nodes_of(kind, text[a:b])
            at = sum(m.start() < a for m in free)
            for x in nodes:
                node_docs.setdefault(x, set()).add(d)
            for m in free[max(0, at - context) : at + context]:
                for x in nodes:
                    both.setdefault((x, low(m)), set()).add(d)
                near.add((nodes, low(m)))
    out = {}
    for nodes, term in near:
        t = len(term_docs[term])
        if t < 2:
            continue
        chance, above, shares = 1.0, n, []
        for x in reversed(nodes):
            count = len(node_docs[x])
            chance = (len(both[x, term]) - 1 + prior * chance * count / above) / (t - 1 + prior)
            content = math.log(n / count)
            shares.append(1 + math.log(chance) / content if content > 0 else None)
            above = count
        out[nodes[0], term] = (shares[2], shares[1])
    return out


def company(seed, n=300):
    """Texts of which some share an address, and some the domain of a company whose name is
    near. Returns texts and planted (doc, term, kind)."""
    rng = random.Random(seed)
    texts = [f"the {'man wrote a clerk of ' * (i % 2)}{prose(rng, 40, 3000)}" for i in range(n)]
    planted = set()
    for i in range(6):
        texts[i] = f"{prose(rng, 15, 3000)} the man Zorblax wrote {prose(rng, 3, 3000)} spy@x.org, {prose(rng, 20, 3000)} zorblax"
        planted.add((i, "zorblax", "removed"))
    for i in range(6, 30):
        texts[i] = f"{prose(rng, 15, 3000)} the Müllerbank clerk {prose(rng, 2, 3000)} w{i}@muell.example mail {prose(rng, 20, 3000)}"
        planted.add((i, "müllerbank", "term"))
    for i in range(30, 90):
        texts[i] += f" the p{i}@d{i}.example mail"
    rng.shuffle(order := list(range(n)))
    place = {d: k for k, d in enumerate(order)}
    return [texts[d] for d in order], {(place[d], t, k) for d, t, k in planted}


def test_shares_as_by_hand(spark):
    texts = company(1, 120)[0] + ["alpha beta me@x.org me@x.org 10.0.1.2"] * 3 + [None, "", "a 10.0.7.7 b", 'k = "ab12cd34ef56ab78cd90ef12" a']
    found = S.find_entities(documents(spark, texts).select("doc_id", "text"))
    rows = S.revealing_terms(found, S.count_terms(documents(spark, texts))).collect()
    expected = plain_shares(texts)
    close = lambda x: None if x is None else round(x, 9)
    hashed = dict(zip(expected, zip(*[S._signed(S._hashed(x)) for x in (
        [f"0:{e[1]}:{e[2]}".encode() for e, _ in expected], [t.encode() for _, t in expected])])))
    want = {(*hashed[k], close(a), close(b)) for k, (a, b) in expected.items()}
    got = {(r.entity, close(r.of_entity), close(r.of_part)) for r in rows}
    assert got == {(e, a, b) for e, _, a, b in want} and len(rows) == len(expected) > 500


def test_planted_terms(spark):
    """The name near one address, and that near many addresses of one domain, each in one
    document, are found; other terms stay."""
    texts, planted = company(4)
    rows = {r.doc_id: r for r in S.sanitise(documents(spark, texts)).collect()}
    marked = {(i, texts[i][s.start : s.end].lower(), s.kind) for i, r in rows.items() for s in r.spans if s.kind in ("term", "removed")}
    shares = plain_shares(texts)
    assert planted <= marked  # recall 1.0
    assert len(planted) / len(marked) >= 0.9  # precision
    assert not any(t in ("the", "mail") for _, t, _ in marked)
    for i, term, kind in planted:
        text = rows[i].sanitised_text
        assert term not in text.lower() and ("[EMAIL TERM]" in text) == (kind == "term")
    for i, r in rows.items():  # the rule, on every document
        entities = {nodes_of(k, texts[i][a:b])[0] for k, a, b in plain(texts[i]) + secrets(texts[i])}
        for _, term, kind in (x for x in marked if x[0] == i):
            own = [shares[e, term] for e in entities if (e, term) in shares]
            assert (kind == "removed") == any(a >= S.REMOVE for a, _ in own)
            assert any(max(x) >= S.GENERALISE for x in own)


def test_no_row_multiplies(spark):
    """Documents of one address meet only terms of their own."""
    rng = random.Random(5)
    docs = documents(spark, [f"{prose(rng, 8, 9000)} list@x.org {prose(rng, 8, 9000)}" for _ in range(150)])
    rows = S.sanitise(docs).collect()
    assert len(rows) == 150 and all(len(r.spans) <= 17 for r in rows)


def test_query_on_the_sample(spark):
    """Columns in order; base spans as plain patterns; the method adds spans."""
    from hashlib import sha256

    from tripstats.llm import queries

    sf_dir = "/root/testdata/sf0.1"
    df = queries.op3_information_sanitiser(spark, sf_dir)
    assert df.columns[:7] == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    assert [t for _, t in df.dtypes[:7]] == ["bigint"] * 5 + ["string"] * 2
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = df.collect()
    assert len(rows) == len(texts)
    added = 0
    for r in rows:
        base = plain(texts[r.doc_id]) if "@" in texts[r.doc_id] or re.search("[0-9]", texts[r.doc_id]) else []
        spans = [f"{k}:{a}:{b}" for k, a, b in base]
        assert r.base_sha256 == sha256(",".join(spans).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for k, _, _ in base) for x in S.KINDS]
        own = r.spans.split(",") if r.spans else []
        assert own[: len(spans)] == spans and len(own) == r.n_spans
        assert [x for x in own if x.startswith("secret")] == [f"{k}:{a}:{b}" for k, a, b in secrets(texts[r.doc_id])]
        added += r.n_term + r.n_removed
    assert added > 20
    private = {d for d, x in texts.items() if plain(x) or 'token = "' in x}
    caught = {r.doc_id for r in rows if r.n_spans}
    assert len(private & caught) / len(private) > 0.99 and len(caught - private) < 0.002 * len(rows)


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = S.sanitise(docs).collect()
    assert len(rows) == docs.count()
    assert all(r.spans == [] and r.sanitised_text is None for r in rows)
    assert sum(r.doc_id is None for r in rows) == 2
    same = documents(spark, [(None, "call +1 555 123 4567 now"), (7, "call +1 555 123 4567 now"), (7, "call +1 555 123 4567 now")])
    assert {r.sanitised_text for r in S.sanitise(same).collect()} == {"call [PHONE] now"}
    assert S.sanitise(docs.limit(0)).collect() == []


@pytest.mark.parametrize("text, expected", [
    ("a me@x.org b", "a [EMAIL] b"),
    ("+4111111111111111", "+[CARD]"),
])
def test_marks(text, expected):
    assert S._sanitised(text, S.base_spans(text)) == expected
