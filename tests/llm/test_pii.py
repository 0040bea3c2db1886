import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from weeklens.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, text):
    digits = [int(c) for c in text if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "phone":
        return 9 <= len(digits) <= 15
    if kind == "card":
        doubled = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return True


def plain_base(text):
    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if passes(k, m.group())]


def test_base_spans_equal_the_patterns():
    rng = random.Random(5)
    pieces = ["a", "b.c", "@", "x@y.z", "@@", ".", "..", "-", "1", "12", "255", "256", "007", " ", "+", "(", ")", "é", "4111111111111111", "\n", "%"]
    for _ in range(20_000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(1, 14)))
        assert [(pii.KINDS[k], s, e) for k, s, e in pii.base_spans(text)] == plain_base(text), text


def test_long_runs_take_linear_time():
    for text in ("a" * 400_000, "1" * 400_000, "1." * 200_000, "a@" * 200_000, "+1" * 200_000, "a.b@c" * 80_000):
        pii.base_spans(text)
        list(pii._others(text, []))


def luhn_number(rng):
    head = "".join(rng.choice("0123456789") for _ in range(15))
    return next(head + c for c in "0123456789" if passes("card", head + c))


@pytest.fixture(scope="module")
def planted():
    """Cards behind one cue and telephone numbers behind another, in every format; numbers of other kinds elsewhere."""
    rng = random.Random(6)
    filler = lambda: " ".join(rng.choice("the cat sat at mat and then it went at house of old man".split()) for _ in range(rng.randint(3, 12)))
    rows = []
    for i in range(30):
        rows.append(f"{filler()} card number: {luhn_number(rng)} {filler()}")
        rows.append(f"{filler()} call me at +1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}. {filler()}")
        rows.append(f"{filler()} order {rng.randint(10**7, 10**8)} of 12345678 cats {filler()}")
    hidden = [
        ("x card number: 9999 8888 7777 6661 y", "card", 15, 34), ("x call me at 0171 555 0123, y", "phone", 13, 26),
        ("Call me at 0171 555 0199", "phone", 11, 24),
    ]
    clean = ["it went at 12345678 there", "order 98765432 of cats", "the number: none", "call me at noon", "version 20230405 of 7"]
    return rows, hidden, clean


def frame(spark, texts):
    rows = [(i, t, "x", "k", 1, 2, "p", "b") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, kind string, identifier string, row int, n int, patterns string, base string")


def test_patterns_discover_and_leave_others(spark, planted):
    rows, hidden, clean = planted
    texts = rows + [h[0] for h in hidden] + clean
    got = {r["doc_id"]: r for r in pii.found(frame(spark, texts).repartition(4)).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        assert Counter(tuple(x) for x in got[i]["base"]) == Counter(plain_base(text)), text
    for i, (text, kind, start, end) in enumerate(hidden, len(rows)):
        assert [tuple(x) for x in got[i]["added"]] == [(kind, start, end)], text
    assert not any(got[i]["added"] for i in [*range(len(rows)), *range(len(texts) - len(clean), len(texts))])
    assert texts[len(rows)][15:34] == "9999 8888 7777 6661"


def plain_places(texts):
    """How often each word, and each pair of words, stands before another word."""
    out = Counter()
    for text in texts:
        words = [pii._normal(w) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
        out.update("1 " + w for w in words[:-1])
        out.update(f"2 {a} {b}" for a, b in zip(words, words[1:-1]))
    return out


def test_graph_scores_equal_plain_rounds(spark, planted):
    texts = planted[0] + [h[0] for h in planted[1]] + planted[2]
    docs = frame(spark, texts)
    rows = pii.extracted(docs)
    edges, patterns = pii.pattern_graph(rows, docs)
    counts = plain_places(texts)
    assert patterns.count() > 0
    for r in patterns.collect():
        assert r["places"] == counts[r["pattern"]]
    seeds = rows.select(F.explode("base").alias("x")).select("x.identifier", "x.kind").distinct()
    known, trusted = pii.scored(edges, patterns, seeds)
    # The same rounds in plain loops.
    links = [(r["pattern"], r["identifier"], r["n"], r["kinds"].split()) for r in edges.collect()]
    start = {(r["identifier"], r["kind"]): 1.0 for r in seeds.collect()}
    score, mark = dict(start), None
    while True:
        weight, support = Counter(), Counter()
        for p, i, n, kinds in links:
            for k in kinds:
                if (i, k) in score:
                    weight[p, k] += n * score[i, k]
                    support[p, k] += 1
        trust = {pk: min(1.0, w / counts[pk[0]]) for pk, w in weight.items()}
        trust = {pk: t for pk, t in trust.items() if t >= pii.TRUST and support[pk] >= pii.SUPPORT}
        score = dict(start)
        for p, i, n, kinds in links:
            for k in kinds:
                if (p, k) in trust:
                    score[i, k] = max(score.get((i, k), 0), trust[p, k])
        if mark == (len(trust), len(score)):
            break
        mark = (len(trust), len(score))
    assert {(r["pattern"], r["kind"]): round(r["trust"], 9) for r in trusted.collect()} == {k: round(v, 9) for k, v in trust.items()}
    assert {(r["identifier"], r["kind"]): round(r["score"], 9) for r in known.collect()} == {k: round(v, 9) for k, v in score.items()}


def test_odd_rows(spark, odd_docs, no_docs):
    rows = pii.digest(pii.found(odd_docs)).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(r["doc_id"]) for r in odd_docs.collect())
    assert pii.found(no_docs).count() == 0
    twice = pii.found(frame(spark, ["mail a.b@c.de now"] * 3 + ["", None, "only A.B@C.DE"])).collect()
    assert sorted(len(r["base"]) for r in twice) == [0, 0, 1, 1, 1, 1]


def test_digest_lists_by_kind_and_start(spark):
    text = "é 4111111111111111 or a@b.co, 1.2.3.4 and z@y.xw"
    row = pii.digest(pii.found(frame(spark, [text]))).first()
    assert row["spans"] == "email:22:28,email:42:48,ip:30:37,card:2:18" and row["n_email"] == 2 and row["n_added"] == 0
    import hashlib

    assert row["base_sha256"] == hashlib.sha256(row["spans"].encode()).hexdigest()
