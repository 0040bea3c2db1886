import random
from itertools import permutations

import pytest

from weeklens.llm import filter_audit


def plain_masks(rows):
    """(id, part, mask) of (id, text, lang): every text against every other."""
    out = []
    for ident, text, lang in rows:
        t = text or ""
        words = t.encode().split()
        fails = (
            len(words) < 100, 100 * len(set(words)) < 80 * len(words), 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t),
            any(c in "#$%&*|" for c in t),
            any((o or "") == t and i is not None and (ident is None or i < ident) for i, o, _ in rows),
        )
        out.append((ident, lang or "", sum(1 << i for i, f in enumerate(fails) if f)))
    return sorted(out, key=str)


def plain_audit(flags, labels):
    good, toxic = ({i for i, *x in labels if x[k] == 1} for k in (0, 1))
    out, shapley = [], {}
    for part in {p for _, p, _ in flags}:
        for order in permutations("ABCDE"):
            there = [(i, m) for i, p, m in flags if p == part]
            every = there
            for step, letter in enumerate(order, 1):
                bit = 1 << "ABCDE".index(letter)
                gone = [(i, m) for i, m in there if m & bit]
                failing = [m for _, m in every if m & bit]
                there = [(i, m) for i, m in there if not m & bit]
                shapley[part, letter] = shapley.get((part, letter), 0) + len(gone)
                out.append((
                    part, "".join(order), step, len(there), len(gone), len(failing) - len(gone), sum(m == bit for m in failing),
                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone),
                ))
    return sorted(r + (shapley[r[0], r[1][r[2] - 1]],) for r in out)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    long = " ".join(f"w{i}" for i in range(20_000))
    texts = ["", None, " \n", "A", "AB", "Abc # d", long, long + " x", long + " y", "é" * 400, "é" * 399 + "e", "\x00", "x\x0by"]
    texts += [" ".join(f"t{rng.randrange(40)}" for _ in range(rng.choice((5, 99, 100, 130)))) for _ in range(10)]
    texts += [" ".join(f"u{rng.randrange(5000)}" for _ in range(120)) for _ in range(6)]
    texts += [t.upper() for t in texts[-4:]]
    out = [(i, t, rng.choice(("en", "de", "", None))) for i, t in enumerate(texts)]
    out += [(100 + i, rng.choice(texts), "en") for i in range(80)]
    out += [(None, "AB", "en"), (None, "only here", None), (7, texts[7], "en"), (7, texts[7], "en"), (-1, long, "fr")]
    rng.shuffle(out)
    return out


def frame(spark, rows):
    more = [(*r, "s", 5, 1, "x", "y") for r in rows]
    return spark.createDataFrame(more, "doc_id bigint, text string, lang string, source string, mask int, least int, prefix string, part string")


def test_flags_equal_all_pairs(spark, rows):
    got = filter_audit.flagged(frame(spark, rows).repartition(5))
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_masks(rows)


def test_small_tries_and_overfull_prefixes(spark, rows, monkeypatch):
    """Tries that are handed on after a few texts, and prefixes that are doubled down to whole texts."""
    monkeypatch.setattr(filter_audit, "PREFIX_BYTES", 200)
    monkeypatch.setattr(filter_audit, "LOCAL_BYTES", 3000)
    monkeypatch.setattr(filter_audit, "RANGE_BYTES", 4000)
    got = filter_audit.flagged(frame(spark, rows))
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_masks(rows)


def test_audit_equals_loops(spark, rows):
    labels = [(i, i % 2, i % 3) for i in range(0, 180, 2)] + [(3, None, 1), (3, 1, None), (None, 1, 1), (999, 1, 1)]
    told = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    got = filter_audit.audit(frame(spark, rows), told)
    # Labels name ids; a null id has none.
    assert sorted(tuple(r) for r in got.collect()) == plain_audit(plain_masks(rows), [r for r in labels if r[0] is not None])
    assert filter_audit.audit(frame(spark, rows).limit(0), told).count() == 0
    assert filter_audit.audit(frame(spark, rows), told.limit(0)).agg({"good_lost": "sum"}).first()[0] == 0


def test_string_ids(spark):
    docs = spark.createDataFrame([("b", "x", "en"), ("a", "x", "en"), (None, "x", "en"), ("c", "y", "en")], "doc_id string, text string, lang string")
    assert sorted((r["doc_id"] or "", r["mask"] >> 4) for r in filter_audit.flagged(docs).collect()) == [("", 1), ("a", 0), ("b", 1), ("c", 0)]


def test_trie_splits_edges():
    trie, rng = filter_audit.Trie(), random.Random(1)
    want = {}
    for i in range(3000):
        text = bytes(rng.choice(b"ab") for _ in range(rng.randrange(12)))
        ident = rng.choice((None, rng.randrange(100)))
        trie.insert(text, [ident])
        want[text] = min((x for x in (want.get(text), ident) if x is not None), default=None)
    assert {t: v[0] for t, v in trie.terminals()} == want
