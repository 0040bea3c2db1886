import hashlib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from weeklens.llm import decontaminate, token_count

PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def plain(text):
    return re.findall(PATTERN, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_hits(docs, items):
    out = []
    for text in docs:
        words, hit, found = plain(text), set(), set()
        for item, item_text in items:
            target = plain(item_text)
            n = min(13, len(target))
            for s in range(len(target) - n + 1 if n else 0):
                for i in range(len(words) - n + 1):
                    if words[i : i + n] == target[s : s + n]:
                        hit |= set(range(i, i + n))
                        found.add("" if item is None else str(item))
        out.append((len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()))
    return out


def test_matches_equal_brute_force(spark, docs_of):
    rng = random.Random(1)
    vocabulary = ["a", "b", "c", "d'e", "é1"]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 3, 12, 13, 14, 30])))) for i in range(20)]
    items += [(3, items[3][1]), (None, "b a b a b"), (77, None), (78, ""), (79, "never seen words")]
    texts = []
    for _ in range(60):
        words = rng.choices(vocabulary + ["zz"], k=rng.randint(0, 60))
        at = rng.randint(0, len(words))
        texts.append(" ".join(words[:at] + [rng.choice(items)[1] or ""] + words[at:]))
    texts += [None, "", "--- ...", texts[0]]
    docs = docs_of(list(enumerate(texts)))
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    want = plain_hits(texts, items)
    for portion in (10**6, 60):  # one portion of test items, and several
        found = decontaminate.matches(docs, bench, max_test_chars=portion)
        assert found.count() == len(texts)
    got = {r["doc_id"]: r for r in decontaminate.judged(docs, bench).collect()}
    for i, (n, hit, named, digest) in enumerate(want):
        r = got[i]
        assert (r["_n_words"], r["_n_hit"], r["_n_items"], r["_items_sha256"]) == (n, hit, named, digest), texts[i]
        assert r["_contaminated"] == (hit > 0 and 20 * hit >= n)


def test_portions_give_the_same_spans(spark, docs_of):
    words = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(words[i : i + 20])) for i in range(0, 280, 10)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    docs = docs_of([(1, "x y " + " ".join(words[5:70]) + " z"), (2, " ".join(words[100:140]))])
    one = decontaminate.matches(docs, bench).collect()
    many = decontaminate.matches(docs, bench, max_test_chars=200).collect()
    spans = lambda rows: {r["doc_id"]: sorted(tuple(s) for s in r["_spans"]) for r in rows}
    assert spans(one) == spans(many)
    assert (7, 15, "10", 0) not in spans(one)[1] and (7, 20, "10", 0) in spans(one)[1]


def test_clean_documents_stay(spark, odd_docs, no_docs):
    bench = spark.createDataFrame([(1, "the cat sat on the mat and then it went to the house of")], "item_id bigint, text string")
    kept = decontaminate.decontaminated(odd_docs, bench)
    assert kept.columns == odd_docs.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 7, 8]
    assert decontaminate.decontaminated(no_docs, bench).count() == 0
    assert decontaminate.decontaminated(odd_docs, bench.limit(0)).count() == odd_docs.count()


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer, models, pre_tokenizers

    pieces = token_count.read_vocabulary(token_count.VOCABULARY)
    out = Tokenizer(models.Unigram(pieces, 0, True))
    out.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    return out, token_count.LineCounter(pieces)


@settings(max_examples=300, deadline=None)
@given(text=st.text(alphabet="abeinrst .,é\n▁<x0A>日😀\t", max_size=60))
def test_counts_equal_the_tokenizer(tokenizer, text):
    reference, counter = tokenizer
    assert counter.of(text) == len(reference.encode(text, add_special_tokens=False).ids)


def test_ties_go_to_the_earlier_start():
    counter = token_count.Counter([("▁", 0.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("aab", -3.0)])
    assert counter.of("ab") == 2 and counter.of("aab") == 2


def test_token_count_rows(odd_docs, no_docs):
    rows = token_count.with_token_counts(odd_docs).collect()
    assert len(rows) == odd_docs.count() and {r["n_tokens"] for r in rows if r["doc_id"] in (1, 2)} == {0}
    assert token_count.with_token_counts(no_docs).count() == 0
