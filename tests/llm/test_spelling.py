import random
import re
import zlib
from collections import Counter

from weeklens.llm import spelling


def plain_variants(rows):
    """word: (form, root, n, n_near, form_n), every word against every other."""
    counts = Counter()
    for ident, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if ident is None else ident}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    out = {}
    for w, n in words.items():
        close = [v for v in words if near(w, v)]
        best = min(close, key=lambda v: (-words[v], v), default=None)
        form = best if best is not None and words[best] >= 2 * n else None
        out[w] = (form, n, len(close), words[form] if form else None)
    result = {}
    for w, (form, n, n_near, form_n) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        result[w] = (form, root, n, n_near, form_n)
    return result


def got(frame):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in frame.collect()}


def corpus(seed, words=60, letters="abé"):
    """Words over few letters, so that most have near ones, with counts that make chains of forms."""
    rng = random.Random(seed)
    stems = ["".join(rng.choice(letters) for _ in range(rng.randint(4, 8))) for _ in range(words)]
    texts = []
    for i in range(40):
        texts.append(" ".join(rng.choice(stems[: rng.randint(1, words)]) for _ in range(rng.randint(0, 60))))
    return list(enumerate(texts))


def test_variants_equal_all_pairs(spark, docs_of):
    for seed in (1, 2):
        rows = corpus(seed) + [(90, "abcde, ABCDE abcde; abcdf abcdf abcdf xabcdex"), (91, "straße STRASSE Straße strasse straße strasse strasse ÀÉÎÕÜ Àéîõü"), (None, "aaaaa aaaaaa aaaaa aaaaaa aaaaa aaaaaa")]
        assert got(spelling.variants(docs_of(rows))) == plain_variants(rows)


def test_odd_rows(odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert got(spelling.variants(odd_docs)) == plain_variants(rows)
    assert spelling.variants(no_docs).count() == 0


def test_very_long_words(spark, docs_of):
    long = "ab" * 3000
    rows = [(i, f"{long} {long[1:]} {long[:3000]}x{long[3001:]} {'z' * 4000} {'z' * 3999}") for i in range(4)]
    found = got(spelling.variants(docs_of(rows)))
    assert found["z" * 4000][3] == 1 and found[long][3] == 2 and found[long[1:]][3] == 1


def test_acceptor_is_minimal_and_composition_complete():
    rng = random.Random(3)
    for _ in range(30):
        long = sorted({"".join(rng.choice("ab") for _ in range(6)) for _ in range(rng.randint(1, 40))})
        short = sorted({"".join(rng.choice("ab") for _ in range(5)) for _ in range(rng.randint(0, 25))})
        root, states, stack = spelling.acceptor(long, {}), set(), []
        stack.append(root)
        while stack:
            state = stack.pop()
            if id(state) not in states:
                states.add(id(state))
                stack.extend(state.arcs.values())
        languages = {tuple(sorted(w[i:] for w in long if w.startswith(p))) for i in range(7) for p in {w[:i] for w in long}}
        assert len(states) == len(languages)
        want = {(a, b) for a in long for b in long if a > b and sum(x != y for x, y in zip(a, b)) == 1}
        want |= {(a, b) for a in long for b in short if any(a[:i] + a[i + 1 :] == b for i in range(6))}
        pairs = list(spelling.composed(long, short))
        assert len(pairs) == len(set(pairs))
        assert {(max(p), min(p)) if len(p[0]) == len(p[1]) else p for p in pairs} == want
