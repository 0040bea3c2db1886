"""What the pipeline's stages keep, against plain loops over all documents."""

import hashlib
import re
from collections import Counter

import corpus_pipeline
from tests.llm.test_mixing_and_sharding import water_fill
from tests.llm.test_simhash_and_components import plain_groups, plain_print
from weeklens.llm import quality
from weeklens.llm.common import written

SF = "/root/testdata/sf0.001"


def contaminated(text, items):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    hit = set()
    for item in items:
        for i in range(max(1, len(item) - 12) if item else 0):
            window = item[i : i + 13]
            for at in range(len(words) - len(window) + 1):
                if words[at : at + len(window)] == window:
                    hit.update(range(at, at + len(window)))
    return bool(hit) and 20 * len(hit) >= len(words)


def mixed(rows):
    """How often each document's first word is read: whole rounds of its source, and one more before the target ends."""
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", text or "")) for i, text, _ in rows}
    sizes = Counter()
    for i, _, source in rows:
        sizes[source] += size[i]
    targets, out = water_fill(sizes), {}
    for source, total in sizes.items():
        goal, start = int(targets[source] + 0.5), 0
        own = sorted((hashlib.md5(str(i).encode()).hexdigest(), i) for i, _, s in rows if s == source)
        for _, i in own:
            if size[i]:
                out[i] = goal // total + (start < goal % total)
            start += size[i]
    return out


def test_stages_equal_plain_loops(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    stages = dict(corpus_pipeline.STAGES)
    frames, now = {}, docs
    for name in list(stages)[:4]:
        frames[name] = now = written(stages[name](spark, now, SF), "stage")
    ids = {name: Counter(r["doc_id"] for r in frame.select("doc_id").collect()) for name, frame in frames.items()}

    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.train(docs, labels)
    good = [r for r, score in zip(rows, next(quality.score_texts(model, iter([[t for _, t, _ in rows]])))) if score >= 0.3]
    assert ids["quality classifier"] == Counter(i for i, *_ in good)

    groups = plain_groups([plain_print(t) for _, t, _ in good])
    least = {}
    for (i, *_), g in zip(good, groups):
        least[g] = min(i, least.get(g, i))
    single = [r for r in good if r[0] in set(least.values())]
    assert ids["SimHash near-dedup"] == Counter(i for i, *_ in single) and len(single) < len(good)

    items = [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), r["text"] or "")) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = [r for r in single if not contaminated(r[1], items)]
    assert ids["benchmark decontamination"] == Counter(i for i, *_ in clean) and len(clean) < len(single)

    assert ids["source mix"] == Counter({i: n for i, n in mixed(clean).items() if n})
