import random
import re

import pytest
import xxhash

from weeklens.llm import simhash
from weeklens.llm.components import components


def plain_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints, distance=2):
    root = {i: i for i in range(len(prints))}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= distance:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(prints))]


def test_groups_equal_all_pairs(spark):
    rng = random.Random(3)
    seeds = [rng.getrandbits(64) for _ in range(25)]
    prints = []
    for s in seeds:
        prints.append(s)
        for _ in range(12):
            prints.append(rng.choice(prints[-6:]) ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fp bigint")
    got = {r["fp"]: r["group"] for r in simhash.group_fingerprints(frame).collect()}
    want = plain_groups(prints)
    pairs = {(got[a] == got[b], want[i] == want[j]) for i, a in enumerate(signed) for j, b in enumerate(signed)}
    assert pairs <= {(True, True), (False, False)}


def dense(seed=4, bits=10):
    """A large group whose fingerprints differ in a few places only, so its halves are shared by very many, and strays."""
    rng = random.Random(seed)
    base, places = rng.getrandbits(64), rng.sample(range(64), bits)
    group = {base ^ sum(1 << b for b in rng.sample(places, rng.randint(0, bits))) for _ in range(150)}
    return sorted(group) + [rng.getrandbits(64) for _ in range(20)]


@pytest.mark.parametrize("distance, hot", [(1, 4), (2, 64), (2, 3), (3, 64), (3, 5), (4, 64), (4, 2)])
def test_hot_segments_and_other_distances_equal_all_pairs(spark, distance, hot):
    prints = dense(seed=distance, bits=11)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fp bigint")
    found = [(r["a"] & (2**64 - 1), r["b"] & (2**64 - 1)) for r in simhash.links(frame, distance, hot).collect()]
    assert all(0 < (a ^ b).bit_count() <= distance for a, b in found)
    root = {r["node"]: r["root"] for r in components(spark.createDataFrame([(a - (1 << 64) if a >> 63 else a, b - (1 << 64) if b >> 63 else b) for a, b in found], "a bigint, b bigint")).collect()} if found else {}
    got, want = [root.get(p, p) for p in signed], plain_groups(prints, distance)
    assert {(got[i] == got[j], want[i] == want[j]) for i in range(len(prints)) for j in range(i)} <= {(True, True), (False, False)}


def test_balls_list_each_value_once(spark):
    row = spark.range(1).select(simhash.segment_balls(simhash.F.lit(5).cast("bigint")).alias("x")).first()["x"]
    assert len(row) == len(set(row)) == 65 and all(((v ^ 5) & (2**64 - 1)).bit_count() <= 1 for v in row)


def test_rows_and_odd_cases(odd_docs, no_docs):
    rows = odd_docs.select("doc_id", "text").collect()
    got = simhash.near_duplicates(odd_docs).collect()
    prints = [plain_print(r["text"]) for r in rows]
    groups = plain_groups(prints)
    least = {}
    for r, g in zip(rows, groups):
        if r["doc_id"] is not None:
            least[g] = min(least.get(g, r["doc_id"]), r["doc_id"])
    want = sorted(((r["doc_id"], f"{p:016x}", least.get(g)) for r, p, g in zip(rows, prints, groups)), key=str)
    assert sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got), key=str) == want
    assert simhash.near_duplicates(no_docs).count() == 0


def test_one_row_of_each_group_stays(odd_docs, no_docs):
    kept = simhash.drop_near_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = sorted(r["doc_id"] for r in kept.collect())
    named = {r["component_id"] for r in simhash.near_duplicates(odd_docs).collect()}
    assert ids == sorted(named)
    assert simhash.drop_near_duplicates(no_docs).count() == 0


def test_components_of_a_long_path_and_a_hub(spark):
    path = [(i, i + 1) for i in range(200)]
    hub = [(1000, 1000 + i) for i in range(1, 300)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(path + hub + [(7, 7)], "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(1, 201)}, **{1000 + i: 1000 for i in range(1, 300)}}
