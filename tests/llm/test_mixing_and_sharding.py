import zlib
from collections import Counter, defaultdict

from tests.llm.conftest import PLAIN
from weeklens.llm import mixing, sharding


def water_fill(sizes, cap=3):
    """Targets by repeated sharing of the excess."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = [s for s in names if s not in full]
        left = total - sum(cap * sizes[s] for s in full)
        share = {s: left * weight[s] / sum(weight[r] for r in rest) for s in rest}
        over = {s for s in rest if share[s] > cap * sizes[s]}
        if not over:
            return share | {s: cap * sizes[s] for s in full}
        full |= over


def test_targets_and_words_taken(docs_of):
    texts = [(i, "w " * (i % 37 + 1), f"s{i % 7 if i % 11 else 9}") for i in range(400)] + [(1000, "a b c", None)]
    docs = docs_of(texts)
    mix = mixing.mix(docs, least_block=16)
    rows = mix.rows.collect()
    sizes = defaultdict(int)
    for _, text, source in texts:
        sizes[source] += len(text.split())
    want = water_fill(sizes)
    taken = defaultdict(int)
    for r in rows:
        assert abs(r["target"] - want[r["source"]]) < 1e-6 and r["source_size"] == sizes[r["source"]]
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= 1 for s in want)
    assert len(rows) == len(texts)
    again = {(r["doc_id"], r["taken"]) for r in mixing.mix(docs, least_block=16).rows.collect()}
    assert again == {(r["doc_id"], r["taken"]) for r in rows}


def test_schedule_spreads_sources_evenly(docs_of):
    docs = docs_of([(i, "w " * 100, f"s{i % 3}") for i in range(300)])
    mix = mixing.mix(docs, least_block=64)
    order = [r["ord"] for r in mix.schedule.orderBy("at").collect()]
    for upto in (50, 100, len(order) // 2):
        counts = Counter(order[:upto])
        assert all(abs(counts[k] - upto * (k + 1) / 6) < 6 for k in range(3))


def test_mix_odd_cases(odd_docs, no_docs):
    rows = mixing.mix(odd_docs).rows.collect()
    assert len(rows) == odd_docs.count() and all(r["taken"] == 0 for r in rows if not r["size"])
    mixed = mixing.mixed_documents(odd_docs)
    assert mixed.columns == odd_docs.columns
    assert mixed.count() == sum(r["copies"] for r in rows)
    assert mixing.mix(no_docs).rows.count() == 0 and mixing.mixed_documents(no_docs).count() == 0


def test_shards_have_equal_bytes_and_gapless_slots(docs_of):
    texts = [(i, f"text {i % 1500} " * (i % 50 + 1), f"s{i % 5}") for i in range(3000)]
    rows = sharding.sharded(docs_of(texts)).collect()
    assert {(r["doc_id"], r["size"], r["text_crc32"]) for r in rows} == {
        (i, len(t.encode()) + 8, zlib.crc32(t.encode())) for i, t, _ in texts
    }
    bytes_, slots, homes = Counter(), defaultdict(list), defaultdict(set)
    text_of = {i: t for i, t, _ in texts}
    for r in rows:
        bytes_[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        homes[text_of[r["doc_id"]]].add(r["shard"])
    assert sorted(bytes_) == list(range(24))
    assert max(bytes_.values()) < 1.1 * sum(bytes_.values()) / 24
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(h) == 1 for h in homes.values())


def test_tree_equals_sorting_each_node(docs_of, spark):
    rows = sharding.points(docs_of([(i, f"t{i} " * (i * 7 % 40 + 1), f"s{i % 4}") for i in range(500)]))
    root = sharding.grow(rows, 5)
    plain = [r.asDict() for r in rows.collect()]

    def check(node, inside):
        if node.left is None:
            return
        spread = {d: max(r[d] >> 43 for r in inside) - min(r[d] >> 43 for r in inside) for d in sharding.DIMENSIONS}
        assert spread[node.dimension] == max(spread.values())
        goal, running = sum(r["size"] for r in inside) * node.left.leaves / node.leaves, 0
        for r in sorted(inside, key=lambda r: r[node.dimension]):
            running += r["size"]
            if running >= goal:
                break
        assert r[node.dimension] == node.key
        left = [r for r in inside if r[node.dimension] < node.key or r[node.dimension] == node.key and r["spread"] <= node.part]
        check(node.left, left)
        check(node.right, [r for r in inside if r not in left])

    check(root, plain)


def test_a_text_that_outweighs_a_shard_is_parted(docs_of):
    rows = sharding.sharded(docs_of([(i, "same text", "s") for i in range(2000)] + [(9000 + i, f"own {i} text", "t") for i in range(400)]), shards=4).collect()
    bytes_ = Counter()
    for r in rows:
        bytes_[r["shard"]] += r["size"]
    assert len(bytes_) == 4 and max(bytes_.values()) < 1.2 * sum(bytes_.values()) / 4


def test_shards_odd_cases(odd_docs, no_docs):
    rows = sharding.sharded(odd_docs).collect()
    assert len(rows) == odd_docs.count() and {r["law"] for r in rows} == {"bytes"}
    assert all(r["size"] == 8 and r["text_crc32"] == 0 for r in rows if r["doc_id"] in (1, 2))
    assert sharding.sharded(no_docs).count() == 0
    assert sharding.sharded(odd_docs, target_bytes=10**9).select("shard").distinct().count() == 1


def test_repeated_rows_are_parted_like_others(spark, docs_of):
    """2,000 rows that repeat one another weigh more than a shard; their copies go to several."""
    text = PLAIN[:30]
    rows = [(1, text)] * 2000 + [(i, f"other text number {i} {'x' * (i % 40)}") for i in range(2, 402)]
    got = sharding.sharded(docs_of(rows).repartition(6), 4).collect()
    assert len(got) == 2400
    loads = [sum(r["size"] for r in got if r["shard"] == s) for s in range(4)]
    assert max(loads) <= 1.1 * sum(loads) / 4 and min(loads) >= 0.9 * sum(loads) / 4
    for s in range(4):
        slots = sorted(r["slot"] for r in got if r["shard"] == s)
        assert slots == list(range(len(slots)))


def test_shards_need_no_python(docs_of):
    plan = sharding.sharded(docs_of([(1, "a"), (2, "b")]), 2)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "RDD" not in plan.replace("LogicalRDD", "")
