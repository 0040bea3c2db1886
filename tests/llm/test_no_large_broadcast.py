"""Tables that grow with the input are joined by merging, however small Spark takes them to be."""

import pytest

from weeklens.llm import mixing, simhash


def broadcasts(frame):
    """The plan below each broadcast that Spark has planned for the frame."""

    def below(node):
        own = [node.toString()] if node.nodeName().startswith("BroadcastExchange") else []
        children = node.children()
        return own + [x for i in range(children.size()) for x in below(children.apply(i))]

    plan = frame._jdf.queryExecution().executedPlan()
    return below(plan.initialPlan() if plan.nodeName().startswith("AdaptiveSparkPlan") else plan)


@pytest.fixture
def planned(monkeypatch):
    """Names and broadcasts of the tables that an operator writes."""
    found, write = [], simhash.written

    def written(df, name):
        found.append((name, broadcasts(df)))
        return write(df, name)

    for module in (simhash, mixing):
        monkeypatch.setattr(module, "written", written)
    return found


@pytest.fixture
def docs(docs_of):
    return docs_of([(i, f"some words of text {i} " * (1 + i % 3), f"s{i % 2}") for i in range(40)])


@pytest.mark.parametrize("distance", [1, 2, 3])
def test_probes_and_keys_are_not_broadcast(spark, planned, distance):
    prints = spark.range(300).select(simhash.F.xxhash64("id").alias("fp"))
    last = simhash.links(prints, distance, hot=2)
    assert dict(planned).keys() >= {"distinct-prints", "hot-segments", "links"}
    assert [x for _, found in planned for x in found] + broadcasts(last) == []


def test_fingerprints_of_documents_are_not_broadcast(planned, docs):
    last = [simhash.near_duplicates(docs), simhash.drop_near_duplicates(docs)]
    assert [x for _, found in planned for x in found] + [x for df in last for x in broadcasts(df)] == []
    assert last[0].count() == docs.count() and last[1].count() <= docs.count()


def test_pieces_and_blocks_of_a_mix_are_not_broadcast(planned, docs):
    rows = mixing.mix(docs, least_block=2).rows
    found = broadcasts(rows)
    assert not any("Generate" in x or "block" in x for x in found)
    assert len(found) <= 1  # sources with their targets
