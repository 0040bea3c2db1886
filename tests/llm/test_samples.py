from weeklens.llm import toxicity


def test_repeated_rows_take_no_places(spark, docs_of):
    """One labelled id holds most rows; the sample has as many ids of either class as asked for, each once."""
    rows = [(i, f"text {i}") for i in range(100)]
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(100)], "doc_id bigint, quality int, toxic int")
    first = docs_of(rows).where("crc32(cast(string(doc_id) as binary)) % 5 <> 0").orderBy(toxicity.F.xxhash64("doc_id")).first()["doc_id"]
    docs = docs_of([*rows, *[(first, f"text {first}")] * 300, *[(first, f"other {i}") for i in range(20)], (first, "x" * 70)])
    texts, y, share = toxicity.sample(docs, labels, "toxic", 20, 60)
    assert len(texts) == len(set(texts)) == 40 and y.sum() == 20
    assert all(len(t) <= 60 for t in texts)
    held = {r["doc_id"] for r in docs_of(rows).where("crc32(cast(string(doc_id) as binary)) % 5 = 0").collect()}
    n = [0, 0]
    for r in docs.collect():
        if r["doc_id"] not in held:
            n[r["doc_id"] % 2] += 1
    assert share == (n[1] + 1) / (sum(n) + 2)
    assert (texts, share) == (toxicity.sample(docs.repartition(7), labels, "toxic", 20, 60)[0], share)
