import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from weeklens.config import work_path
from tests.llm.conftest import EXTRA
from weeklens.llm import queries, warc

SF = "/root/testdata/sf0.001"


def plain_records(pages):
    payloads = [(i, (h or "").encode()) for i, _, h in pages]
    owner = {}
    for i, p in payloads:
        if len(p) >= 1000 and i is not None:
            owner[p] = max(owner.get(p, i), i)
    out = []
    for i, p in payloads:
        again = p in owner and i != owner[p]
        out.append((i, len(p), hashlib.sha1(p).hexdigest(), "revisit" if again else "response", owner[p] if again else None))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def pages():
    big, other = "<p>é</p>" * 200, "x" * 1000
    return [
        (1, "http://www.a.example.com/x?y=1#z", big), (2, "https://a.example.com:443/x?y=1", big), (3, None, big), (3, None, big),
        (4, "http://b.example.com/", None), (5, "", ""), (6, "no url at all", "x" * 999), (7, "http://[bad", "x" * 999),
        (8, "http://a.example.com:8080/x y\n", other), (None, "http://a.example.com/", other), (None, None, None),
        (9, "http://a.example.com/", "\r\n\r\nWARC/1.1\r\n"), (-5, "http://ex.org/é", other), (10, "http://ex.org", other * 400),
    ]


def test_round_trip(spark, pages):
    frame = spark.createDataFrame(pages, "page_id bigint, url string, html string").withColumn("surt", F.lit(1)).withColumn("file", F.lit("f"))
    got = [tuple(r) for r in warc.round_trip(frame).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()]
    assert sorted(got, key=str) == plain_records(pages)
    assert warc.round_trip(frame.limit(0)).count() == 0


def test_index_finds_every_capture_over_blocks_and_files(spark):
    frame = spark.range(3000).selectExpr("id as page_id", "concat('http://h', id % 7, '.example.com/p', id % 40) as url", "repeat('y', 20) as html")
    folder = work_path(spark, "warc-test")
    places = warc.write_archives(frame, folder)
    index = warc.write_index(places, folder, lines_a_block=16, file_bytes=4000)
    files = sorted((r["first_key"], r["file"], r["size"]) for r in index.collect())
    found = warc.Index(folder, files)
    keys = [r["key"] for r in places.select(warc.key_of().alias("key")).collect()]
    assert index.agg(F.sum("lines")).first()[0] == 3000 and len(files) > 1
    assert all(len(list(found.find(k))) == 1 for k in sorted(keys)[::37])
    assert not list(found.find("com,example,zz)/ 1")) and not list(found.find("")) and not list(found.find("~"))
    page, file, offset, length = next(found.find(sorted(keys)[5]))
    assert warc.parse(warc._Reader(folder).read(file, offset, length))["page_id"] == page


def test_keys_reverse_the_host():
    assert warc.surt("http://www.A.example.com:80/x?y=1#z") == "com,example,a)/x?y=1"
    assert warc.surt("https://a.b:8443") == "b,a:8443)/" and warc.surt(None) == "" and warc.surt("no url") == "no url"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_queries_equal_sql(spark, name):
    db = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "labels"):
        db.sql(f"create view {table} as select * from '{SF}/{table}.parquet'")
    got = queries.queries()[name](spark, SF)
    columns = sorted(got.columns)
    want = sorted((tuple(r) for r in db.sql(f"select {', '.join(columns)} from ({queries.oracle_sql()[name]})").fetchall()), key=str)
    assert sorted((tuple(r) for r in got.select(*columns).collect()), key=str) == want


def test_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = corpus_pipeline.written(stage(spark, docs, SF), "stage")
        assert docs.columns == columns, name
        counts.append(docs.count())
    assert counts[0] > counts[1] > counts[2] >= counts[3] > 0
    again = corpus_pipeline.near_duplicates_dropped(spark, docs, SF)
    assert again.count() == docs.count()
    result = corpus_pipeline.run(spark, SF)
    mixed = corpus_pipeline.written(corpus_pipeline.sources_mixed(spark, docs, SF), "stage")
    assert mixed.columns == columns
    assert sorted(r["doc_id"] for r in result.collect()) == sorted(r["doc_id"] for r in mixed.collect())


def test_stages_take_odd_rows(spark, odd_docs, no_docs):
    for rows in (odd_docs, no_docs):
        docs = rows
        for name, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.written(stage(spark, docs, SF), "stage")
            if name != "sharding":
                assert docs.columns == rows.columns
                assert {tuple(r)[5:] for r in docs.collect()} <= {EXTRA}
