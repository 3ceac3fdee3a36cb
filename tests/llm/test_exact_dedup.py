import hashlib
import os
import re
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
from edge_cases import edge_docs, empty_docs

from ledgerline.llm import exact_dedup, queries
from ledgerline.llm.common import identified


def brute_force(rows):
    """(doc_id, text) rows -> what ``mark`` returns of them, sorted."""
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((i, t or ""))
    out = []
    for norm, members in groups.items():
        keep = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))[0]
        sha = hashlib.sha256(norm.encode()).hexdigest()
        out += [(i, keep, len(members), i == keep, sha) for i, _ in members]
    return sorted(out, key=str)


def marked(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256)
                   for r in df.collect()), key=str)


def test_edge_rows_and_empty_table(spark):
    docs = edge_docs(spark)
    assert marked(exact_dedup.mark(docs)) == brute_force(
        [(r.doc_id, r.text) for r in docs.collect()])
    assert exact_dedup.mark(empty_docs(spark)).collect() == []
    assert exact_dedup.keep(empty_docs(spark)).collect() == []


def test_buckets_split_and_results_do_not_depend_on_them(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "concat('t ', id % 2500) AS text")
    index = exact_dedup.Index(identified(docs), capacity=20).entries.collect()
    sizes = {}
    for r in index:
        sizes[r.bucket] = sizes.get(r.bucket, 0) + 1
    assert len(index) == 2500 and max(sizes.values()) <= 20 and len(sizes) > 100
    for r in index:         # the bucket is the hash's leading bits, after a one
        depth = r.bucket.bit_length() - 1
        assert r.bucket == 1 << depth | (r.h % 2**64) >> (64 - depth)
    few, many = (marked(exact_dedup.mark(docs, capacity=c)) for c in (1, 10**6))
    assert few == many


def test_the_directory_deepens_with_the_texts(spark):
    """No depth is the last: with a capacity of one, 40,000 hashes need 16 bits and more."""
    found = spark.range(40_000).selectExpr("xxhash64(id) AS h")
    slots, depth = exact_dedup.directory(found, capacity=1)
    assert depth > 18 and slots.select("bucket").distinct().count() > 39_000


def test_a_bucket_that_no_bit_splits_stays_whole(spark):
    found = spark.createDataFrame([(i,) for i in range(50)], "h long")
    slots, depth = exact_dedup.directory(found, capacity=10)
    assert [(r.slot, r.bucket) for r in slots.collect()] == [(0, 1 << depth)]


def test_results_come_from_the_buckets(spark):
    """Without a bucket its rows find nothing; without its directory slot too."""
    docs = spark.range(900).selectExpr("id AS doc_id", "concat('t ', id % 300) AS text")
    index = exact_dedup.Index(identified(docs), capacity=20)
    bucket = index.entries.first().bucket
    lost = index.entries.where(F.col("bucket") == bucket).count()
    assert lost > 0 and index.probed().count() == 900
    entries, slots = index.entries, index.directory
    index.entries = entries.where(F.col("bucket") != bucket)
    assert index.probed().count() == 900 - 3 * lost
    index.entries, index.directory = entries, slots.where(F.col("bucket") != bucket)
    assert index.probed().count() == 900 - 3 * lost


def test_colliding_hashes_are_chained(spark, monkeypatch):
    docs = spark.range(60).selectExpr("id AS doc_id", "concat('t ', id % 20) AS text")
    want = marked(exact_dedup.mark(docs))
    keys = exact_dedup.keys
    monkeypatch.setattr(exact_dedup, "keys", lambda d: keys(d).withColumn("h", F.lit(7).cast("long")))
    index = exact_dedup.Index(identified(docs))
    assert sorted(r.chain for r in index.entries.collect()) == list(range(1, 21))
    assert marked(exact_dedup.mark(docs)) == want


def test_rows_with_equal_ids_and_texts_keep_one(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (1, "ab"), (2, "c"), (None, "d"),
                                  (None, "d ")], "doc_id BIGINT, text STRING")
    assert sorted((r.doc_id or 0, r.text) for r in exact_dedup.keep(docs).collect()) in (
        [(0, "d"), (1, "a b"), (2, "c")], [(0, "d "), (1, "a b"), (2, "c")])


def test_ids_must_be_integers(spark):
    with pytest.raises(TypeError, match="integer"):
        exact_dedup.mark(spark.createDataFrame([("a", "b")], "doc_id STRING, text STRING"))


def test_keep_leaves_one_row_of_each_text(spark):
    docs = edge_docs(spark)
    kept = exact_dedup.keep(docs)
    assert kept.columns == docs.columns
    norm = [re.sub(r"\s", "", r.text or "") for r in kept.collect()]
    want = {re.sub(r"\s", "", r.text or "") for r in docs.collect()}
    assert len(norm) == len(set(norm)) and set(norm) == want


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = sorted(map(tuple, con.execute(
        f"SELECT doc_id, keep_id, group_size, kept, text_sha256 FROM ({exact_dedup.SQL})")
        .fetchall()), key=str)
    assert marked(queries.op10_exact_dedup(spark, sf)) == want


def test_main_path_has_no_python(spark):
    plan = queries.op10_exact_dedup(spark, "/root/testdata/sf0.001")
    text = plan._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", text)
