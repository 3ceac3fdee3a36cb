import os
import re
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(__file__))
from edge_cases import edge_docs, empty_docs

from ledgerline.llm import ngram_join, queries, shingles

WORD = re.compile(r"[a-z0-9\u0080-\U0010ffff]+")


def grams(text):
    words = WORD.findall((text or "").lower())
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_force(rows):
    """(doc_id, text) -> {doc_id: (class_id, n_links)} by comparing all pairs."""
    sets = [(i, grams(t)) for i, t in rows]
    root, links = {i: i for i, _ in rows}, {i: 0 for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if a and b and 5 * len(a & b) >= 4 * len(a | b):
                links[i] += 1
                links[j] += 1
                p, q = find(i), find(j)
                root[max(p, q)] = min(p, q)
    return {i: (find(i), links[i]) for i, _ in rows}


def joined(df):
    return {r.doc_id: (r.class_id, r.n_links) for r in df.collect()}


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = joined(queries.op7_ngram_join(spark, sf))
    assert got == brute_force(docs)
    assert sum(c != i for i, (c, _) in got.items()) > 20


def family(n, seed=3):
    """Near copies of one text, of several similarities, and some others."""
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(500)]
    base = rng.choice(vocabulary, 120).tolist()
    rows = []
    for i in range(n):
        words = list(base)
        for at in rng.integers(0, 120, rng.integers(0, 5)):
            words[at] = rng.choice(vocabulary)
        rows.append((i, " ".join(words)))
    rows += [(n + i, " ".join(rng.choice(vocabulary, 120))) for i in range(20)]
    return rows


@pytest.mark.parametrize("whole, block", [(512, 256), (20, 10)])
def test_all_links_of_a_large_family(spark, monkeypatch, whole, block):
    monkeypatch.setattr(ngram_join, "WHOLE", whole)
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rows = family(90)
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    assert joined(ngram_join.join(docs)) == brute_force(rows)


def test_bands_meet_the_recall():
    bands = shingles.band_shape(0.8, 0.9999, ngram_join.ROWS)
    assert 1 - (1 - 0.8**ngram_join.ROWS) ** bands >= 0.9999
    assert 1 - (1 - 0.8**ngram_join.ROWS) ** (bands - 1) < 0.9999


def test_components_of_a_long_path(spark):
    edges = spark.range(1, 60).selectExpr("id AS a", "id - 1 AS b")
    edges = edges.union(spark.range(1001, 1050).selectExpr("id AS a", "1000L AS b"))
    got = {r.node: r.root for r in ngram_join.components(edges).collect()}
    assert got == {**{i: 0 for i in range(60)}, **{i: 1000 for i in range(1000, 1050)}}


def test_edge_rows_and_empty_table(spark):
    docs = edge_docs(spark).where("doc_id <> 12 OR doc_id IS NULL")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = ngram_join.join(docs).collect()
    assert {r.doc_id: (r.class_id, r.n_links) for r in got if r.doc_id is not None} == \
        brute_force([r for r in rows if r[0] is not None])
    assert [(r.class_id, r.n_links) for r in got if r.doc_id is None] == [(None, 0)] * 2
    kept = ngram_join.keep(docs)
    assert kept.columns == docs.columns
    assert sum(r.doc_id is None for r in kept.collect()) == 2
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id) == sorted(
        i for i, (c, _) in brute_force([r for r in rows if r[0] is not None]).items() if i == c)
    repeated = ngram_join.join(edge_docs(spark).where("doc_id = 12")).collect()
    assert [(r.class_id, r.n_links) for r in repeated] == [(12, 1)] * 2
    assert ngram_join.join(empty_docs(spark)).collect() == []
    assert ngram_join.keep(empty_docs(spark)).collect() == []


BASE = " ".join(f"w{i}" for i in range(100))


def test_repeated_and_missing_ids_lose_no_link_and_no_clean_row(spark):
    """Every row counts by its own text: B shares an id with a near copy of A."""
    near = [BASE.replace("w50 ", f"x{k} ") for k in range(3)]
    clean = " ".join(f"b{i}" for i in range(80))
    rows = [(1, BASE, "A"), (2, near[0], "A'"), (2, clean, "B"), (3, clean + " and more words here "
            + " ".join(f"c{i}" for i in range(80)), "C"), (3, near[1], "A''"), (None, near[2], "A3"),
            (None, clean.replace("b9 ", "q "), "B'"), (None, "only one of its kind, no id", "D")]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, name STRING")
    named = sorted((r.doc_id, r.class_id, r.n_links) for r in ngram_join.join(docs).collect()
                   if r.doc_id is not None)
    assert named == [(1, 1, 3), (2, 1, 3), (2, 2, 1), (3, 1, 3), (3, 3, 0)]
    lost = sorted((r.class_id or 0, r.n_links) for r in ngram_join.join(docs).collect()
                  if r.doc_id is None)
    assert lost == [(0, 0), (1, 3), (2, 1)]
    assert sorted(r.name for r in ngram_join.keep(docs).collect()) == ["A", "B", "C", "D"]


def test_ids_of_any_type(spark):
    docs = spark.createDataFrame([("b", BASE), ("a", BASE + " w"), ("c", "x")],
                                 "doc_id STRING, text STRING")
    assert joined(ngram_join.join(docs)) == {"a": ("a", 1), "b": ("a", 1), "c": ("c", 0)}


def test_blocks_by_size_of_the_texts(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "GRAMS", 400)
    rows = family(40)
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    assert joined(ngram_join.join(docs)) == brute_force(rows)


def test_long_texts_in_pieces_give_the_same_sets(monkeypatch):
    texts = ["one two, three é four five six " * 30, "", "a b", "x" * 900, "日本 語 " * 100]
    whole = [g.tolist() for g in shingles.gram_sets(texts, 5)]
    monkeypatch.setattr(shingles, "PIECE", 40)
    assert [g.tolist() for g in shingles.gram_sets(texts, 5)] == whole


def test_word_hashes_are_words():
    hashes, counts = shingles.word_hashes(["Aa bb, aa", "", "bb-AA ½é", "?"])
    assert counts.tolist() == [3, 0, 3, 0]
    assert hashes[0] == hashes[2] == hashes[4] and hashes[1] == hashes[3]
    assert len(set(hashes.tolist())) == 3


def test_slices_of_hashes_count_like_the_whole(monkeypatch):
    texts = [t for _, t in family(30)]
    ones = np.ones(len(texts), np.int64)
    links, root = ngram_join._verify(texts, ones, 0 * ones, False, 5, 0.8)
    assert links.sum() > 50
    for size in (1, 7, 500):
        monkeypatch.setattr(ngram_join, "SLICE", size)
        again = ngram_join._verify(texts, ones, 0 * ones, False, 5, 0.8)
        assert (again[0] == links).all() and (again[1] == root).all()


@pytest.mark.parametrize("piece", [1, 3, 1000])
def test_parts_merge_to_one_sorted_set(monkeypatch, piece):
    monkeypatch.setattr(shingles, "PIECE", piece)
    rng = np.random.default_rng(4)
    parts = [np.unique(rng.integers(0, 60, n, dtype=np.uint64)) for n in (0, 5, 40, 80, 1)]
    want = sorted(set(np.concatenate(parts).tolist()))
    assert shingles._merged(parts).tolist() == want
