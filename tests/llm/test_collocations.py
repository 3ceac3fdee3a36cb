import os
import re
import sys
import tracemalloc
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

sys.path.insert(0, os.path.dirname(__file__))
from edge_cases import DOCS_DDL, edge_docs, empty_docs

from ledgerline.llm import collocations as col
from ledgerline.llm import queries


def brute(rows, least, longest=4, top=2000):
    """All phrases counted one by one, as the definition says."""
    grams, total = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    grams.setdefault(lang, Counter())[tuple(words[i:i + k])] += 1
    out = []
    for lang, f in grams.items():
        cands = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = Counter()
        for p, a in cands.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inside[p[i:i + k]] = max(inside[p[i:i + k]], a)
        found = []
        for p, a in cands.items():
            if 100 * inside[p] >= 80 * a:
                continue
            score, k = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, total[lang], -s))
    return sorted(out)


def result(df):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.text, r.lang) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    df = queries.op11_collocations(spark, sf)
    assert result(df) == brute(rows, 30)
    assert dict(df.dtypes) == {"lang": "string", "phrase": "string", **dict.fromkeys(
        ["rank", "a", "l", "r", "n", "score"], "bigint")}


def test_small_dictionaries_and_tries_give_the_same(spark, monkeypatch):
    """Words and phrases cut into many passes: nothing is lost between them."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = result(col.collocations(docs, least=5))
    monkeypatch.setattr(col, "MAX_WORDS", 400)
    monkeypatch.setattr(col, "BUFFER", 256)
    monkeypatch.setattr(col, "NUMBERED", 50)
    assert result(col.collocations(docs, least=5, max_phrases=300)) == want
    assert want == brute([(r.text, r.lang) for r in docs.collect()], 5)


def test_overlaps_ties_and_ends_of_pieces(spark):
    rows = [("a a a a a", "en"), ("B b, b b. b\tb  b;b", "en"), ("x y\nx y\x0cx y", None),
            ("x y", "und"), ("é ß É", "de"), ("é ß É", "de"), (None, None), ("", "en"),
            (". , ;", "en"), ("\x01 \x01", "en"), ("\x01 \x01 ", "en")]
    docs = spark.createDataFrame([(i, t, lang, "s", 0) for i, (t, lang) in enumerate(rows)], DOCS_DDL)
    assert result(col.collocations(docs, least=2)) == brute(rows, 2)
    assert result(col.collocations(docs, least=2, top=1)) == brute(rows, 2, top=1)


def test_edge_rows_and_empty_table(spark):
    docs = edge_docs(spark)
    rows = [(r.text, r.lang) for r in docs.collect()]
    assert result(col.collocations(docs, least=2)) == brute(rows, 2)
    assert col.collocations(empty_docs(spark)).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.sets(st.tuples(*[st.integers(1, 700)] * 3), min_size=1, max_size=300),
       st.lists(st.integers(0, 700), max_size=300))
def test_trie_finds_every_phrase(phrases, text):
    rows = sorted(phrases)
    text = [*text, *rows[0], *rows[-1]]
    trie = col.Trie(np.array(rows, np.int32), 1, 701, 2)
    at, number = trie.positions(np.array([*text, 0, 0, 0, 0], np.int32))
    want = [(i, rows.index(tuple(text[i:i + 3]))) for i in range(len(text) - 2)
            if tuple(text[i:i + 3]) in phrases]
    assert list(zip(at.tolist(), number.tolist())) == want


def test_a_trie_takes_few_bytes_a_state():
    """The driver builds the trie of a cut, and every task holds a copy."""
    n, length, digits = 60_000, 4, 3
    codes = np.random.default_rng(3).integers(1, 2_000_001, (n, length), dtype=np.int32)
    phrases = np.unique(codes, axis=0)
    low, high = int(phrases[0, 0]), int(phrases[-1, 0]) + 1
    states = len(phrases) * digits * (length - 1)
    tracemalloc.start()
    trie = col.Trie(phrases, low, high, digits)
    kept, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert kept < 12 * (states + high - low) and most < 36 * (states + high - low)
    text = np.concatenate([np.c_[phrases, np.zeros(len(phrases), np.int32)].ravel(), np.zeros(4, np.int32)])
    at, number = trie.positions(text)
    assert (at == np.arange(len(phrases)) * (length + 1)).all() and (number == np.arange(len(phrases))).all()


def test_phrases_of_one_first_word_are_cut(spark, monkeypatch):
    """A trie holds no more than it may, however many phrases begin alike."""
    rows = [(f"a b{i} c{i % 7} a b{i}", "en") for i in range(40) for _ in range(2)]
    docs = spark.createDataFrame([(i, t, lang, "s", 0) for i, (t, lang) in enumerate(rows)], DOCS_DDL)
    want, made, trie_of = brute(rows, 2), [], col.trie_of

    def recorded(*args):
        made.append((args[3], args[2] - args[1]))
        return trie_of(*args)

    monkeypatch.setattr(col, "trie_of", recorded)
    assert result(col.collocations(docs, least=2, max_phrases=50)) == want
    assert max(n for _, n in made) <= 50 and sum(level == 2 for level, _ in made) > 1
    made.clear()
    monkeypatch.setattr(col, "MAX_STATES", 90)
    assert result(col.collocations(docs, least=2)) == want
    assert max(n * (level - 1) for level, n in made) <= 90


def test_a_text_is_cut_at_blanks_only(monkeypatch):
    raw = "the cat. the  dog\tran".encode()
    whole = [w for part in col.words_of(raw) for w in part if w]
    monkeypatch.setattr(col, "CHUNK", 3)
    assert [w for part in col.words_of(raw) for w in part if w] == whole
