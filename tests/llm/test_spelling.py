import os
import re
import sys
import zlib
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

sys.path.insert(0, os.path.dirname(__file__))
from edge_cases import DOCS_DDL, edge_docs, empty_docs

from ledgerline.llm import queries, spelling


def words_of(rows):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if doc_id is not None and h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 5 and n >= 3}


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def neighbours(words):
    """Near words through the texts with one place left out, checked by ``near``."""
    by = {}
    for w in words:
        for i in range(len(w) + 1):
            by.setdefault(w[:i] + "\0" + w[i:], set()).add(w)         # inserted
        for i in range(len(w)):
            by.setdefault(w[:i] + "\0" + w[i + 1:], set()).add(w)     # replaced
    out = {w: set() for w in words}
    for group in by.values():
        for a in group:
            out[a] |= {b for b in group if near(a, b)}
    return out


def brute(words, all_pairs=False):
    close = ({w: {v for v in words if near(w, v)} for w in words} if all_pairs
             else neighbours(words))
    form = {}
    for w, n in words.items():
        best = min(close[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(close[w]), words[form[w]] if form[w] else None))
    return sorted(out)


def result(df):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect())


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    df = queries.op12_spelling_variants(spark, sf)
    assert result(df) == brute(words_of(rows))
    assert dict(df.dtypes) == {**dict.fromkeys(["word", "form", "root"], "string"),
                               **dict.fromkeys(["n", "n_near", "form_n"], "bigint")}


def test_near_words_of_all_pairs(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    words = words_of([(r.doc_id, r.text) for r in docs.collect()])
    few = dict(sorted(words.items())[:1500])
    assert brute(few) == brute(few, all_pairs=True)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(words=st.dictionaries(st.text("aabé", min_size=5, max_size=9), st.integers(3, 50),
                             min_size=2, max_size=60))
def test_repetitive_words_lose_no_pair(spark, words):
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    got = {(r.a, r.b) for r in spelling.near_pairs(df).collect()}
    want = {(a, b) for a in words for b in words
            if near(a, b) and (len(a), a) < (len(b), b)}
    assert got == want


def test_forms_lead_to_the_last(spark):
    """A chain of forms, each twice as frequent; ties in the count by the word."""
    words = {"aaaaa": 3, "aaaab": 6, "aaabb": 12, "aabbb": 24, "abbbb": 48,
             "zzzzz": 5, "zzzzy": 10, "zzzzx": 10}
    rows = [(None, " ".join([w] * n)) for w, n in words.items()]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS_DDL)
    got = result(spelling.variants(docs))
    assert got == brute(words)
    assert {w: r for w, _, r, *_ in got}["aaaaa"] == "abbbb"
    assert {w: f for w, f, *_ in got}["zzzzz"] == "zzzzx"


def test_edge_rows_long_words_and_empty_table(spark):
    docs = edge_docs(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert result(spelling.variants(docs)) == brute(words_of(rows))
    long = "q" * 30_000
    more = spark.createDataFrame([(1, f"{long} {long} {long}x {long}x {long} {long}x", "en", "s", 0)],
                                 DOCS_DDL)
    assert [r[4] for r in result(spelling.variants(more))] == [
        r[4] for r in brute(words_of([(1, more.first().text)]))]
    assert spelling.variants(empty_docs(spark)).collect() == []
