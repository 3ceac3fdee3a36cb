import os
import random
import sys
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(__file__))
from edge_cases import DOCS_DDL, ROWS, edge_docs, empty_docs

from ledgerline.llm import packing, queries, token_count

FILE = public_tokenizers.path("word_bpe_49k.json")
LIB, CODER = Tokenizer.from_file(FILE), packing.WordIds(FILE)

ODD = ["", " ", "\n\n a", "a\x1cb\x1d\x85c　d", "ΑΣΑΣ ΣΑΣ İ", "x<|endoftext|><|startoftext|> y",
       "<|endoftext|>", "a <| b |>", "it's WE'LL i'D 1½٣", "z" * 3000, "a\xa0b c", "ab" * 2000]


def lib_ids(text):
    return LIB.encode(text or "", add_special_tokens=False).ids + [1]


def cut(rows, capacity):
    return sorted((str(i), k, at, len(ids[at:at + capacity]),
                   zlib.crc32(np.array(ids[at:at + capacity], "<u4").tobytes()))
                  for i, ids in rows for k, at in enumerate(range(0, len(ids), capacity)))


def check(found, rows, capacity):
    """Every piece once, as the library cuts it, and places without gap or overlap."""
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32)
                  for r in found) == cut(rows, capacity)
    by = {}
    for r in found:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in by.values():
        own.sort()
        assert own[0][0] == 0
        assert all(a + n == b for (a, n), (b, _) in zip(own, own[1:]))
        assert sum(n for _, n in own) <= capacity
    return len(by)


def test_ids_equal_the_library_on_odd_texts():
    assert [list(np.frombuffer(x, "<u4")) for x in CODER.encode(ODD)] == [
        lib_ids(t)[:-1] for t in ODD]


def test_long_texts_are_cut_at_blanks(monkeypatch):
    text = " ".join(f"word{i} Häuser {i}" for i in range(500))
    want = CODER.encode([text, "a"])
    assert list(np.frombuffer(want[0], "<u4")) == lib_ids(text)[:-1]
    monkeypatch.setattr(token_count, "CHUNK", 50)
    monkeypatch.setattr(token_count, "MEMO_BYTES", 100)
    assert packing.WordIds(FILE).encode([text, "a"]) == want


def test_query_packs_every_token(spark):
    sf = "/root/testdata/sf0.01"
    docs = [(r.doc_id, lib_ids(r.text)) for r in
            spark.read.parquet(f"{sf}/documents.parquet").collect()]
    df = queries.op13_best_fit_packing(spark, sf)
    n = check(df.collect(), docs, 4096)
    assert n <= -(-sum(len(ids) for _, ids in docs) // 4096) * 1.01 + 1
    assert {"doc_id": "bigint", "piece": "int", **dict.fromkeys(
        ["start", "length", "ids_crc32", "sequence_id", "offset"], "bigint")} == dict(df.dtypes)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=60), st.sampled_from([40, 64]))
def test_plans_place_everything(lengths, capacity):
    counts = np.bincount(lengths, minlength=capacity + 1)
    made = packing.plan(counts, capacity)
    used = np.zeros(capacity + 1, np.int64)
    for times, own in made:
        assert times > 0 and sum(a * b for a, b in own) <= capacity
        for a, b in own:
            used[a] += times * b
    assert (used == counts).all()


def best(lengths, capacity):
    """The fewest sequences, by trying all placements."""
    lengths = sorted(lengths, reverse=True)
    least = [len(lengths)]

    def place(k, bins):
        if len(bins) >= least[0]:
            return
        if k == len(lengths):
            least[0] = len(bins)
            return
        for i in {b: i for i, b in enumerate(bins)}.values():
            if bins[i] + lengths[k] <= capacity:
                place(k + 1, [*bins[:i], bins[i] + lengths[k], *bins[i + 1:]])
        place(k + 1, [*bins, lengths[k]])
    place(0, [])
    return least[0]


def test_plans_are_near_the_best():
    rng, over = random.Random(13), 0
    for _ in range(150):
        lengths = [rng.randint(1, 20) for _ in range(9)]
        made = packing.plan(np.bincount(lengths, minlength=21), 20)
        over += sum(t for t, _ in made) - best(lengths, 20)
    assert over <= 10


def test_exact_combinations_are_found():
    counts = np.zeros(4097, np.int64)
    counts[[3000, 500, 400, 196]] = 1_000_000       # one triple that fills the gap
    assert packing.plan(counts) == [(1_000_000, [(3000, 1), (500, 1), (400, 1), (196, 1)])]
    counts = np.zeros(4097, np.int64)
    counts[4096], counts[1] = 7, 3 * 4096 + 5
    assert packing.plan(counts) == [(7, [(4096, 1)]), (3, [(1, 4096)]), (1, [(1, 5)])]


def test_a_hot_length_and_many_tasks(spark):
    rows = [(i, "one two three" if i % 3 else "word " * (i % 50), "en", "s", 0) for i in range(3000)]
    docs = spark.createDataFrame(rows, DOCS_DDL).repartition(7)
    n = check(packing.pack(docs, FILE, 64).collect(), [(r[0], lib_ids(r[1])) for r in rows], 64)
    assert n <= sum(len(lib_ids(r[1])) for r in rows) / 64 * 1.01 + 1


def test_edge_rows_and_empty_table(spark):
    check(packing.pack(edge_docs(spark), FILE).collect(), [(r[0], lib_ids(r[1])) for r in ROWS], 4096)
    assert packing.pack(empty_docs(spark), FILE).collect() == []
