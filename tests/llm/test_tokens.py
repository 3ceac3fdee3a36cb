import hashlib
import os
import sys
import unicodedata

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(__file__))
from edge_cases import ROWS, edge_docs, empty_docs

from ledgerline.llm import bpe, queries, token_count

WORD_FILE = public_tokenizers.path("word_bpe_49k.json")
BYTE_FILE = public_tokenizers.path("byte_bpe_50k.json")
COUNTER, CODER = token_count.WordCounter(WORD_FILE), bpe.ByteBpe(BYTE_FILE)
WORD_LIB, BYTE_LIB = Tokenizer.from_file(WORD_FILE), Tokenizer.from_file(BYTE_FILE)

ODD = ["", " ", "\n\n a", "a\x1cb\x1d\x85c　d", "aaaa aaaaaaa " * 9, "ΑΣΑΣ ΣΑΣ İ", "é é",
       "x<|endoftext|><|startoftext|> y", "<|endoftext|>", "a <| b |>", "it's WE'LL i'D 1½٣",
       "tab\tand\r\nline\n", "two  blanks", " lead", "trail ", "日本語 한국어 \U0001f600", "z" * 3000,
       "a\xa0b c", "ab" * 2000]


def lib_count(text):
    return len(WORD_LIB.encode(text, add_special_tokens=False).ids)


def lib_ids(text):
    return np.array(BYTE_LIB.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_counts_equal_the_library_on_odd_texts():
    assert COUNTER.counts(ODD) == [lib_count(t) for t in ODD]


def test_ids_and_decoding_equal_the_library_on_odd_texts():
    got = CODER.encode(ODD)
    assert got == [lib_ids(t) for t in ODD]
    for text, ids in zip(ODD, got):
        want = BYTE_LIB.decode(np.frombuffer(ids, "<u4").tolist(), skip_special_tokens=False)
        assert CODER.decode(ids) == want == text


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=60)
                | st.text("ab '\n\tSΣé1.<|>", max_size=60), max_size=6))
def test_random_texts(texts):
    # Characters of newer Unicode versions may be classed differently.
    texts = [t for t in texts if all(ord(c) < 0x3000 for c in t)]
    assert COUNTER.counts(texts) == [lib_count(t) for t in texts]
    assert CODER.encode(texts) == [lib_ids(t) for t in texts]


def test_queries_equal_the_library(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    counts = queries.op2_token_counts(spark, sf).collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in counts} == {
        i: (len(t.encode()), lib_count(t), lib_count(t) > 2048) for i, t in docs.items()}
    coded = queries.op6_bpe_round_trip(spark, sf).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in coded} == {
        i: (len(lib_ids(t)) // 4, hashlib.sha256(lib_ids(t)).hexdigest(),
            hashlib.sha256(t.encode()).hexdigest()) for i, t in docs.items()}


def test_edge_rows_and_empty_table(spark):
    docs = edge_docs(spark)
    key = lambda r: (r[0] is None, r[0] or 0, r[1])                      # noqa: E731
    counts = sorted((r.doc_id, r.n_tokens) for r in
                    token_count.count_tokens(docs, WORD_FILE).collect() if r.doc_id)
    assert counts == sorted((r[0], lib_count(r[1] or "")) for r in ROWS if r[0])
    both = bpe.encode_decode(docs, BYTE_FILE).collect()
    assert sorted(((r.doc_id, r.decoded) for r in both), key=key) == sorted(
        ((r[0], r[1] or "") for r in ROWS), key=key)
    assert token_count.count_tokens(empty_docs(spark), WORD_FILE).collect() == []
    assert bpe.digests(empty_docs(spark), BYTE_FILE).collect() == []


def test_every_code_point():
    """All characters, alone and in words: tokens, ids and decoding."""
    lone = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000
            and unicodedata.category(chr(c)) != "Cn"]
    texts = [f"a{c} {c}b{c}" for c in lone]
    enc = [e.ids for e in WORD_LIB.encode_batch(texts, add_special_tokens=False)]
    assert [t for t, n, e in zip(texts, COUNTER.counts(texts), enc) if n != len(e)] == []
    ids = [e.ids for e in BYTE_LIB.encode_batch(texts, add_special_tokens=False)]
    got = CODER.encode(texts)
    assert [t for t, a, b in zip(texts, got, ids) if a != np.array(b, "<u4").tobytes()] == []


def test_long_texts_in_pieces_and_small_memories(monkeypatch):
    texts = [" ".join(ODD) * 3, "word after word, " * 40, "x " + "y" * 300 + " z", "", "a  b\n\nc d " * 9]
    monkeypatch.setattr(bpe, "CHUNK", 7)
    monkeypatch.setattr(token_count, "CHUNK", 7)
    monkeypatch.setattr(bpe, "MEMO_BYTES", 500)
    monkeypatch.setattr(token_count, "MEMO_BYTES", 500)
    got = bpe.ByteBpe(BYTE_FILE).encode(texts)
    assert got == [lib_ids(t) for t in texts]
    assert [CODER.decode(g) for g in got] == texts
    assert token_count.WordCounter(WORD_FILE).counts(texts) == [lib_count(t) for t in texts]


def test_memories_are_bounded_by_bytes():
    """Many long units, of 200 Chinese characters each."""
    rng = np.random.default_rng(1)
    lines = ["".join(map(chr, rng.integers(0x4E00, 0x9FA5, 200))) for _ in range(3000)]
    coder, counter = bpe.ByteBpe(BYTE_FILE), token_count.WordCounter(WORD_FILE)
    for at in range(0, 3000, 500):
        coder.encode(["\n".join(lines[at:at + 500])])
        counter.counts(["\n".join(lines[at:at + 500])])
    for memo, held in ((coder.memo, coder.held), (counter.memo, counter.held)):
        real = sum(sys.getsizeof(k) + sys.getsizeof(v) for k, v in memo.items())
        assert len(memo) >= 3000 and 0.5 * real < held < 4 * real
