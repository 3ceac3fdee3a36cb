import hashlib
import os
import re
import sys

import public_tokenizers
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(__file__))
import test_exact_dedup
import test_mix
import test_ngram_join
from edge_cases import edge_docs, empty_docs

import corpus_pipeline
from ledgerline.llm import langid, mix
from ledgerline.llm.common import staged

SF = "/root/testdata/sf0.001"


def test_every_stage_against_brute_force(spark):
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns

    kept = staged(spark, stages["language_id"](spark, docs, SF), "t1")
    said = {r.doc_id: r for r in langid.identify(docs).collect()}
    assert {r.doc_id for r in kept.collect()} == {
        i for i, r in said.items() if r.lang_pred != "und" and r.score >= langid.MIN_SCORE}

    rows = [(r.doc_id, r.text) for r in kept.collect()]
    whole = staged(spark, stages["exact_dedup"](spark, kept, SF), "t2")
    assert {r.doc_id for r in whole.collect()} == {
        i for i, _, _, stays, _ in test_exact_dedup.brute_force(rows) if stays}

    rows = [(r.doc_id, r.text) for r in whole.collect()]
    near = staged(spark, stages["ngram_jaccard"](spark, whole, SF), "t3")
    assert {r.doc_id for r in near.collect()} == {
        i for i, (c, _) in test_ngram_join.brute_force(rows).items() if i == c}

    before = {r.doc_id: r for r in near.collect()}
    mixed = staged(spark, stages["source_mix"](spark, near, SF), "t4")
    plan = mix.mix(near).collect()
    for took, target, _ in test_mix.check(plan, {i: r.source for i, r in before.items()}).values():
        assert abs(took - target) <= 2 + 0.005 * target
    copies = {}
    for r in mixed.collect():
        assert r == before[r.doc_id]
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
    assert copies == {r.doc_id: r.taken // r.size for r in plan if r.taken}
    for df in (kept, whole, near, mixed):
        assert df.columns == columns

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    coded = stages["bpe_encode"](spark, mixed, SF).collect()
    want = sorted((r.doc_id, len(library.encode(r.text, add_special_tokens=False).ids),
                   hashlib.sha256(r.text.encode()).hexdigest()) for r in mixed.collect())
    assert sorted((r.doc_id, r.n_tokens, r.decoded_sha256) for r in coded) == want
    ids = {r.doc_id: r.ids for r in coded}
    assert all(ids[r.doc_id] == library.encode(r.text, add_special_tokens=False).ids
               for r in mixed.collect())
    run = corpus_pipeline.run(spark, SF).collect()
    assert sorted((r.doc_id, r.n_tokens, r.decoded_sha256) for r in run) == want


def test_edge_rows_and_empty_table(spark):
    for docs in (edge_docs(spark), empty_docs(spark)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            columns = docs.columns
            docs = staged(spark, stage(spark, docs, SF), f"edge-{name}")
            assert docs.columns == columns
        texts = [re.sub(r"\s", "", r.text) for r in docs.collect()]
        assert len(texts) >= len(set(texts))
        corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
