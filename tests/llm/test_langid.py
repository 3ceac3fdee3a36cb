import os
import sys
import tracemalloc
import zlib

import numpy as np

sys.path.insert(0, os.path.dirname(__file__))
from edge_cases import edge_docs, empty_docs

from ledgerline.llm import langid, queries


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet")
            .select("doc_id", "lang").collect()}
    rows = queries.op4_language_id(spark, sf).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert r.lang_pred in {*docs.values(), "und"} and 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == docs[r.doc_id] for r in held]) > 0.98


def test_labels_of_held_out_rows_are_not_learned(spark):
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 4 == 2]
    rest = [i for i in range(200) if i not in held]
    rows = [(i, "der die das und ist nicht", "de") for i in rest[:60]]
    rows += [(i, "the and this that is not", "en") for i in rest[60:]]
    rows += [(i, "the and this that is not", "de") for i in held]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING")
    got = {r.doc_id: r.lang_pred for r in langid.identify(docs).collect()}
    assert {got[i] for i in held} == {"en"}


def test_families_then_languages():
    assert langid.family("pt-BR") == langid.family("es") == "romance"
    assert langid.family("xx") == "xx"
    words = {"es": "el perro y la casa que no es de los", "fr": "le chien et la maison qui ne est",
             "en": "the dog and the house that is not", "ja": "犬と家はありません"}
    rng = np.random.default_rng(5)
    texts, langs = [], []
    for lang, said in words.items():
        for _ in range(40):
            texts.append(" ".join(rng.permutation(said.split() if lang != "ja" else list(said))))
            langs.append(lang)
    order = rng.permutation(len(texts))
    model = langid.Model(langid.features([texts[i] for i in order]), [langs[i] for i in order])
    assert set(model.top.names) == {"romance", "germanic", "ja"}
    got, scores = model.predict([*words.values(), "", "123 !?"])
    assert got == [*words, "und", "und"] and scores[-2:] == [0.0, 0.0]


def test_edge_rows_and_empty_table(spark):
    docs = edge_docs(spark)
    rows = langid.identify(docs).collect()
    assert len(rows) == docs.count()
    by_text = list(zip([r.text for r in docs.collect()], rows))
    for text, r in by_text:
        if not langid.LETTER.search(text or ""):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        if r.doc_id is None:
            assert r.held_out is False
    kept = langid.keep(docs)
    assert kept.columns == docs.columns and kept.where("text IS NULL").count() == 0
    assert langid.identify(empty_docs(spark)).collect() == []
    unlabelled = docs.withColumn("lang", docs["lang"].substr(9, 9)).replace("", None, ["lang"])
    assert {r.lang_pred for r in langid.identify(unlabelled).collect()} == {"und"}


def test_long_texts_are_read_in_pieces(monkeypatch):
    """Pieces change no feature, and a very long text needs little memory."""
    rng = np.random.default_rng(8)
    said = ["Der  Hund", "\t", "la casa,", "ΑΣ", "don't", "日本語の文", "12", "é", "x" * 90, " ", "\n"]
    texts = [" ".join(rng.choice(said, n)) for n in rng.integers(0, 80, 60)] + ["", " ", "日本" * 400]
    whole = langid.features(texts)
    for size in (100, 333):
        monkeypatch.setattr(langid, "PIECE_CHARS", size)
        assert np.array_equal(langid.features(texts), whole)
    monkeypatch.undo()
    for text in ("el perro y la casa " * 400_000, "日本語" * 2_000_000):
        tracemalloc.start()
        assert langid.features([text]).any()
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 64 * 2**20
