"""A training-data pipeline over ``documents``, stage by stage.

Each stage is a function of ``(spark, docs, sf_dir)``; its result is written as
Parquet and read again as the next stage's ``docs``.  All but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import bpe, exact_dedup, langid, mix, ngram_join
from ledgerline.llm.common import staged, table
from ledgerline.llm.queries import vocabulary


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an identified language go."""
    return langid.keep(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents equal but for white space the longest stays."""
    return exact_dedup.keep(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of similar documents the row with the smallest id stays."""
    return ngram_join.keep(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are mixed to their target weights; a document that is taken
    several times has as many rows."""
    return mix.apply_mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """BPE encoding of what the mix took: its tokens, with the digests that tell
    whether they decode to the text."""
    return bpe.encoded(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("language_id", language),
    ("exact_dedup", exact_copies),
    ("ngram_jaccard", near_copies),
    ("source_mix", source_mix),
    ("bpe_encode", encode),
]

#: SQL cannot express the stages; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = staged(spark, docs, f"pipeline-{name}")
    return docs
