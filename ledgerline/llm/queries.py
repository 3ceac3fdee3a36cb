"""The registered query of each operator, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import (
    bpe,
    collocations,
    exact_dedup,
    fingerprint,
    html_extract,
    langid,
    license_scan,
    mix,
    ngram_join,
    packing,
    spelling,
    token_count,
    toxicity,
)
from .common import table


def vocabulary(name: str) -> str:
    """Where a public vocabulary file lies (a parameter of the operators)."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.licenses(table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(table(spark, sf_dir, "documents"),
                                    vocabulary("word_bpe_49k.json"))


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix.mix(table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op6_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark(table(spark, sf_dir, "documents")).drop("bucket", "chain")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


QUERIES = {f.__name__: f for f in (
    op1_license_scan, op2_token_counts, op3_source_mix, op4_language_id, op5_html_extraction,
    op6_bpe_round_trip, op7_ngram_join, op8_fingerprints, op9_toxicity, op10_exact_dedup, op11_collocations,
    op12_spelling_variants, op13_best_fit_packing,
)}

#: DuckDB SQL of the queries that SQL can express.
ORACLE_SQL = {"op10_exact_dedup": exact_dedup.SQL}
