"""Rows that every operator must survive, shared by the tests."""

LONG = "lorem ipsum dolor sit amet consectetur " * 4000

DOCS_DDL = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"

#: Nulls in every column, empty and very long texts, ties, repeated rows.
ROWS = [
    (1, "one two three four five six seven", "en", "a", 33),
    (2, "one two three four five six seven", "en", "a", 33),
    (3, "one  two three four five six\tseven ", None, None, None),
    (4, None, "en", "b", None),
    (5, "", "en", "b", 0),
    (6, " \n\t ", "en", "b", 4),
    (7, LONG, "en", "b", len(LONG)),
    (8, LONG + " end", "en", None, None),
    (9, "x" * 40_000, "en", "c", 40_000),
    (10, "Größe Öl İstanbul ΑΣ 日本語 \U0001f600 ½", "de", "c", 30),
    (11, "a <|endoftext|> b", "en", "c", 17),
    (12, "12 34 !!", "en", "c", 8),
    (12, "12 34 !!", "en", "c", 8),
    (None, "no id at all here today", "en", "a", 23),
    (None, None, None, None, None),
]

#: Extra columns whose names clash with names used inside the operators.
CLASHING = ["norm", "h", "sha", "n", "size", "src", "rep", "node", "root", "bucket", "keep_id",
            "class_id", "taken", "u", "k", "kind", "slice", "score", "n_tokens", "depth"]


def edge_docs(spark):
    from pyspark.sql import functions as F
    docs = spark.createDataFrame(ROWS, DOCS_DDL)
    return docs.select("*", *[F.lit(f"x{c}").alias(c) for c in CLASHING])


def empty_docs(spark):
    return spark.createDataFrame([], DOCS_DDL)
