"""Operator 12: spelling variants by asymmetric q-chunks.

Words are the runs of Latin letters of all texts, lower-cased (A-Z), counted;
by a rule on (doc_id, run) some runs lose a letter first.  Two words are near
if they differ by exactly one inserted, deleted or replaced code point.

The shorter word (or the smaller of equally long ones) contributes two disjoint
chunks, its halves; one edit preserves at least one of them.  The edit then lies
in the other half, which is cut into two chunks of its own, one of which is
preserved as well.  So a word contributes four keys, each of a preserved half
and a preserved quarter.  The other word contributes its positional grams of
those lengths at the places where the chunks can lie: shifted by the difference
of the lengths (0 or 1) if the edit comes before the chunk, else not at all.
Both meet in an equi-join on a hash of length, key number and grams, whose
condition verifies the distance, so only near pairs leave it.  A key holds all
but a quarter of the letters: groups stay small, and AQE splits a hot one.

Forms (the near word with the largest count, if at least ``FACTOR`` times as
frequent) are followed to their root by doubling jumps over a written table.

Defined results: null texts have no words; a null doc_id leaves its runs as
they are; texts and runs of any length are read whole; repeated rows count each;
ties in the count go to the word first in code point order; an empty table gives
an empty result; extra columns are ignored.  Spark functions only.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged, text_or_empty

LETTERS = r"A-Za-zÀ-ÿ"
SHORTEST = 5
LEAST = 3
FACTOR = 2
#: A run loses a code point if this number divides its checksum.
EVERY = 97


def vocabulary(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST) -> DataFrame:
    """word, n: the words of ``docs`` with ``shortest`` code points and ``least``
    occurrences or more."""
    text = F.translate(text_or_empty(), string.ascii_uppercase, string.ascii_lowercase)
    # Shorter runs cannot become words: none gains a letter.
    runs = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.explode(
        F.regexp_extract_all(text, F.lit(f"[{LETTERS}]{{{shortest},}}"), F.lit(0))).alias("run"))
    h = F.crc32(F.concat("doc_id", F.lit(":"), "run").cast("binary"))
    at = F.pmod(F.col("h"), F.char_length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at),
                   F.substring("run", at + 2, F.char_length("run")))
    word = F.when(F.col("h") % EVERY == 0, cut).otherwise(F.col("run"))
    return (runs.withColumn("h", h).select(word.alias("word"))
            .where(F.char_length("word") >= shortest)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= least))


def _cuts(length: Column) -> tuple[Column, Column, Column]:
    """Ends of the first quarter, the first half and the third quarter of a
    word of ``length`` code points."""
    half = F.floor(length / 2)
    return F.floor(half / 2), half, half + F.floor((length - half) / 2)


def _gram(begin: Column, end: Column) -> Column:
    return F.substring(F.col("word"), (begin + 1).cast("int"), (end - begin).cast("int"))


def _keys(length: Column, shift: Column) -> Column:
    """The four keys of a chunked word of ``length``, read from a word that may
    hold one more code point (``shift``) before its later chunks."""
    quarter, half, third = _cuts(length)
    zero = F.lit(0)
    grams = [
        # First half kept: the edit is in the fourth or in the third quarter.
        (_gram(zero, half), _gram(half, third)),
        (_gram(zero, half), _gram(third + shift, length + shift)),
        # Second half kept, moved by an edit before it.
        (_gram(zero, quarter), _gram(half + shift, length + shift)),
        (_gram(quarter + shift, half + shift), _gram(half + shift, length + shift)),
    ]
    return F.array(*[F.xxhash64(length.cast("int"), F.lit(k), a, b)
                     for k, (a, b) in enumerate(grams)])


def near_pairs(words: DataFrame) -> DataFrame:
    """a, an, b, bn: every pair of near words once, with their counts."""
    size = F.char_length("word")
    chunks = words.select(F.col("word").alias("a"), F.col("n").alias("an"), size.alias("a_size"),
                          F.explode(_keys(size, F.lit(0))).alias("key"))
    grams = words.select(F.col("word").alias("b"), F.col("n").alias("bn"), F.explode(F.array(
        F.struct(size.alias("size"), _keys(size, F.lit(0)).alias("keys")),
        F.struct((size - 1).alias("size"), _keys(size - 1, F.lit(1)).alias("keys"))))
        .alias("as")).select("b", "bn", F.col("as.size").alias("a_size"),
                             F.explode("as.keys").alias("key"))
    other = (F.char_length("b") > F.col("a_size")) | (F.col("a") < F.col("b"))
    return (chunks.join(grams, ["key", "a_size"])
            .where(other & (F.levenshtein("a", "b", 1) == 1))
            .select("a", "an", "b", "bn").distinct())


def roots(forms: DataFrame, rounds: int = 64) -> DataFrame:
    """word, root: where the forms (word, form) of ``forms`` lead in the end."""
    spark = forms.sparkSession
    jump = staged(spark, forms.select("word", F.col("form").alias("root")), "spelling-jumps")
    for _ in range(rounds):
        ahead = jump.select(F.col("word").alias("root"), F.col("root").alias("further"))
        jump = staged(spark, jump.join(ahead, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"),
            F.col("further").isNotNull().alias("moved")), "spelling-jumps")
        if jump.where("moved").isEmpty():
            return jump.select("word", "root")
        jump = jump.drop("moved")
    raise RuntimeError("forms do not end")


def variants(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST,
             factor: int = FACTOR) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of ``docs``."""
    spark = docs.sparkSession
    words = staged(spark, vocabulary(docs, shortest, least), "spelling-words")
    pairs = staged(spark, near_pairs(words), "spelling-pairs")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("bn").alias("m")
                        ).union(pairs.select("b", "a", "an"))
    best = both.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("m")).alias("m"), F.col("near"))).alias("best"))
    good = -F.col("best.m") >= F.lit(factor) * F.col("n")
    formed = staged(spark, words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(good, F.col("best.near")).alias("form"),
        F.when(good, -F.col("best.m")).cast("long").alias("form_n")), "spelling-forms")
    ends = roots(formed.where("form IS NOT NULL"))
    return (formed.join(ends, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near",
                    "form_n"))
