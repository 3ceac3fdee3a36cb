"""Operator 10: exact duplicates through an extendible-hash index.

Texts are equal when they are identical after the ASCII white space is
deleted.  Everything is DataFrame work:

1. Keys.  Every text is normalised and hashed once, into a table on the shared
   folder (row, doc_id, length, normalised text, hash, digest).
2. Directory.  A slot is the leading bits of the hash.  The directory doubles as
   long as a bucket holds more than ``capacity`` different hashes, and only
   overfull buckets split, so a bucket is named by as few leading bits as it
   needs.  Its depth follows the number of texts, without a limit: the first
   depth tried leaves buckets of about eight times the capacity, the last ones of
   a thirty-second.
3. Owners.  The directory routes every row to its bucket.  Copies meet under
   (bucket, hash, text): they are combined before the shuffle, and equal means
   equal byte by byte.  The owner of a bucket, a range of hashes, chains the
   entries whose hashes collide and writes them to the shared folder.  Different
   texts with the same hash *and* digest end the job with an error instead of
   being merged.
4. Probe.  Rows go through the directory to their bucket and look up their chain
   there by (hash, digest); a hot entry's rows are split by AQE's skew join, the
   index side being one row.

Of equal texts the row with the most code points, then the smallest doc_id,
stays.  Defined results: null text counts as empty, so do texts of white space
only (one group); doc_ids are integers (else an error), null ones come last;
rows that repeat doc_id and text get the same values each (``keep`` then leaves
one of them); an empty table gives an empty result; extra columns are ignored
by ``mark`` and kept by ``keep``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from .common import WHITE_CHARS, identified, partitions, staged, text_or_empty

#: Different hashes of a bucket before it splits.
CAPACITY = 512
#: Depths tried below and above the one at which buckets are just full.
BELOW, ABOVE = 3, 5
#: A directory of at most 2 to the power of this many slots is broadcast.
SMALL = 16
#: doc_id that stands for null: comes last.
LAST_ID = 2**63 - 1
#: Above twice any doc_id: (n_chars, doc_id) in one number, so that the best
#: row of a group is a hash aggregate.
STEP = "20000000000000000000"


def _sha(norm) -> Column:
    """Digest of a normalised text, never null."""
    return F.coalesce(F.sha2(norm, 256), F.lit(""))


def keys(docs: DataFrame) -> DataFrame:
    """row, _file, _index, doc_id, n_chars, norm, h, sha of identified ``docs``,
    written once."""
    if not isinstance(docs.schema["doc_id"].dataType, IntegralType):
        raise TypeError("doc_id must be an integer")
    text = docs.select("doc_id", "_file", "_index", text_or_empty().alias("text"))
    norm = text.select("doc_id", "_file", "_index", F.char_length("text").alias("n_chars"),
                       F.translate("text", WHITE_CHARS, "").alias("norm"))
    return staged(docs.sparkSession, norm.select(
        F.monotonically_increasing_id().alias("row"), "*", F.xxhash64("norm").alias("h"),
        _sha("norm").alias("sha")), "dedup-keys")


def _slot(depth: int) -> Column:
    return F.expr(f"shiftrightunsigned(h, {64 - depth})")


def directory(found: DataFrame, capacity: int = CAPACITY) -> tuple[DataFrame, int]:
    """(slot, bucket of every slot that occurs; bits of a slot).

    Depth d has 2^d buckets; a slot's bucket at depth d is the one that its
    first d bits name, and its bucket is that of the first depth at which it
    holds at most ``capacity`` hashes.  ``bucket`` numbers the buckets of all
    depths.  No window holds more than the slots of one bucket of the first
    depth tried, a number that does not grow.
    """
    number = found.agg(F.approx_count_distinct("h")).first()[0]
    full = max(0, math.ceil(math.log2(max(1, number) / capacity)))
    last, first = min(63, full + ABOVE), max(0, full - BELOW)
    slots = (found.select("h").distinct().groupBy(_slot(last).alias("slot"))
             .agg(F.count(F.lit(1)).alias("n")))
    depths = slots.withColumn("depth", F.explode(F.sequence(F.lit(first), F.lit(last))))
    prefix = F.expr(f"shiftright(slot, {last} - depth)")
    load = F.sum("n").over(Window.partitionBy("depth", "prefix"))
    fits = (F.col("load") <= capacity) | (F.col("depth") == last)
    named = F.expr(f"shiftleft(1L, depth) + shiftright(slot, {last} - depth)")
    return (depths.withColumn("prefix", prefix).withColumn("load", load).where(fits)
            .groupBy("slot").agg(F.min("depth").alias("depth"))
            .select("slot", named.alias("bucket")), last)


class Index:
    """The written index of ``docs``: ``rows`` (their keys), ``directory`` and
    ``entries`` (bucket, chain, h, sha, group_size, keep_id)."""

    def __init__(self, docs: DataFrame, capacity: int = CAPACITY):
        spark = docs.sparkSession
        self.rows = keys(docs)
        slots, self.depth = directory(self.rows, capacity)
        self.directory = staged(spark, slots, "dedup-directory")
        rank = F.expr(f"CAST(n_chars AS DECIMAL(10,0)) * CAST({STEP} AS DECIMAL(20,0)) - "
                      f"CAST(coalesce(CAST(doc_id AS BIGINT), {LAST_ID}) AS DECIMAL(19,0))")
        best = F.expr(f"CAST(n AS DECIMAL(10,0)) * CAST({STEP} AS DECIMAL(20,0)) - best")
        # The digest follows from the text; as a key it keeps the aggregate a hash one.
        met = (self.routed().groupBy("bucket", "h", "sha", "norm")
               .agg(F.count(F.lit(1)).alias("group_size"), F.max("n_chars").alias("n"),
                    F.max(rank).alias("best"))
               .select("bucket", "h", "sha", "group_size",
                       F.nullif(best.cast("bigint"), F.lit(LAST_ID)).alias("keep_id")))
        owned = met.repartition(partitions(spark), "bucket")
        chain = Window.partitionBy("bucket", "h").orderBy("sha")
        same = F.lag("sha").over(chain) == F.col("sha")
        self.entries = staged(spark, owned.withColumn("chain", F.row_number().over(chain))
                              .withColumn("same", same)
                              .withColumn("chain", F.when(F.col("same"), F.raise_error(
                                  F.lit("two texts share their hash and digest")).cast("int"))
                                  .otherwise(F.col("chain"))).drop("same"), "dedup-index")

    def routed(self) -> DataFrame:
        """The rows with the bucket that the directory names."""
        slots = F.broadcast(self.directory) if self.depth <= SMALL else self.directory
        return self.rows.withColumn("slot", _slot(self.depth)).join(slots, "slot").drop("slot")

    def probed(self) -> DataFrame:
        """row, doc_id and the entry of every row, from its bucket."""
        own = self.routed().select("row", "doc_id", "bucket", "h", "sha")
        return own.join(self.entries, ["bucket", "h", "sha"])


def mark(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, bucket, chain per row."""
    return (Index(identified(docs), capacity).probed()
            .select("doc_id", "keep_id", "group_size",
                    F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                    F.col("sha").alias("text_sha256"), "bucket", "chain"))


def keep(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; of rows that
    repeat doc_id and text, the first."""
    own = identified(docs)
    index = Index(own, capacity)
    first = (index.probed().where(F.col("doc_id").eqNullSafe(F.col("keep_id")))
             .groupBy("bucket", "h", "chain").agg(F.min("row").alias("row")).select("row"))
    stay = index.rows.join(first, "row").select("_file", "_index")
    return own.join(stay, ["_file", "_index"], "left_semi").select(*docs.columns)


#: DuckDB SQL of the query op10.
SQL = r"""
WITH n AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS s
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY s ORDER BY length(t) DESC, doc_id NULLS LAST) AS keep_id,
       count(*) OVER (PARTITION BY s) AS group_size,
       doc_id IS NOT DISTINCT FROM
         first_value(doc_id) OVER (PARTITION BY s ORDER BY length(t) DESC, doc_id NULLS LAST) AS kept,
       sha256(s) AS text_sha256
FROM n
"""
