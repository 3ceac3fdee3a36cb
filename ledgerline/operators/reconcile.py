"""Bag operations: which rows two tables have in common, and how often.

``EXCEPT ALL`` and ``INTERSECT ALL`` as one aggregate over both tables: rows are
counted on each side, equal rows (nulls equal nulls) are combined before the
shuffle, and no join is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Copies that one row is repeated to at once.
BLOCK = 10_000


def bag_counts(left: DataFrame, right: DataFrame) -> DataFrame:
    """Every different row with ``_left`` and ``_right``, how often each side has it.
    Both sides must have the same column names."""
    if sorted(left.columns) != sorted(right.columns):
        raise ValueError(f"different columns: {left.columns} and {right.columns}")
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    both = (left.withColumn("_left", one).withColumn("_right", none)
            .unionByName(right.withColumn("_left", none).withColumn("_right", one)))
    return both.groupBy(*left.columns).agg(F.sum("_left").alias("_left"),
                                           F.sum("_right").alias("_right"))


def repeat(df: DataFrame, times: Column) -> DataFrame:
    """Every row ``times`` times (none if that is below one).  A row with very many
    copies is first cut into blocks, so that no array grows with them."""
    blocks = df.withColumn("_times", times).where("_times > 0").withColumn(
        "_block", F.explode(F.expr(f"sequence(0L, (_times - 1) DIV {BLOCK})")))
    copies = F.expr(f"array_repeat(0, CAST(least({BLOCK}L, _times - _block * {BLOCK}L) AS INT))")
    return (blocks.withColumn("_copy", F.explode(copies))
            .drop("_times", "_block", "_copy"))


def bag_except(left: DataFrame, right: DataFrame) -> DataFrame:
    """``left EXCEPT ALL right``: each row as often as the left side has it more."""
    return repeat(bag_counts(left, right), F.col("_left") - F.col("_right")).select(*left.columns)


def bag_intersect(left: DataFrame, right: DataFrame) -> DataFrame:
    """``left INTERSECT ALL right``: each row as often as both sides have it."""
    return repeat(bag_counts(left, right), F.least("_left", "_right")).select(*left.columns)


def reconcile(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: ``left_rows``, ``right_rows``, ``common_rows``, ``only_left`` and
    ``only_right``, copies counted."""
    return bag_counts(left, right).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(n) for n, c in {
        "left_rows": F.col("_left"), "right_rows": F.col("_right"),
        "common_rows": F.least("_left", "_right"),
        "only_left": F.greatest(F.col("_left") - F.col("_right"), F.lit(0)),
        "only_right": F.greatest(F.col("_right") - F.col("_left"), F.lit(0))}.items()])
