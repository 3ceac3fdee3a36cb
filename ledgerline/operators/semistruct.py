"""Semi-structured values: JSON objects with drifting keys and broken documents."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: What is wrong with a document; null if nothing is.
BROKEN = "broken_json"


def _object(col: str):
    """The object of ``col`` as a map of texts; null if it is none.

    ``from_json`` also takes what stands before a break, so the text must close
    what it opens: it is read as a map and as a whole.
    """
    return F.when(F.col(col).rlike(r"^\s*\{[\s\S]*\}\s*$"),
                  F.from_json(col, "map<string,string>", {"mode": "PERMISSIVE"}))


def parse_json(df: DataFrame, col: str, fields: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """(rows with typed columns, quarantined rows).

    ``fields`` maps a key to its Spark SQL type; each becomes a column of its name
    in place of ``col``.  A key that is missing, null or not of the type is null,
    as is every key of a row whose ``col`` is null.  A row whose text is no JSON
    object is quarantined with its text and the reason in ``reject_reason``.
    """
    read = df.withColumn("_object", _object(col))
    bad = F.col(col).isNotNull() & F.col("_object").isNull()
    good = read.where(~bad).withColumns({
        name: F.col("_object").getItem(name).try_cast(kind) for name, kind in fields.items()})
    return (good.drop("_object", *([col] if col not in fields else [])),
            read.where(bad).drop("_object").withColumn("reject_reason", F.lit(BROKEN)))


def key_profile(df: DataFrame, col: str) -> DataFrame:
    """Every key of the objects in ``col``: ``rows`` that have it, how many of its
    values are ``nulls``, ``numbers`` or other ``texts``, and its distinct values.

    Counted once per (key, value) with map-side combining, so a key that all rows
    have is a row per value and map task before the shuffle.
    """
    pairs = (df.select(F.explode(_object(col)).alias("key", "value"))
             .groupBy("key", "value").agg(F.count(F.lit(1)).alias("n")))
    number = F.col("value").try_cast("decimal(38,9)").isNotNull()

    def total(cond):
        return F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0))

    return pairs.groupBy("key").agg(
        F.sum("n").alias("rows"), total(F.col("value").isNull()).alias("nulls"),
        total(number).alias("numbers"), total(F.col("value").isNotNull() & ~number).alias("texts"),
        F.count("value").alias("distinct_values"))
