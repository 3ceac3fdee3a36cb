"""Ranks and running sums over tables that no single task can hold.

A table is cut into slices by an expression of the row alone, so every part of
a plan that computes a row's slice gets the same one, whatever the optimiser
prunes, reuses or re-runs:

- ``value_slice``: a monotone function of a number (its sign, and the floor of
  ``PER_OCTAVE`` times its base-2 logarithm).  Equal numbers share a slice and
  larger numbers never have a smaller one.  Fineness only balances the work;
  it cannot change an answer.
- a calendar day of a date, for the position of rows within a key
  (``day_row_number``).
- for running totals over rows that may be tied, ranges that are written with
  their numbers first (``ranges``).

Ranks and sums are taken within a slice and shifted by the counts and totals
of the slices before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators._util import as_list, join_null_safe
from ..session import scratch_path

#: Slices per doubling of the value: a slice spans 0.017 % of a value, and the
#: table of slices stays below 4,096 rows per doubling that occurs.
PER_OCTAVE = 4096


def value_slice(col: str | Column) -> Column:
    """Slice of a number: larger numbers have larger slices; null has none."""
    v = (F.col(col) if isinstance(col, str) else col).cast("double")
    steps = F.floor(F.log2(F.abs(v) + 1) * F.lit(PER_OCTAVE)).cast("long")
    return F.when(v < 0, -steps).otherwise(steps)


def slices_before(sliced: DataFrame, rows_col: str) -> DataFrame:
    """``_slice`` and ``_rows_before``: the sum of ``rows_col`` in the slices with
    larger values.

    One row per slice that occurs, so the unpartitioned window has a bound that
    does not grow with the rows.  Null values come last, in a slice of their own.
    """
    per = sliced.groupBy("_slice").agg(F.sum(rows_col).alias("_rows"))
    above = (Window.orderBy(F.col("_slice").desc_nulls_last())
             .rowsBetween(Window.unboundedPreceding, -1))
    return per.select("_slice", F.coalesce(F.sum("_rows").over(above), F.lit(0))
                      .alias("_rows_before"))


def ranges(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` written to the shared scratch folder in ranges of ``order``, read
    back with the number of its range (``_range``).

    ``order`` must tell all rows apart; then ranges are about equally large
    whatever values repeat.  The number is a written column, so everything that
    reads it sees the same one.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    dealt = df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    dealt.write.parquet(path)
    return spark.read.schema(dealt.schema).parquet(path)


def running_total(df: DataFrame, order: list[Column], value_col: str, name: str) -> DataFrame:
    """``df`` with ``_running`` (the sum of ``value_col`` up to the row in ``order``)
    and ``_sum_all``.  The offsets are one row per range, a number that follows
    ``spark.sql.shuffle.partitions``."""
    kept = ranges(df, order, name)
    per = kept.groupBy("_range").agg(F.sum(value_col).alias("_sum"))
    zero = F.lit(0).cast(per.schema["_sum"].dataType)
    above = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = per.select("_range", F.coalesce(F.sum("_sum").over(above), zero).alias("_before"),
                        F.sum("_sum").over(Window.partitionBy()).alias("_sum_all"))
    within = (Window.partitionBy("_range").orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (kept.withColumn("_local", F.sum(value_col).over(within)).join(before, "_range")
            .withColumn("_running", F.col("_before") + F.coalesce("_local", zero))
            .drop("_range", "_local", "_before"))


def day_row_number(df: DataFrame, keys, date_col: str, order=(), out: str = "row_number"
                   ) -> DataFrame:
    """Add ``out`` = 1-based position of a row within ``keys`` by ``date_col``,
    then ``order``, then all other columns.

    Rows are counted per (keys, day) with map-side combining and the counts
    summed over a key's days, a window bounded by the calendar.  Rows are
    numbered within (keys, day) and shifted by their key's earlier days, an
    equi-join on the same columns.  A key with a large share of all rows is
    spread over its days.
    """
    keys, order = as_list(keys), as_list(order)
    rest = [c for c in df.columns if c not in (*keys, date_col, *order)]
    day = df.withColumn("_day", F.col(date_col).cast("date"))
    earlier = (Window.partitionBy(*keys).orderBy("_day")
               .rowsBetween(Window.unboundedPreceding, -1))
    offsets = (day.groupBy(*keys, "_day").agg(F.count(F.lit(1)).alias("_n"))
               .select(*keys, "_day",
                       F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")))
    within = Window.partitionBy(*keys, "_day").orderBy(date_col, *order, *rest)
    numbered = day.withColumn("_local", F.row_number().over(within))
    return (join_null_safe(numbered, offsets, [*keys, "_day"])
            .withColumn(out, (F.col("_before") + F.col("_local")).cast("bigint"))
            .drop("_day", "_before", "_local"))
