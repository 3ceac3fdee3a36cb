"""SNK-1 / SNK-2: write the cleaned fact and the dashboard result tables."""

from __future__ import annotations

import datetime as _dt
import os
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .csv import NULL


def write_clean(df: DataFrame, path: str, date_col: str = "order_date",
                partition_col: str = "order_month", tie_cols: tuple[str, ...] = ("order_id",),
                mode: str = "overwrite") -> StructType:
    """SNK-1: write the fact as Parquet, partitioned by month.

    Rows are rebalanced on the month before the write: one shuffle, no
    sampling pass, and AQE cuts a month that is larger than the advisory
    partition size into several tasks and puts small months together, so each
    month gets few files of about that size.  Readers should filter on
    ``partition_col`` as well as on ``date_col``: a filter on the date alone
    does not prune partitions.  Returns the written schema (partition column
    included): pass it to ``read_clean``, so that even an empty result, which
    leaves no Parquet file to infer a schema from, reads back.
    """
    out = df.withColumn(partition_col, F.trunc(F.col(date_col), "month"))
    order = [date_col, *[c for c in tie_cols if c in df.columns]]
    (out.hint("rebalance", partition_col)
        .sortWithinPartitions(partition_col, *order)
        .write.mode(mode)
        .partitionBy(partition_col)
        .parquet(path))
    return out.schema


def publish(results: Mapping[str, DataFrame], path: str, mode: str = "overwrite") -> list[str]:
    """SNK-2: write one Parquet table per dashboard visual under ``path``.

    Result tables are aggregates (one row per period / group), so each is
    written as it comes; the writes run on the executors, never the driver.
    """
    written = []
    for name, df in results.items():
        target = os.path.join(path, name)
        df.write.mode(mode).parquet(target)
        written.append(target)
    return written


def export_csv(df: DataFrame, path: str, header: bool = True, sep: str = ",",
               mode: str = "overwrite") -> str:
    """Write a raw delimited export (values kept as they are, spaces included).

    Spark's CSV writer trims leading and trailing spaces by default; a raw
    export must not, or the cleaning step would never see them.  Nulls are
    written as ``\\N``, empty strings as ``""``; ``load_csv`` reads them back.
    """
    (df.write.mode(mode)
       .option("header", header).option("sep", sep).option("nullValue", NULL)
       .option("ignoreLeadingWhiteSpace", False)
       .option("ignoreTrailingWhiteSpace", False)
       .csv(path))
    return path


def _as_date(v):
    return _dt.date.fromisoformat(v) if isinstance(v, str) else v


def read_clean(spark: SparkSession, path: str, start=None, end=None,
               date_col: str = "order_date", partition_col: str = "order_month",
               keep_partition_col: bool = False, schema: StructType | None = None) -> DataFrame:
    """Read ``write_clean`` output for ``start <= date < end``.

    The bound is applied twice: on the month partition column, which prunes
    folders (``PartitionFilters``), and on the date itself, which trims the
    first and last month and is pushed into the Parquet scan.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(path)
    if start is not None:
        s = _as_date(start)
        df = df.filter((F.col(partition_col) >= F.lit(s.replace(day=1)))
                       & (F.col(date_col) >= F.lit(s)))
    if end is not None:
        e = _as_date(end)
        df = df.filter((F.col(partition_col) < F.lit(e)) & (F.col(date_col) < F.lit(e)))
    return df if keep_partition_col else df.drop(partition_col)
