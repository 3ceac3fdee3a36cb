"""The order in which ``events`` arrive in a replay (FIXTURES.md)."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: Files arrive for ``SLICE_DAYS`` days at a time, counted from ``START``; every
#: ``LATE_EVERY``-th event comes one arrival late.
START = "2024-01-01"
SLICE_DAYS = 10
SLICES = 3
LATE_EVERY = 50


def dealt(events: DataFrame) -> DataFrame:
    """``events`` with their ``arrival`` (0 to ``SLICES``)."""
    days = F.datediff(F.col("ts").cast("date"), F.lit(START).cast("date"))
    slice_ = F.least(F.lit(SLICES - 1), F.greatest(F.lit(0), F.floor(days / SLICE_DAYS)))
    late = F.when(F.col("event_id") % LATE_EVERY == 0, 1).otherwise(0)
    return events.withColumn("arrival", (F.coalesce(slice_, F.lit(0)) + late).cast("int"))


def arrivals(spark: SparkSession, events: DataFrame) -> Iterator[DataFrame]:
    """The rows of every arrival in turn; ``events`` is read once."""
    path = scratch_path(spark, "arrivals")
    table = dealt(events)
    table.write.partitionBy("arrival").parquet(path)
    kept = spark.read.schema(table.schema).parquet(path)
    for k in range(SLICES + 1):
        yield kept.where(F.col("arrival") == k).select(*events.columns)
