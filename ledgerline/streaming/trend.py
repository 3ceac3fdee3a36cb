"""A windowed trend over a stream, with a watermark for late data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._time import as_clock, as_instant

MONEY = "decimal(12,2)"


def _timed(events: DataFrame) -> DataFrame:
    return events.where("ts IS NOT NULL").withColumn("at", as_instant("ts"))


def _started(counted: DataFrame, by: str, *cols: str) -> DataFrame:
    return counted.select(as_clock("unix_micros(w.start)").alias("period"), by, *cols)


def windowed_trend(events: DataFrame, by: str = "event_type", period: str = "1 hour",
                   delay: str = "2 hours") -> DataFrame:
    """Events and value per window of ``period`` and ``by``.

    ``events`` is a stream (or a table) with ``ts``, ``by`` and ``value``.  In
    append mode a window is written once, when the watermark (the largest ``ts``
    of earlier batches less ``delay``) has reached its end; rows that come later
    than that are dropped, see ``late_windows``.  State holds the open windows
    only; a hot group is combined before the shuffle.  Rows without ``ts`` are
    not part of the series; a null ``by`` is a group.
    """
    counted = (_timed(events).withWatermark("at", delay)
               .groupBy(F.window("at", period).alias("w"), by)
               .agg(F.count(F.lit(1)).alias("events"),
                    F.sum(F.col("value").cast(MONEY)).alias("value")))
    return _started(counted, by, "events", "value")


def late_windows(events: DataFrame, watermark: int | None, by: str = "event_type",
                 period: str = "1 hour") -> DataFrame:
    """Rows of one batch that ``windowed_trend`` drops at ``watermark``
    (microseconds since 1970; None: none), counted by window and ``by``."""
    timed = _timed(events).select(F.window("at", period).alias("w"), by)
    late = F.lit(False) if watermark is None else F.expr("unix_micros(w.end)") <= watermark
    return _started(timed.where(late).groupBy("w", by).agg(F.count(F.lit(1)).alias("late_events")),
                    by, "late_events")
