"""Joins in time: rows within a span after another row, and as-of joins.

Both are equi-joins or windows on (key, slice of time); neither compares all
pairs of a key, and a key with a large share of all rows is spread over its
slices.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._util import as_list

#: Rows of one (key, bin) that meet spans in one piece; fuller bins are cut.
HOT_ROWS = 10_000


def _day(col: str) -> Column:
    """Days since 1970; does not depend on the session's time zone."""
    return F.datediff(F.col(col).cast("date"), F.lit("1970-01-01").cast("date"))


def _known(keys: Sequence[str]) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & F.col(k).isNotNull()
    return out


def interval_join(points: DataFrame, spans: DataFrame, by, at: str, begin: str, end: str,
                  width_days: int = 1, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Every pair of a point and a span of the same ``by`` with
    ``begin < at <= end``: the columns of both, ``by`` once.

    Time is cut into bins of ``width_days``.  A point lies in one bin, a span is
    repeated for every bin it touches (with a width of about the spans' length
    that is two), so the pairs meet in an equi-join on (key, bin), whose
    condition is the exact check.  A (key, bin) with more than ``hot_rows``
    points is cut by a hash of the point, and its spans are repeated for every
    cut, so no task holds a hot bin whole.

    Keys, points and spans with a null match nothing; neither do spans that end
    before they begin; repeated rows match each; the other column names of the
    two sides must differ.
    """
    by = as_list(by)
    clash = (set(points.columns) & set(spans.columns)) - set(by)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    p = points.where(_known([*by, at])).withColumn("_bin", F.floor(_day(at) / width_days))
    s = (spans.where(_known([*by, begin, end]) & (F.col(begin) <= F.col(end)))
         .withColumn("_bin", F.explode(F.sequence(F.floor(_day(begin) / width_days),
                                                  F.floor(_day(end) / width_days)))))
    hot = (p.groupBy(*by, "_bin").agg(F.count(F.lit(1)).alias("_rows"))
           .where(F.col("_rows") > hot_rows)
           .select(*by, "_bin", F.ceil(F.col("_rows") / hot_rows).cast("int").alias("_cuts")))
    key = [*by, "_bin"]
    cuts = F.coalesce("_cuts", F.lit(1))
    p = (p.join(hot, key, "left")
         .withColumn("_cut", F.pmod(F.xxhash64(*points.columns), cuts).cast("int")).drop("_cuts"))
    s = (s.join(hot, key, "left")
         .withColumn("_cut", F.explode(F.sequence(F.lit(0), cuts - 1))).drop("_cuts"))
    return (p.join(s, [*key, "_cut"])
            .where((F.col(begin) < F.col(at)) & (F.col(at) <= F.col(end)))
            .drop("_bin", "_cut"))


def _slice(col: str, grain: str) -> Column:
    day = F.col(col).cast("date")
    if grain == "day":
        return F.struct(day.alias("day"))
    if grain == "hour":
        return F.struct(day.alias("day"), F.hour(col).alias("hour"))
    raise ValueError(f"grain must be day or hour, not {grain}")


def asof_join(left: DataFrame, right: DataFrame, by, left_at: str, right_at: str, values,
              order=(), inclusive: bool = True, grain: str = "day") -> DataFrame:
    """Every row of ``left`` with ``values`` of the last row of ``right`` of the
    same ``by`` at or before it (before it, unless ``inclusive``).

    No pairs are made.  Both sides become one tagged table; within (key, slice
    of time) a running maximum carries the last right row forward, and one row
    per (key, slice) carries it between slices.  So a hot key is spread over its
    days (or hours), and the window over a key holds one row per slice.

    Right rows at the same time are ordered by ``order`` and then by the values,
    the largest is last.  Left rows without a key or time, or without an earlier
    right row, keep null values; right rows without a key or time are never
    found.  ``values`` must not be column names of ``left``.
    """
    by, values, order = as_list(by), as_list(values), as_list(order)
    clash = set(values) & set(left.columns)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    known = _known([*by, left_at])
    last = F.struct(F.col(right_at).alias("at"),
                    *[F.col(c).alias(f"o{i}") for i, c in enumerate(order)],
                    *[F.col(c).alias(f"v{i}") for i, c in enumerate(values)])
    found = (right.where(_known([*by, right_at]))
             .select(*by, F.col(right_at).alias("_at"), _slice(right_at, grain).alias("_slice"),
                     last.alias("_last")))
    asked = left.where(known).withColumn("_at", F.col(left_at)).withColumn(
        "_slice", _slice(left_at, grain))

    # Between slices: one row per (key, slice) of either side.
    per = (found.groupBy(*by, "_slice").agg(F.max("_last").alias("_last"))
           .unionByName(asked.select(*by, "_slice").distinct(), allowMissingColumns=True)
           .groupBy(*by, "_slice").agg(F.max("_last").alias("_last")))
    before = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = per.select(*by, "_slice", F.max("_last").over(before).alias("_carried"))

    # Within a slice: right rows come before (after) left rows of the same time.
    rank = 0 if inclusive else 2
    tagged = (asked.withColumn("_tag", F.lit(1))
              .unionByName(found.withColumn("_tag", F.lit(rank)), allowMissingColumns=True))
    running = (Window.partitionBy(*by, "_slice").orderBy("_at", "_tag")
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    own = tagged.withColumn("_own", F.max("_last").over(running)).where("_tag = 1")
    picked = (own.join(carried, [*by, "_slice"], "left")
              .withColumn("_pick", F.coalesce("_own", "_carried")))
    out = picked.select(*left.columns, *[F.col(f"_pick.v{i}").alias(c)
                                         for i, c in enumerate(values)])
    rest = left.where(~known).select("*", *[
        F.lit(None).cast(right.schema[c].dataType).alias(c) for c in values])
    return out.unionByName(rest)
