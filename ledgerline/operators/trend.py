"""Sales trends (TRD-1 ... TRD-8).

Every function takes and returns plain DataFrames.  ``trend`` aggregates the
line-level fact; the others work on its output, which has one row per
(period, group) and is therefore small (bounded by the calendar times the
number of groups), so windows over it are cheap even without a partition key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import TOTAL, money_sum, period_start, period_step, ratio
from ._util import as_list


def trend(sales: DataFrame, grain: str = "month", by=None, date_col: str = "order_date",
          amount_col: str = "revenue", order_col: str = "order_id",
          complete_only: bool = False) -> DataFrame:
    """TRD-1/2/3/4: revenue and distinct orders per period (and group).

    Output: ``period`` (date), the ``by`` columns, ``revenue`` (decimal),
    ``orders`` (bigint).  For ``count(DISTINCT order_id)`` Spark plans two
    hash aggregates, both with map-side partial aggregation: first to (period,
    group, order), then to (period, group).  The order-level step is not in the
    plan where a caller reads no ``orders``.

    ``complete_only`` drops periods that end after the last day with data
    (a partial last month would otherwise look like a collapse).  The last
    day comes from the aggregated periods, through a scalar subquery.
    """
    by = as_list(by)
    out = (sales.groupBy(period_start(date_col, grain).alias("period"), *by)
           .agg(money_sum(amount_col).alias("revenue"),
                F.count_distinct(order_col).alias("orders"), F.max(date_col).alias("_day")))
    if complete_only:
        # The last day, from the same aggregated periods.  The subquery reads
        # every measure, and the filter one of them (never above the maximum)
        # within a coalesce, so that neither it nor a null check is pushed
        # below the aggregate: both sides then need the same shuffle, and
        # Spark runs that once.
        last_day = out.select(F.max(F.struct("_day", "revenue", "orders")).getField("_day")).scalar()
        last_day = F.greatest(last_day, F.col("_day"))
        period_end = F.date_sub(F.col("period") + period_step(grain), 1)
        out = out.filter(F.coalesce(period_end <= last_day, F.lit(False)))
    return out.drop("_day")


def fill_calendar(trend_df: DataFrame, grain: str = "month", by=None,
                  period_col: str = "period", zero_cols=("revenue", "orders")) -> DataFrame:
    """TRD-5: one row per period from the first to the last period, per group.

    Periods without sales get 0 in ``zero_cols`` (other measures stay null).
    Rows whose period is null are left out.
    No join and no cross join: each group's rows are folded into one map
    (period -> measures; at most one entry per calendar period), and
    ``sequence`` + ``explode`` lays the calendar out again.  Without ``by``
    the one row has the first and last period itself; with it they come from
    a scalar subquery over the per-group rows.
    """
    by = as_list(by)
    step = period_step(grain)
    measures = [c for c in trend_df.columns if c not in by and c != period_col]
    # Rows without a period cannot be placed on a calendar (and a map key
    # cannot be null): collect_list skips the nulls produced here.
    entry = F.when(F.col(period_col).isNotNull(),
                   F.struct(F.col(period_col), F.struct(*measures)))
    per_group = trend_df.groupBy(*by).agg(
        F.map_from_entries(F.collect_list(entry)).alias("_cells"),
        F.min(period_col).alias("_lo"), F.max(period_col).alias("_hi"))
    if by:
        # A global aggregate over the per-group table, so any number of groups
        # works.  It reads the cells too: a subquery that needs fewer columns
        # than the main query has a shuffle of its own, and Spark would
        # compute the whole input twice.
        has = F.size("_cells") >= 0
        bounds = per_group.select(F.struct(F.min(F.when(has, F.col("_lo"))).alias("lo"),
                                           F.max(F.when(has, F.col("_hi"))).alias("hi"))).scalar()
        lo, hi = bounds.getField("lo"), bounds.getField("hi")
    else:
        lo, hi = F.col("_lo"), F.col("_hi")
    grid = per_group.select(*by, "_cells",
                            F.explode(F.sequence(lo, hi, step)).alias(period_col))
    cell = F.try_element_at("_cells", F.col(period_col))
    out = []
    for c in measures:
        v = cell.getField(c)
        if c in zero_cols:
            v = F.coalesce(v, F.lit(0).cast(trend_df.schema[c].dataType))
        out.append(v.alias(c))
    return grid.select(*by, period_col, *out).select(*trend_df.columns)


def _ordered(by, period_col):
    by = as_list(by)
    w = Window.partitionBy(*by) if by else Window.partitionBy()
    return w.orderBy(period_col)


def growth(trend_df: DataFrame, by=None, period_col: str = "period",
           value_col: str = "revenue") -> DataFrame:
    """TRD-6: period-over-period growth of ``value_col``.

    Adds ``prev_<value>`` (previous row's value within the group) and
    ``growth`` = (value - prev) / prev as double; null for the first period
    or a zero base.  Run it on a ``fill_calendar`` output so that "previous
    row" is the previous calendar period.
    """
    w = _ordered(by, period_col)
    prev = F.lag(value_col).over(w)
    return (trend_df.withColumn(f"prev_{value_col}", prev)
            .withColumn("growth", ratio(F.col(value_col) - F.col(f"prev_{value_col}"),
                                        F.col(f"prev_{value_col}"))))


def ytd(trend_df: DataFrame, by=None, period_col: str = "period",
        value_col: str = "revenue") -> DataFrame:
    """TRD-7: running total of ``value_col`` within each calendar year."""
    by = as_list(by)
    w = (Window.partitionBy(*by, F.year(period_col)).orderBy(period_col)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return trend_df.withColumn(f"ytd_{value_col}", F.sum(value_col).over(w).cast(TOTAL))


def moving_avg(trend_df: DataFrame, n: int = 3, by=None, period_col: str = "period",
               value_col: str = "revenue") -> DataFrame:
    """TRD-8: trailing average over the current and ``n - 1`` previous rows.

    Sum and count over the frame, divided once, so the double result is the
    same whatever engine or partitioning computes it.  The first rows
    average over fewer periods.
    """
    if n < 1:
        raise ValueError("n must be >= 1")
    w = _ordered(by, period_col).rowsBetween(-(n - 1), Window.currentRow)
    return trend_df.withColumn("moving_avg", ratio(F.sum(value_col).over(w),
                                                   F.count(value_col).over(w)))
