"""Insights (INS-1 ... INS-4): category ranking, Pareto share, seasonality, spikes.

Ranking and Pareto shares work for any number of groups, however many of them are
tied: slices of distinct values or written ranges, plus offsets, never a window
over the whole table.  Seasonality and spikes work on one row per month and group
of a filled calendar.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import TOTAL, ratio
from ..plans.ranking import running_total, slices_before, value_slice
from ._util import as_list, join_null_safe
from .kpi import breakdown
from .trend import fill_calendar


def rank_categories(sales: DataFrame, by="category") -> DataFrame:
    """INS-1: ``by`` groups ranked by revenue (1 = highest; ties share a rank).

    rank = 1 + number of groups with more revenue, counted over the *distinct*
    revenues: those above it within its slice of revenues (``value_slice``), plus
    the groups in higher slices.  Any number of groups with one revenue is one
    row there, and AQE can split them where they meet their rank.
    """
    by = as_list(by)
    agg = breakdown(sales, by).select(*by, "revenue")
    distinct = (agg.groupBy("revenue").agg(F.count(F.lit(1)).alias("_groups"))
                .withColumn("_slice", value_slice("revenue")))
    above = (Window.partitionBy("_slice").orderBy(F.col("revenue").desc())
             .rowsBetween(Window.unboundedPreceding, -1))
    local = F.coalesce(F.sum("_groups").over(above), F.lit(0))
    ranked = (join_null_safe(distinct.withColumn("_local", local),
                             slices_before(distinct, rows_col="_groups"), ["_slice"])
              .select("revenue", (F.col("_rows_before") + F.col("_local") + 1).cast("int")
                      .alias("rank")))
    return join_null_safe(agg, ranked, ["revenue"]).select(*by, "revenue", "rank")


def pareto(sales: DataFrame, by="category", cutoff: float = 0.8) -> DataFrame:
    """INS-2: cumulative revenue share, largest first; flag the core groups.

    A group is *core* when the groups ranked above it hold less than
    ``cutoff`` of revenue, i.e. the core is the smallest top set reaching
    the cutoff.  The test is done on exact decimals; ``share`` and
    ``cum_share`` are reported as doubles.  Ties are ordered by name.

    The groups are written once, in ranges of (revenue, name), so the fact is
    read once and groups of equal revenue are spread like all others; the
    running total of a range is shifted by the totals of the ranges before it.
    """
    by = as_list(by)
    agg = breakdown(sales, by).select(*by, "revenue")
    order = [F.col("revenue").desc(), *[F.col(c).asc() for c in by]]
    out = running_total(agg, order, "revenue", "pareto")
    cut = F.lit(Decimal(str(cutoff)))
    return (out.withColumn("share", ratio("revenue", "_sum_all"))
            .withColumn("cum_share", ratio("_running", "_sum_all"))
            .withColumn("is_core",
                        (F.col("_running") - F.col("revenue")) < F.col("_sum_all") * cut)
            .select(*by, "revenue", "share", "cum_share", "is_core"))


def seasonality(monthly: DataFrame, period_col: str = "period", value_col: str = "revenue",
                complete_only: bool = True, by=None) -> DataFrame:
    """INS-3: month-of-year index = revenue of that calendar month / mean month.

    Input: a monthly trend (one row per month, per ``by`` group if given).
    The calendar is filled first, so a month in which a group sold nothing
    counts as zero.  With ``complete_only``, only years whose 12 months all lie
    between the first and the last month of the whole table count, for every
    group alike.  index = 12 * sum(month m) / sum(all months), one division of
    exact sums; 1.0 is an average month.  Columns: the ``by`` columns,
    ``month_of_year`` (int), ``revenue``, ``years``, ``seasonality_index``.
    """
    by = as_list(by)
    filled = fill_calendar(monthly.select(*by, period_col, value_col), "month", by=by,
                           period_col=period_col, zero_cols=(value_col,))
    m = filled.select(*by, F.year(period_col).alias("_year"), F.month(period_col).alias("_moy"),
                      F.col(value_col).alias("_v"))
    if complete_only:
        # A filled group has a row for every month of the calendar.
        k = F.count(F.lit(1)).over(Window.partitionBy(*by, "_year"))
        m = m.withColumn("_k", k).filter(F.col("_k") == 12).drop("_k")
    per = m.groupBy(*by, F.col("_moy").cast("int").alias("month_of_year")).agg(
        F.sum("_v").cast(TOTAL).alias("revenue"), F.count(F.lit(1)).alias("years"))
    total = Window.partitionBy(*by)
    return per.withColumn(
        "seasonality_index",
        ratio(F.col("revenue") * F.lit(12), F.sum("revenue").over(total)))


def spikes(monthly: DataFrame, ratio_threshold: float = 1.1, window: int = 12,
           period_col: str = "period", value_col: str = "revenue", by=None) -> DataFrame:
    """INS-4: months whose revenue exceeds ``ratio_threshold`` x the trailing mean.

    The trailing mean covers the ``window`` rows before the current one
    (per ``by`` group); a month is flagged only when the full window exists.
    Fill the calendar first if months can be missing, so rows are months.
    Rows without a period are not part of the series and are left out.
    The comparison ``value * n > trailing_sum * ratio`` is done in exact
    decimals.  Columns: the ``by`` columns, ``period``, ``revenue``,
    ``trailing_avg`` (double), ``is_spike``.
    """
    by = as_list(by)
    w = Window.partitionBy(*by).orderBy(period_col).rowsBetween(-window, -1)
    thr = F.lit(Decimal(str(ratio_threshold)))
    out = (monthly.filter(F.col(period_col).isNotNull())
           .select(*by, period_col, value_col)
           .withColumn("_sum", F.sum(value_col).over(w))
           .withColumn("_n", F.count(value_col).over(w)))
    return (out.withColumn("trailing_avg", ratio("_sum", "_n"))
            .withColumn("is_spike", (F.col("_n") == window)
                        & (F.col(value_col) * F.col("_n") > F.col("_sum") * thr))
            .drop("_sum", "_n"))
