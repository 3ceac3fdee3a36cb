"""Customer cohorts, retention and repeat purchases (COH-1 ... COH-11).

Input is an orders table with ``customer_id``, ``order_id`` and
``order_date`` (a ``date``); all orders count, with or without lines.

Skew: nothing here puts a customer's orders into one task.  Per-customer
state is built with hash aggregates (map-side partial aggregation), and the
only per-customer collections are sets of *months* or *days*, bounded by
the calendar, not by the number of orders.  Windows run on aggregated
tables (cohort x index cells, customer x day counts).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import month_index, period_start, ratio
from ..plans.ranking import day_row_number


def _known(orders: DataFrame, customer_col: str, date_col: str = "order_date") -> DataFrame:
    """Orders with a customer and a date; any other order belongs to no cohort."""
    return orders.filter(F.col(customer_col).isNotNull() & F.col(date_col).isNotNull())


def assign_cohort(orders: DataFrame, customer_col: str = "customer_id",
                  date_col: str = "order_date") -> DataFrame:
    """COH-1: one row per customer: ``cohort`` = month of the first order."""
    return (_known(orders, customer_col, date_col).groupBy(customer_col)
            .agg(period_start(F.min(date_col), "month").alias("cohort")))


def cohort_size(orders: DataFrame, customer_col: str = "customer_id",
                date_col: str = "order_date") -> DataFrame:
    """COH-3: customers per cohort (``cohort``, ``customers``)."""
    return (assign_cohort(orders, customer_col, date_col)
            .groupBy("cohort").agg(F.count(F.lit(1)).alias("customers")))


def _cohorts(orders, customer_col, date_col, complete_only=False) -> DataFrame:
    """One row per cohort: ``cohort``, ``_cells`` (month index -> active
    customers), ``cohort_size``, ``_last`` (last month of the window).

    The window ends with the last month that has an order or, with
    ``complete_only``, the last month that the data cover to its last day:
    the cells of a partial month, and a cohort that begins in it, are left
    out.

    Plan: (1) per customer, the set of active months (hash aggregate; the
    set holds at most one entry per calendar month); (2) explode to
    (cohort, month index) and count (partial aggregation leaves one row per
    cell per task before the shuffle); (3) per cohort, a map of its cells.
    The table is one row per cohort month, so the global last month is a
    window over it, not a second scan of the orders.
    """
    months = (_known(orders, customer_col, date_col).groupBy(customer_col)
              .agg(F.collect_set(period_start(date_col, "month")).alias("_months"),
                   F.max(date_col).alias("_day")))
    cells = (months.select(F.array_min("_months").alias("cohort"), "_day",
                           F.explode("_months").alias("_month"))
             .groupBy("cohort", month_index("cohort", "_month").alias("month_index"))
             .agg(F.count(F.lit(1)).alias("customers"), F.max("_day").alias("_day")))
    per = (cells.groupBy("cohort")
           .agg(F.map_from_entries(F.collect_list(F.struct("month_index", "customers")))
                .alias("_cells"),
                F.max("_day").alias("_day")))
    # One row per cohort month, so windows over all of it are bounded.
    day = F.max("_day").over(Window.partitionBy())
    last = F.trunc(day, "month")
    if complete_only:
        last = F.when(F.last_day(day) == day, last).otherwise(F.add_months(last, -1))
    out = (per.withColumn("cohort_size", F.try_element_at("_cells", F.lit(0)))
           .withColumn("_last", last).drop("_day"))
    if complete_only:
        top = month_index("cohort", "_last")
        out = (out.filter(F.col("cohort") <= F.col("_last"))
               .withColumn("_cells", F.map_filter("_cells", lambda i, _: i <= top)))
    return out


def cohort_long(orders: DataFrame, dense: bool = False, customer_col: str = "customer_id",
                date_col: str = "order_date", complete_only: bool = False) -> DataFrame:
    """COH-2/4/6: retention per (cohort, month index), long form.

    Columns: ``cohort`` (date), ``month_index`` (int, 0 = cohort month),
    ``customers`` (active customers), ``cohort_size``, ``retention``
    (customers / cohort_size).  Index 0 is always 1.0.

    ``dense=False`` returns observed cells only.  ``dense=True`` adds a zero
    row for every index up to the last month in the data (cells inside the
    observation window with no active customer); cells after the last month
    are unknown and have no row.  ``complete_only`` ends the window with the
    last month that the data cover to its end.
    """
    per = _cohorts(orders, customer_col, date_col, complete_only)
    if dense:
        idx = F.sequence(F.lit(0), month_index("cohort", "_last"))
    else:
        idx = F.array_sort(F.map_keys("_cells"))
    out = per.select("cohort", "cohort_size", "_cells", F.explode(idx).alias("month_index"))
    customers = F.coalesce(F.try_element_at("_cells", F.col("month_index")),
                           F.lit(0).cast("bigint"))
    return (out.withColumn("customers", customers)
            .withColumn("retention", ratio("customers", "cohort_size"))
            .select("cohort", "month_index", "customers", "cohort_size", "retention"))


def cohort_matrix(orders: DataFrame, max_idx: int | None = None, indexes=None,
                  customer_col: str = "customer_id", date_col: str = "order_date",
                  complete_only: bool = False) -> DataFrame:
    """COH-5: retention matrix, one row per cohort, one column per index.

    Columns ``cohort``, ``cohort_size`` and ``m<i>`` for each index in
    ``indexes`` or 0..``max_idx``; by default all the months of the data, for
    which the first and last order date are read when the plan is built.  A
    cell inside the observation window with no activity is 0.0; a cell after
    the last data month is null (unknown).  Each cohort row already holds its
    cells as a map, so the wide form is a projection: no pivot shuffle.
    ``complete_only`` ends the window with the last month that the data cover
    to its end.
    """
    if indexes is None:
        if max_idx is None:
            max_idx = _horizon(orders, customer_col, date_col, complete_only)
        indexes = range(max_idx + 1)
    indexes = [int(i) for i in indexes]
    per = _cohorts(orders, customer_col, date_col, complete_only)
    horizon = month_index("cohort", "_last")

    def cell(i: int):
        n = F.coalesce(F.try_element_at("_cells", F.lit(i)), F.lit(0).cast("bigint"))
        return F.when(F.lit(i) <= horizon, ratio(n, "cohort_size")).alias(f"m{i}")

    return per.select("cohort", "cohort_size", *[cell(i) for i in indexes])


def _horizon(orders, customer_col, date_col, complete_only) -> int:
    """Months from the first to the last (complete) month with an order; -1 if
    there is none."""
    first, last = (_known(orders, customer_col, date_col)
                   .agg(F.min(date_col), F.max(date_col)).first())
    if first is None:
        return -1
    months = (last.year - first.year) * 12 + last.month - first.month
    if complete_only and (last + _dt.timedelta(days=1)).day != 1:
        months -= 1
    return months


def retention_curve(orders: DataFrame, customer_col: str = "customer_id",
                    date_col: str = "order_date", complete_only: bool = False) -> DataFrame:
    """COH-11: retention by month index across all cohorts.

    For index i, ``retained`` sums active customers and ``eligible`` sums the
    sizes of cohorts old enough to have an index i (right-censored cohorts
    are left out, not counted as zero).  ``retention`` = retained / eligible.
    Without ``complete_only`` the tail of the curve is of a partial month.
    """
    long = cohort_long(orders, dense=True, customer_col=customer_col, date_col=date_col,
                       complete_only=complete_only)
    return (long.groupBy("month_index")
            .agg(F.sum("customers").alias("retained"), F.sum("cohort_size").alias("eligible"),
                 F.count(F.lit(1)).alias("cohorts"))
            .withColumn("retention", ratio("retained", "eligible")))


def repeat_rate(orders: DataFrame, customer_col: str = "customer_id",
                order_col: str = "order_id", date_col: str = "order_date") -> DataFrame:
    """COH-7: share of ordering customers with two or more orders (one row)."""
    per_customer = (_known(orders, customer_col, date_col).groupBy(customer_col)
                    .agg(F.count_distinct(order_col).alias("_n")))
    return (per_customer.agg(F.count(F.lit(1)).alias("customers"),
                             F.count(F.when(F.col("_n") >= 2, True)).alias("repeat_customers"))
            .withColumn("repeat_rate", ratio("repeat_customers", "customers")))


def order_seq(orders: DataFrame, customer_col: str = "customer_id",
              date_col: str = "order_date", order_col: str = "order_id") -> DataFrame:
    """COH-8: ``order_seq`` = 1 for a customer's first order, 2 for the next...

    Ordered by date, then order id, then the other columns.  Numbered per
    customer and day and shifted by the customer's earlier days
    (``day_row_number``), so a customer with a huge share of all orders is
    numbered by several tasks.
    """
    return day_row_number(_known(orders, customer_col, date_col), [customer_col], date_col,
                          [order_col], out="order_seq")


def new_vs_returning(orders: DataFrame, customer_col: str = "customer_id",
                     date_col: str = "order_date") -> DataFrame:
    """COH-9: per month, orders that are a customer's first vs the rest.

    A customer has exactly one first order, in the cohort month, so new
    orders per month equal the number of customers whose first active month
    it is: no per-order ranking is needed.  One scan: orders are counted per
    (customer, month) (map-side combined), the cohort month is a window over
    that table (at most one row per calendar month per customer), then
    summed per month.  Columns: ``period``, ``orders``, ``new_orders``,
    ``returning_orders``.
    """
    per = (_known(orders, customer_col, date_col)
           .groupBy(customer_col, period_start(date_col, "month").alias("period"))
           .agg(F.count(F.lit(1)).alias("_n")))
    first = F.min("period").over(Window.partitionBy(customer_col))
    return (per.withColumn("_first", first)
            .groupBy("period")
            .agg(F.sum("_n").alias("orders"),
                 F.count(F.when(F.col("period") == F.col("_first"), True)).alias("new_orders"))
            .withColumn("returning_orders", F.col("orders") - F.col("new_orders")))


def order_gaps(orders: DataFrame, customer_col: str = "customer_id",
               date_col: str = "order_date") -> DataFrame:
    """COH-10: histogram of days between a customer's consecutive orders.

    Orders are first counted per (customer, day): ``n`` orders on one day
    give ``n - 1`` gaps of 0 days, and the gap from the previous active day
    comes from ``lag`` over that per-day table (at most one row per calendar
    day per customer).  Columns: ``gap_days`` (int), ``occurrences``.
    """
    per_day = (_known(orders, customer_col, date_col).groupBy(customer_col, date_col)
               .agg(F.count(F.lit(1)).alias("_n")))
    w = Window.partitionBy(customer_col).orderBy(date_col)
    gaps = per_day.withColumn("_gap", F.datediff(F.col(date_col), F.lag(date_col).over(w)))
    events = gaps.select(F.explode(F.array(
        F.struct(F.col("_gap").alias("gap_days"), F.lit(1).cast("bigint").alias("w")),
        F.struct(F.lit(0).alias("gap_days"), (F.col("_n") - 1).alias("w")))).alias("e"))
    return (events.filter(F.col("e.gap_days").isNotNull() & (F.col("e.w") > 0))
            .groupBy(F.col("e.gap_days").cast("int").alias("gap_days"))
            .agg(F.sum("e.w").cast("bigint").alias("occurrences")))
