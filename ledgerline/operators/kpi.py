"""Headline KPIs (KPI-1 ... KPI-4) and breakdowns (BRK-1 ... BRK-4)."""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import money_sum, ratio
from ._util import as_list


def _date(v):
    return _dt.date.fromisoformat(v) if isinstance(v, str) else v


def slice_sales(sales: DataFrame, start=None, end=None, categories=None, regions=None,
                date_col: str = "order_date") -> DataFrame:
    """KPI-4 slicers: ``start <= date < end``, category in ..., region in ...

    Filters are plain comparisons on fact columns, so Catalyst pushes them
    through the joins to the dimension scans.  For Parquet pushdown of the
    date bound, build the fact with ``plans.sales.sales(tables, start, end)``
    as well (the fact's date is derived, the stored column is a timestamp),
    or read a written fact with ``sources.read_clean(spark, path, start,
    end)``, which also prunes the month folders.
    """
    if start is not None:
        sales = sales.filter(F.col(date_col) >= F.lit(_date(start)))
    if end is not None:
        sales = sales.filter(F.col(date_col) < F.lit(_date(end)))
    if categories is not None:
        sales = sales.filter(F.col("category").isin(list(categories)))
    if regions is not None:
        sales = sales.filter(F.col("region").isin(list(regions)))
    return sales


def kpis(sales: DataFrame, start=None, end=None, categories=None, regions=None,
         order_col: str = "order_id", amount_col: str = "revenue") -> DataFrame:
    """KPI-1/2/3 (and 4 with slicers): one row of ``revenue``, ``orders``, ``aov``.

    ``aov`` = revenue / orders, one double division of the exact decimal
    total.  Order volume counts orders with at least one line in the slice.
    """
    s = slice_sales(sales, start, end, categories, regions)
    per_order = s.groupBy(order_col).agg(F.sum(amount_col).alias("_amount"))
    return (per_order.agg(money_sum("_amount").alias("revenue"),
                          F.count(order_col).alias("orders"))
            .withColumn("aov", ratio("revenue", "orders")))


def breakdown(sales: DataFrame, dims, totals: bool = False, order_col: str = "order_id",
              amount_col: str = "revenue") -> DataFrame:
    """BRK-1/2/3: revenue, distinct orders and AOV per combination of ``dims``.

    With ``totals`` the grouping is a rollup over ``dims`` (in the given
    order): subtotals carry null in the rolled-up columns and ``level`` is
    Spark's ``grouping_id`` (0 = finest cell, 2^n - 1 = grand total).  The
    grand total always exists, as in standard SQL, even for an empty
    selection.  Lines are first reduced to one row per (dims, order) so the rollup's row copies
    (one per level) apply to a smaller input.

    Without ``totals`` it is one aggregate, so Spark leaves the row per (dims,
    order) out of the plan where a caller reads no ``orders`` or ``aov``.
    """
    dims = as_list(dims)
    if totals:
        per_order = sales.groupBy(*dims, order_col).agg(F.sum(amount_col).alias("_amount"))
        top = (1 << len(dims)) - 1
        # One seed row without an order: a rollup over no rows returns nothing
        # in Spark, with it there is always a grand total.  Its other groups
        # are left out unless real rows are in them.
        seed = sales.sparkSession.range(1).select(*[
            F.lit(None).cast(f.dataType).alias(f.name) for f in per_order.schema],
            F.lit(None).cast("int").alias("_real"))
        rows = per_order.withColumn("_real", F.lit(1)).unionByName(seed)
        out = (rows.rollup(*dims)
               .agg(money_sum("_amount").alias("revenue"),
                    F.count_distinct(order_col).alias("orders"),
                    F.grouping_id().cast("int").alias("level"), F.count("_real").alias("_n"))
               .filter((F.col("_n") > 0) | (F.col("level") == top)).drop("_n"))
    else:
        out = (sales.groupBy(*dims)
               .agg(money_sum(amount_col).alias("revenue"),
                    F.count_distinct(order_col).alias("orders")))
    return out.withColumn("aov", ratio("revenue", "orders"))


def top_k(df: DataFrame, k: int, within=None, value_col: str = "revenue",
          tie_cols=None, buckets: int | None = None, keep_ties: bool = False) -> DataFrame:
    """BRK-4: the ``k`` rows with the largest ``value_col`` within each group.

    ``rank`` is 1-based.  By default it is a row number: ties are broken by
    ``tie_cols`` ascending, then by every other column that can be ordered,
    so exactly ``k`` rows per group come back, the same under any
    partitioning.  With ``keep_ties`` it is SQL's ``rank() <= k``: rows tied
    with the k-th all come back and share a rank.

    Two phases, so a group holding most of the rows never sits in one task:
    rows are salted into ``buckets`` by a hash of the tie columns and the
    top ``k`` is kept per (group, bucket); the final top ``k`` per group is
    then taken from at most ``k * buckets`` candidates.  Every true top-k
    row survives phase one (it is also top-k within its own bucket), so the
    result is exact.
    """
    within = as_list(within)
    ties = as_list(tie_cols)
    ties += [c for c in df.columns if c not in (*within, value_col, *ties)
             and not re.search("map<|variant", df.schema[c].dataType.simpleString())]
    order = [F.col(value_col).desc()]
    number = F.rank() if keep_ties else F.row_number()
    if not keep_ties:
        order += [F.col(c).asc() for c in ties]
    b = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in ties or [value_col]]), F.lit(b))
    w1 = Window.partitionBy(*within, "_bucket").orderBy(*order)
    candidates = (df.withColumn("_bucket", salt).withColumn("_r", number.over(w1))
                  .filter(F.col("_r") <= k).drop("_r", "_bucket"))
    w2 = Window.partitionBy(*within).orderBy(*order)
    return candidates.withColumn("rank", number.over(w2)).filter(F.col("rank") <= k)
