"""The conformed ``sales`` fact and the ``orders`` activity table.

``sales`` is one row per order line (SURVEY 1.1):

    order_id bigint, customer_id bigint, order_date date, category string,
    subcategory string, region string, revenue decimal(18,4)

Plan shape (checked with ``explain``): each scan reads only the columns
used; revenue is computed before the first shuffle so lines travel as three
narrow columns; nation and region (25 and 5 rows by definition) are joined
into one small ``geo`` table first, which AQE broadcasts because its
measured size is tiny.  The big joins (lines x part, lines x orders,
orders x customer) stay sort-merge joins at scale; AQE splits a skewed key
(one hot part or customer) into several tasks.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import line_revenue, money_sum

SALES_COLUMNS = ("order_id", "customer_id", "order_date", "category", "subcategory",
                 "region", "revenue")


def _ts(value) -> F.Column:
    """A date bound as a TIMESTAMP_NTZ literal, comparable with the raw column.

    Built from text, not from a Python ``datetime``: PySpark converts a
    ``datetime`` through the driver process's local time zone, which need
    not be the session's, and the bound would shift.
    """
    if isinstance(value, str):
        value = _dt.date.fromisoformat(value)
    return F.lit(f"{value.isoformat()} 00:00:00").cast("timestamp_ntz")


def _orders_in_range(orders: DataFrame, start=None, end=None) -> DataFrame:
    """Orders with ``start <= date < end``, filtered on the raw column.

    Filtering on the stored ``o_orderdate`` (not on a derived date) is what
    lets the bound reach the Parquet scan as a pushed filter.
    """
    if start is not None:
        orders = orders.filter(F.col("o_orderdate") >= _ts(start))
    if end is not None:
        orders = orders.filter(F.col("o_orderdate") < _ts(end))
    return orders


def geo(tables: Mapping[str, DataFrame]) -> DataFrame:
    """nation_key -> region name (at most one row per nation)."""
    nation = tables["nation"].select("n_nationkey", "n_regionkey")
    region = tables["region"].select("r_regionkey", F.col("r_name").alias("region"))
    return (nation.join(region, nation.n_regionkey == region.r_regionkey)
            .select(F.col("n_nationkey").alias("nation_key"), "region"))


def customer_region(tables: Mapping[str, DataFrame]) -> DataFrame:
    """customer_id -> region."""
    cust = tables["customer"].select(F.col("c_custkey").alias("customer_id"),
                                     F.col("c_nationkey").alias("nation_key"))
    return cust.join(geo(tables), "nation_key").select("customer_id", "region")


def orders(tables: Mapping[str, DataFrame], start=None, end=None) -> DataFrame:
    """All orders as (order_id, customer_id, order_date).

    Cohort measures use this table: placing an order is the activity, with
    or without lines.
    """
    o = _orders_in_range(tables["orders"], start, end)
    return o.select(F.col("o_orderkey").alias("order_id"),
                    F.col("o_custkey").alias("customer_id"),
                    F.col("o_orderdate").cast("date").alias("order_date"))


def sales(tables: Mapping[str, DataFrame], start=None, end=None) -> DataFrame:
    """The ``sales`` fact, optionally limited to orders in ``[start, end)``.

    Inner joins throughout: a line counts only when its order, part,
    customer, nation and region all exist.  Money measures use this fact, so
    orders without lines do not count.
    """
    return (product_lines(tables)
            .join(region_orders(tables, start, end), "order_id")
            .select(*SALES_COLUMNS))


def product_lines(tables: Mapping[str, DataFrame], *extra: str) -> DataFrame:
    """Lines with their product: order_id, revenue, category, subcategory and the
    ``extra`` columns of ``lineitem``."""
    lines = tables["lineitem"].select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("part_id"),
        line_revenue("l_extendedprice", "l_discount").alias("revenue"), *extra)
    product = tables["part"].select(F.col("p_partkey").alias("part_id"),
                                    F.col("p_type").alias("category"),
                                    F.col("p_brand").alias("subcategory"))
    return lines.join(product, "part_id").drop("part_id")


def region_orders(tables: Mapping[str, DataFrame], start=None, end=None) -> DataFrame:
    """Orders with their customer's region."""
    return orders(tables, start, end).join(customer_region(tables), "customer_id")


def first_category(sales_df: DataFrame) -> DataFrame:
    """customer_id, category: the category that brought the most revenue in the
    customer's first order of the fact (ties: the smaller order, then name).

    Two hash aggregates with a partial step; no customer's orders meet in a task.
    """
    per = (sales_df.where("customer_id IS NOT NULL AND order_date IS NOT NULL")
           .groupBy("customer_id", "order_date", "order_id", "category")
           .agg(money_sum("revenue").alias("revenue")))
    first = F.min(F.struct("order_date", "order_id", (-F.col("revenue")).alias("less"), "category"))
    return per.groupBy("customer_id").agg(first.alias("f")).select("customer_id", "f.category")


def cohort_orders(tables: Mapping[str, DataFrame], regions=None, categories=None) -> DataFrame:
    """The orders of the customers of ``regions`` whose first category is one of
    ``categories`` (all their orders: a cohort is a slice of customers)."""
    found = orders(tables)
    if regions is not None:
        own = customer_region(tables).where(F.col("region").isin(list(regions)))
        found = found.join(own.select("customer_id"), "customer_id", "left_semi")
    if categories is not None:
        own = first_category(sales(tables)).where(F.col("category").isin(list(categories)))
        found = found.join(own.select("customer_id"), "customer_id", "left_semi")
    return found.select("order_id", "customer_id", "order_date")


def order_grain(sales_df: DataFrame, keys=("order_id",)) -> DataFrame:
    """Collapse the fact to one row per order (plus any extra ``keys``).

    The aggregate runs with a map-side partial step, so a huge order never
    lands whole in one task.  ``keys`` must include ``order_id``.
    """
    keys = list(dict.fromkeys(["order_id", *keys]))
    return sales_df.groupBy(*keys).agg(money_sum("revenue").alias("revenue"))
