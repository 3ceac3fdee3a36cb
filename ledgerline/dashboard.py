"""The dashboard's result tables in one call.

The dashboard shows total revenue, orders and average order value;
category- and region-wise performance; the cohort retention matrix; and
time-based sales trends.  ``dashboard`` returns one DataFrame per visual and
``publish`` (SNK-2) writes them.

At scale the expensive part is the five-way join that builds the sales fact;
every money visual needs it.  With ``materialize`` the fact is written once
(month-partitioned Parquet under the session's checkpoint folder, SNK-1) and
each visual reads that table: a scan and an aggregate each, no joins.  The
written table also cuts the lineage, so a lost executor never sends a visual
back to the raw tables.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from .operators import cohort as coh
from .operators import kpi
from .operators import trend as trd
from .plans import sales as model
from .session import drop_scratch, scratch_path
from .sources import publish, read_clean, write_clean


def materialized_sales(spark: SparkSession, tables: Mapping[str, DataFrame],
                       path: str | None = None, start=None, end=None) -> DataFrame:
    """Write the sales fact once (month-partitioned) and return a reader of it."""
    path = path or scratch_path(spark, "sales_fact")
    written = write_clean(model.sales(tables, start, end), path)
    return read_clean(spark, path, schema=written)


class Visuals(dict):
    """Visual name -> DataFrame.  ``close`` removes the scratch copy of the fact
    that the DataFrames read (none if the caller gave a path for it)."""

    def __init__(self, spark: SparkSession, scratch: str | None):
        super().__init__()
        self._spark, self.scratch = spark, scratch

    def close(self) -> None:
        if self.scratch:
            drop_scratch(self._spark, self.scratch)
            self.scratch = None


def dashboard(spark: SparkSession, tables: Mapping[str, DataFrame],
              max_cohort_index: int | None = None, materialize: bool = True,
              out_path: str | None = None, fact_path: str | None = None, start=None, end=None,
              categories=None, regions=None, complete_only: bool = False) -> Visuals:
    """All dashboard visuals as DataFrames (written under ``out_path`` if given).

    Slicers (``start <= date < end``, ``categories``, ``regions``) apply to
    every visual of sales.  The cohort visuals are of the customers of the
    regions whose first category is in ``categories``, with all their orders:
    dates do not reach them, as a cut history would move customers to later
    cohorts.  With
    ``materialize`` the fact is written to ``fact_path``, which stays the
    caller's, or to a scratch folder that ``close()`` removes.  The cohort
    matrix is as wide as the data unless ``max_cohort_index`` is given;
    ``complete_only`` ends it and the curve with the last complete month.
    """
    scratch = scratch_path(spark, "sales_fact") if materialize and not fact_path else None
    if materialize:
        fact = materialized_sales(spark, tables, fact_path or scratch, start, end)
    else:
        fact = model.sales(tables, start, end)
    fact = kpi.slice_sales(fact, start, end, categories, regions)
    orders = model.cohort_orders(tables, regions, categories)
    monthly = trd.trend(fact, "month")
    visuals = Visuals(spark, scratch)
    visuals.update({
        "kpis": kpi.kpis(fact),
        "sales_by_category": kpi.breakdown(fact, ["category"]),
        "sales_by_region": kpi.breakdown(fact, ["region"]),
        "category_region": kpi.breakdown(fact, ["category", "region"], totals=True),
        "trend_daily": trd.fill_calendar(trd.trend(fact, "day"), "day"),
        "trend_monthly": trd.growth(trd.fill_calendar(monthly, "month")),
        "trend_category": trd.fill_calendar(trd.trend(fact, "month", by="category"), "month",
                                            by="category"),
        "cohort_matrix": coh.cohort_matrix(orders, max_idx=max_cohort_index,
                                           complete_only=complete_only),
        "retention_curve": coh.retention_curve(orders, complete_only=complete_only),
    })
    if out_path:
        publish(visuals, out_path)
    return visuals
