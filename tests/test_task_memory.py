"""Memory of a task: rows per order are kept only where orders are counted, and
reports keep the shuffle partitions of their joins small."""

import re

import pytest
from conftest import SF_SMALL, M, rows

from ledgerline import reports
from ledgerline.operators import insight as ins
from ledgerline.operators import kpi
from ledgerline.operators import trend as trd
from ledgerline.session import set_defaults

ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def per_order(df) -> bool:
    """Does an aggregate of the plan have the order among its keys?"""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return bool(re.search(r"Aggregate\(keys=\[[^\]]*order_id", plan))


@pytest.mark.parametrize("name", ["seasonality_by_brand", "seasonality_by_category",
                                  "spikes_by_category", "pareto_brand", "pareto_category",
                                  "category_rank", "breakdown_top_categories"])
def test_revenue_alone_needs_no_row_per_order(spark, name):
    assert not per_order(reports.REPORTS[name](spark, SF_SMALL))


@pytest.mark.parametrize("name", ["breakdown_category", "trend_category_monthly",
                                  "trend_category_filled"])
def test_orders_are_still_counted_by_order(spark, name):
    assert per_order(reports.REPORTS[name](spark, SF_SMALL))


def test_orders_repeat_or_are_null(make_sales):
    s = make_sales([(1, 1, "2020-01-05", "A", "x", "EU", "1"), (1, 1, "2020-01-05", "A", "x", "EU", "2"),
                    (None, 1, "2020-01-06", "A", "x", "EU", "4"), (2, 1, "2020-01-06", None, "x", "EU", "8")])
    assert rows(kpi.breakdown(s, "category"), "category", "revenue", "orders") == [
        ("A", M("7.0000"), 1), (None, M("8.0000"), 1)]
    assert [tuple(r)[1:] for r in trd.trend(s, "month").collect()] == [(M("15.0000"), 2)]
    assert rows(ins.rank_categories(s), "category", "rank") == [("A", 2), (None, 1)]


@pytest.mark.parametrize("name", ["breakdown_rollup", "breakdown_category", "cohort_dense_sliced",
                                  "dashboard_sliced_trend", "dashboard_sliced_retention",
                                  "trend_category_monthly", "trend_category_filled"])
def test_a_report_sets_the_partition_size_it_relies_on(spark, name):
    old = spark.conf.get(ADVISORY, None)
    try:
        spark.conf.unset(ADVISORY)
        reports.REPORTS[name](spark, SF_SMALL)
        assert spark.conf.get(ADVISORY) == "16m"
        spark.conf.set(ADVISORY, "5m")
        set_defaults(spark)
        assert spark.conf.get(ADVISORY) == "5m"
    finally:
        spark.conf.unset(ADVISORY) if old is None else spark.conf.set(ADVISORY, old)
