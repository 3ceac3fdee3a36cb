"""Every registered query against its DuckDB SQL, plus SURVEY 5.1 values."""

import pytest
from conftest import SF_CHECK, SF_SMALL, M

import __spark_entry__ as E
from ledgerline import reports, sql_checks
from tools.oracle_check import compare, duck

NAMES = sorted(reports.REPORTS)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_sql():
    assert set(sql_checks.SQL) == set(reports.REPORTS)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_duckdb(spark, con, name):
    df = reports.REPORTS[name](spark, SF_SMALL)
    res = con.execute(sql_checks.SQL[name])
    status, msg = compare([tuple(r) for r in df.collect()], df.columns,
                          res.fetchall(), [c[0] for c in res.description])
    assert status == "exact", msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["cohort", "cohort_size"]


def test_survey_values_at_sf001(spark):
    q = reports.REPORTS
    k = q["kpi_totals"](spark, SF_CHECK).collect()[0]
    assert (k["revenue"], k["orders"]) == (M("3024008727.8907"), 14743)
    s = q["kpi_sliced"](spark, SF_CHECK).collect()[0]
    assert (s["revenue"], s["orders"]) == (M("15832061.2200"), 234)
    by_cat = {r["category"]: r["revenue"] for r in q["breakdown_category"](spark, SF_CHECK).collect()}
    assert sum(by_cat.values()) == k["revenue"]
    by_reg = {r["region"]: r["revenue"] for r in q["breakdown_region"](spark, SF_CHECK).collect()}
    assert sum(by_reg.values()) == k["revenue"]
    assert q["trend_daily_filled"](spark, SF_CHECK).filter("orders = 0").count() == 6
    long = q["cohort_long"](spark, SF_CHECK)
    assert long.filter("month_index = 0 AND retention != 1.0").count() == 0
    assert long.filter("month_index = 0").groupBy().sum("customers").collect()[0][0] == 1500
    nvr = q["new_vs_returning"](spark, SF_CHECK).groupBy().sum("orders", "new_orders").collect()[0]
    assert (nvr[0], nvr[1]) == (15000, 1500)
    assert q["pareto_brand"](spark, SF_CHECK).filter("is_core").count() == 20
    rej = {r["reason"]: r["rows"] for r in q["clean_reject_reasons"](spark, SF_CHECK).collect()}
    assert rej == {"missing_customer": 155, "bad_date": 203, "bad_amount": 186,
                   "blank_priority": 173}


def test_slicer_bounds_ignore_time_zones(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Pacific/Kiritimati")   # UTC+14
    try:
        s = reports.REPORTS["kpi_sliced"](spark, SF_CHECK).collect()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert (s["revenue"], s["orders"]) == (M("15832061.2200"), 234)


@pytest.fixture
def far_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Pacific/Kiritimati")   # UTC+14
    yield spark
    spark.conf.set("spark.sql.session.timeZone", old)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_duckdb_in_another_time_zone(far_zone, con, name):
    df = reports.REPORTS[name](far_zone, SF_SMALL)
    res = con.execute(sql_checks.sql_for(name, df.columns))
    status, msg = compare([tuple(r) for r in df.collect()], df.columns,
                          res.fetchall(), [c[0] for c in res.description])
    assert status == "exact", msg
