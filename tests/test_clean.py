import datetime as dt

from conftest import D, M, SF_SMALL, rows

from ledgerline.operators import clean as cln
from ledgerline.plans import dirty
from ledgerline.sources import load

RAW_DDL = "oid BIGINT, cid BIGINT, prio STRING, amt STRING, dt STRING"


def raw(spark, data):
    return spark.createDataFrame(data, RAW_DDL)


def test_standardise_cast_and_nulls(spark):
    df = raw(spark, [(1, 5, "  high ", " 12.50", "2020-01-02 "), (2, None, "", "x", "2020-02-30")])
    s = cln.cast_safe(cln.standardise_text(df, ["prio"]), {"amt": "decimal(12,2)", "dt": "date"})
    assert rows(s) == [(1, 5, "HIGH", M("12.50"), D("2020-01-02")), (2, None, None, None, None)]
    f = cln.handle_nulls(s, fill={"prio": "UNSPECIFIED", "amt": 0}, require=["cid"])
    assert rows(f) == [(1, 5, "HIGH", M("12.50"), D("2020-01-02"))]
    f = cln.handle_nulls(s, fill={"prio": "UNSPECIFIED"})
    assert rows(f, "oid", "prio") == [(1, "HIGH"), (2, "UNSPECIFIED")]


def test_dedup_exact_and_by_key(spark):
    df = raw(spark, [(1, 1, "A", "1", "2020-01-01"), (1, 1, "A", "1", "2020-01-01"),
                     (1, 2, "B", "2", "2020-01-03"), (2, 3, "C", "3", "2020-01-01")])
    assert cln.drop_exact_dups(df).count() == 3
    latest = cln.dedup_by_key(df, ["oid"], [("dt", "desc")])
    assert rows(latest, "oid", "cid") == [(1, 2), (2, 3)]
    first = cln.dedup_by_key(df, ["oid"], ["dt"])
    assert rows(first, "oid", "cid") == [(1, 1), (2, 3)]
    mixed = cln.dedup_by_key(df, ["oid"], [("dt", "asc"), ("cid", "desc")])
    assert rows(mixed, "oid", "cid") == [(1, 1), (2, 3)]
    assert latest.columns == df.columns


def test_split_first_reason_wins(spark):
    df = raw(spark, [(1, None, None, "1", "2020-01-01"), (2, 1, None, "1", "2020-01-01"),
                     (3, 1, "A", "1", "2020-01-01")])
    acc, rej = cln.split(df, [("missing_customer", "cid IS NULL"), ("blank", "prio IS NULL")])
    assert rows(acc, "oid") == [(3,)]
    assert rows(rej, "oid", "reject_reason") == [(1, "missing_customer"), (2, "blank")]


def test_domain_orphans_dates(spark):
    orders = spark.createDataFrame(
        [(1, 100.0, "F", dt.datetime(2020, 1, 5)), (2, 9000.0, "P", dt.datetime(2020, 1, 5)),
         (3, 9000.0, None, dt.datetime(2020, 1, 5)), (4, 9000.0, "O", dt.datetime(2020, 1, 5))],
        "k BIGINT, total DOUBLE, status STRING, odate TIMESTAMP")
    rules = [cln.DomainRule("min_total", "total", lo=5000),
             cln.DomainRule("status", "status", allowed=("F", "O"))]
    assert rows(cln.check_domain(orders, rules), "k", "violation") == [
        (1, "min_total"), (2, "status"), (3, "status")]
    lines = spark.createDataFrame(
        [(1, dt.datetime(2020, 1, 4)), (1, dt.datetime(2020, 1, 6)), (9, dt.datetime(2020, 1, 1))],
        "lk BIGINT, ship TIMESTAMP")
    assert rows(cln.orphans(orders, lines, [("k", "lk")]), "k") == [(2,), (3,), (4,)]
    assert rows(cln.orphans(lines, orders, [("lk", "k")]), "lk") == [(9,)]
    s = cln.check_dates(lines, orders, [("lk", "k")], "ship", "odate").collect()[0]
    assert (s["rows_checked"], s["rows_failed"]) == (2, 1)
    bad = cln.check_dates(lines, orders, [("lk", "k")], "ship", "odate", summary=False)
    assert bad.count() == 1 and bad.columns == lines.columns


def test_profile(spark):
    df = spark.createDataFrame([(1, "x"), (2, None), (2, "y")], "a BIGINT, b STRING")
    got = rows(cln.profile(df))
    assert got == [("a", 3, 0, 2, "1", "2"), ("b", 3, 1, 2, "x", "y")]


def test_clean_raw_orders_fixture(spark):
    r = dirty.raw_orders(load(spark, SF_SMALL)["orders"])
    base = load(spark, SF_SMALL)["orders"].count()
    assert r.count() == base + load(spark, SF_SMALL)["orders"].filter("o_orderkey % 50 = 0").count()
    from ledgerline.reports import RAW_ORDER_RULES
    acc, rej = cln.clean(r, RAW_ORDER_RULES)
    assert acc.count() + rej.count() == base               # distinct raw rows
    reasons = {x["reason"] for x in cln.reject_counts(rej).collect()}
    assert reasons <= {"missing_customer", "bad_date", "bad_amount", "blank_priority"}
    acc2, rej2 = cln.clean(r, RAW_ORDER_RULES, checkpoint=True)
    assert (acc2.count(), rej2.count()) == (acc.count(), rej.count())
