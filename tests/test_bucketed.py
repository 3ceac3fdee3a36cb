"""Lines and orders stored bucketed on the order, and slices of customers."""

from conftest import SF_SMALL, rows

from ledgerline.operators import clean as cln
from ledgerline.operators import cohort as coh
from ledgerline.plans import sales as model
from ledgerline.sources import BucketedFact, load

LINES = "order_id BIGINT, line INT, revenue INT"
ORDERS = "order_id BIGINT, region STRING"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def store(spark, lines, orders, **kw):
    return BucketedFact(spark, spark.createDataFrame(lines, LINES),
                        spark.createDataFrame(orders, ORDERS), ["line"], buckets=8, **kw)


def without_broadcast(spark, run):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return run()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_join_has_no_shuffle(spark):
    def run():
        lines = [(i % 40, i, i * 3) for i in range(200)] + [(None, 1, 1), (99, 2, 2)]
        s = store(spark, lines, [(i, f"R{i % 3}") for i in range(45)] + [(None, "R")])
        df = s.joined()
        got = rows(df, "order_id", "revenue", "region")
        assert got == sorted(((i % 40, i * 3, f"R{i % 40 % 3}") for i in range(200)),
                             key=lambda t: tuple((v is None, str(v)) for v in t))
        assert "SortMergeJoin" in plan(df) and "Exchange" not in plan(df)
        s.close()
        assert not [t for t in spark.catalog.listTables() if t.name in s.names.values()]
    without_broadcast(spark, run)


def test_a_hot_order_is_spread(spark):
    def run():
        lines = [(7, i, i) for i in range(1000)] + [(i, 0, 1) for i in range(8, 500)]
        s = store(spark, lines, [(i, "R") for i in range(500)], most=50)
        df = s.joined()
        assert df.count() == len(lines)
        assert df.where("order_id = 7").count() == 1000
        files = s.table("lines").selectExpr("input_file_name() AS f", "order_id").where(
            "order_id = 7").groupBy("f").count().collect()
        assert len(files) > 4 and max(r["count"] for r in files) < 500
        assert "Exchange" not in plan(s.joined())
        s.close()
    without_broadcast(spark, run)


def test_empty_tables(spark):
    for lines, orders in (([], []), ([(1, 1, 1)], []), ([], [(1, "R")])):
        s = store(spark, lines, orders)
        assert s.joined().collect() == []
        assert s.joined().columns == ["order_id", "revenue", "region"]
        s.close()


def test_cohorts_of_a_slice_of_customers(spark, make_sales):
    t = load(spark, SF_SMALL)
    whole = coh.cohort_size(model.cohort_orders(t)).groupBy().sum("customers").first()[0]
    parts = [coh.cohort_size(model.cohort_orders(t, regions=[r.r_name])).groupBy()
             .sum("customers").first()[0] or 0 for r in t["region"].collect()]
    assert sum(parts) == whole and len(parts) == 5
    fact = make_sales([(2, 1, "2020-01-05", "B", "x", "R", 5), (1, 1, "2020-01-06", "A", "x", "R", 9),
                       (3, 2, "2020-01-05", "B", "x", "R", 5), (3, 2, "2020-01-05", "A", "x", "R", 3),
                       (3, 2, "2020-01-05", "A", "y", "R", 3), (4, 3, "2020-02-01", "B", "x", "R", 4),
                       (4, 3, "2020-02-01", "A", "x", "R", 4)])
    assert rows(model.first_category(fact)) == [(1, "B"), (2, "A"), (3, "A")]


def test_repeated_parents_check_a_child_once(spark):
    child = spark.createDataFrame([(1, "2020-01-05"), (1, "2020-01-02"), (2, "2020-01-01")],
                                  "k INT, d STRING").selectExpr("k", "CAST(d AS DATE) AS d")
    parent = spark.createDataFrame([(1, "2020-01-03"), (1, "2020-01-01"), (1, None), (3, None)],
                                   "k INT, p STRING").selectExpr("k", "CAST(p AS DATE) AS p")
    s = cln.check_dates(child, parent, "k", "d", "p").first()
    assert (s.rows_checked, s.rows_failed) == (2, 1)
    bad = cln.check_dates(child, parent, "k", "d", "p", summary=False).collect()
    assert [str(r.d) for r in bad] == ["2020-01-02"]
