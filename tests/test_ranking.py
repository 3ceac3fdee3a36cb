"""Ranks and numbers equal the plain window, whatever the optimiser reuses."""

import pytest
from conftest import SF_CHECK
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerline.operators import clean as cln
from ledgerline.operators import cohort as coh
from ledgerline.operators import insight as ins
from ledgerline.operators import kpi
from ledgerline.plans.ranking import ranges, value_slice
from ledgerline.plans.sales import sales
from ledgerline.sources import load

SF_LARGE = "/root/testdata/sf0.1"


@pytest.fixture(params=["true", "false"])
def reuse(spark, request):
    spark.conf.set("spark.sql.exchange.reuse", request.param)
    yield
    spark.conf.unset("spark.sql.exchange.reuse")


def test_order_seq_with_extra_columns(spark, reuse):
    orders = load(spark, SF_LARGE)["orders"]
    got = coh.order_seq(orders, "o_custkey", "o_orderdate", "o_orderkey")
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    want = orders.withColumn("order_seq", F.row_number().over(w).cast("bigint"))
    assert got.count() == orders.count() == 150_000
    assert got.exceptAll(want).isEmpty()


def test_rank_and_pareto_of_customers(spark, reuse):
    fact = sales(load(spark, SF_LARGE)).select("customer_id", "order_id", "revenue")
    per = kpi.breakdown(fact, "customer_id").select("customer_id", "revenue").toPandas()
    per = per.sort_values(["revenue", "customer_id"], ascending=[False, True])
    rank = per["revenue"].rank(method="min", ascending=False).astype(int)
    want = dict(zip(per["customer_id"], rank))
    got = {r.customer_id: r.rank for r in ins.rank_categories(fact, "customer_id").collect()}
    assert len(got) > 14_000 and got == want
    total, run, core = per["revenue"].sum(), 0, {}
    for customer, revenue in zip(per["customer_id"], per["revenue"]):
        core[customer] = (run < total * 8 / 10, float(run + revenue) / float(total))
        run += revenue
    rows = ins.pareto(fact, "customer_id").collect()
    assert {r.customer_id: r.is_core for r in rows} == {k: v[0] for k, v in core.items()}
    assert all(r.cum_share == pytest.approx(core[r.customer_id][1], rel=1e-12) for r in rows)


def test_value_slices_are_monotone(spark):
    values = spark.sql("""SELECT CAST(v AS DECIMAL(28,4)) AS v FROM VALUES (-1e9), (-3.5), (-0.0001),
                          (0), (0.0001), (1), (1.0001), (99999999), (1e20), (null) AS t(v)""")
    got = [r.s for r in values.select("v", value_slice("v").alias("s")).orderBy("v").collect()]
    assert got[0] is None and got[1:] == sorted(got[1:])


def test_ranks_of_negative_equal_and_null_amounts(spark, make_sales):
    amounts = ["5", "5", "-3", "0", "0", "7", "-3", "5"]
    s = make_sales([(i, 1, "2020-01-01", f"c{i}", "x", "EU", a) for i, a in enumerate(amounts)])
    none = s.limit(1).withColumn("category", F.lit("none")).withColumn(
        "revenue", F.lit(None).cast("decimal(18,4)"))
    got = {r.category: r.rank for r in ins.rank_categories(s.union(none)).collect()}
    assert got == {"c5": 1, "c0": 2, "c1": 2, "c7": 2, "c3": 5, "c4": 5, "c2": 7, "c6": 7, "none": 9}


def test_dedup_in_both_directions(spark, reuse):
    lines = load(spark, SF_CHECK)["lineitem"]
    keys = ["l_orderkey", "l_linenumber"]
    for order in ([("l_shipdate", "desc")], [("l_shipdate", "desc"), ("l_quantity", "asc")]):
        kept = cln.dedup_by_key(lines, keys, order)
        cols = [F.col(c).desc() if d == "desc" else F.col(c).asc() for c, d in order]
        rest = [c for c in lines.columns if c not in [*keys, *[o[0] for o in order]]]
        cols += [F.col(c).desc() if order[-1][1] == "desc" else F.col(c).asc() for c in rest]
        w = Window.partitionBy(*keys).orderBy(*cols)
        want = lines.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
        assert kept.count() == lines.select(*keys).distinct().count()
        assert kept.exceptAll(want).isEmpty()


def test_top_k_ties_do_not_depend_on_partitioning(spark):
    data = [(1, 10, i) for i in range(20)] + [(1, 11, 50), (2, 3, 4)]
    df = spark.createDataFrame(data, "g INT, revenue INT, other INT")
    want = [(1, 10, 0, 2), (1, 10, 1, 3), (1, 11, 50, 1), (2, 3, 4, 1)]
    for n in (1, 3, 7):
        got = kpi.top_k(df.repartition(n, "other"), 3, within="g")
        assert sorted(map(tuple, got.collect())) == want
    tied = kpi.top_k(df, 2, within="g", keep_ties=True).collect()
    assert len(tied) == 22 and {r["rank"] for r in tied if r["revenue"] == 10} == {2}


def test_half_of_all_groups_tied(spark, make_sales):
    """Ranks and shares by hand, and no range of the shares holds the ties."""
    n = 2000
    amounts = ["5" if i % 2 else str(i) for i in range(n)]
    s = make_sales([(i, i, "2020-01-01", f"c{i:04d}", "x", "EU", a) for i, a in enumerate(amounts)])
    order = sorted(range(n), key=lambda i: (-int(amounts[i]), f"c{i:04d}"))
    above = {a: sum(int(b) > int(a) for b in amounts) for a in set(amounts)}
    got = {r.category: r.rank for r in ins.rank_categories(s).collect()}
    assert got == {f"c{i:04d}": 1 + above[a] for i, a in enumerate(amounts)}
    total, run, want = sum(map(int, amounts)), 0, {}
    for i in order:
        run += int(amounts[i])
        want[f"c{i:04d}"] = run / total
    shares = {r.category: r.cum_share for r in ins.pareto(s).collect()}
    assert shares == pytest.approx(want, rel=1e-12)
    per = kpi.breakdown(s, ["category"]).select("category", "revenue")
    # Small shuffles are merged by AQE, which would leave one range here.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        kept = ranges(per, [F.col("revenue").desc(), F.col("category").asc()], "test")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = [r["count"] for r in kept.groupBy("_range").count().collect()]
    assert sum(sizes) == n and max(sizes) < 2 * n / len(sizes) and len(sizes) == 4
