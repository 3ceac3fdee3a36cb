"""SURVEY 5 edge cases: ties, all-null columns, empty inputs, null keys."""

from conftest import D, M, rows

from ledgerline.operators import clean as cln
from ledgerline.operators import cohort as coh
from ledgerline.operators import insight as ins
from ledgerline.operators import kpi
from ledgerline.operators import trend as trd


def test_rank_ties_share_a_rank(make_sales):
    s = make_sales([(1, 1, "2020-01-01", "A", "a", "EU", "10"),
                    (2, 1, "2020-01-01", "B", "b", "EU", "10"),
                    (3, 1, "2020-01-01", "C", "c", "EU", "5")])
    assert rows(ins.rank_categories(s), "category", "rank") == [("A", 1), ("B", 1), ("C", 3)]
    p = {r["category"]: r["cum_share"] for r in ins.pareto(s).collect()}
    assert p["A"] == 0.4 and p["B"] == 0.8          # tie broken by name


def test_profile_all_null_column(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "a BIGINT, b STRING")
    got = {r["column"]: r for r in cln.profile(df).collect()}
    assert (got["b"]["nulls"], got["b"]["distinct_values"], got["b"]["min_value"]) == (2, 0, None)


def test_empty_inputs(spark, make_sales, make_orders):
    s, o = make_sales([]), make_orders([])
    assert kpi.breakdown(s, ["category"]).count() == 0
    # The grand total exists even for an empty selection, as in standard SQL
    total = kpi.breakdown(s, ["category", "region"], totals=True).collect()
    assert [(r["level"], r["orders"], r["revenue"]) for r in total] == [(3, 0, None)]
    assert ins.pareto(s).count() == 0
    assert ins.seasonality(trd.trend(s, "month")).count() == 0
    assert ins.spikes(trd.trend(s, "month")).count() == 0
    for df in (coh.cohort_long(o), coh.cohort_long(o, dense=True), coh.retention_curve(o),
               coh.cohort_matrix(o, max_idx=2), coh.new_vs_returning(o), coh.order_gaps(o),
               coh.order_seq(o), coh.cohort_size(o)):
        assert df.count() == 0
    r = coh.repeat_rate(o).collect()[0]
    assert (r["customers"], r["repeat_rate"]) == (0, None)
    acc, rej = cln.clean(spark.createDataFrame([], "oid BIGINT, cid BIGINT, prio STRING"),
                         cln.CleanRules(text=("prio",), checks=(("x", "cid IS NULL"),)))
    assert acc.count() == 0 and rej.count() == 0


def test_null_group_keys(spark):
    t = spark.createDataFrame([(D("2020-01-01"), None, M(1), 1), (D("2020-03-01"), "A", M(2), 1)],
                              "period DATE, category STRING, revenue DECIMAL(28,4), orders BIGINT")
    f = trd.fill_calendar(t, "month", by="category")
    assert f.count() == 6
    assert rows(f.filter("category IS NULL"), "period", "orders") == [
        (D("2020-01-01"), 1), (D("2020-02-01"), 0), (D("2020-03-01"), 0)]
    df = spark.createDataFrame([(None, 3), (None, 1), (5, 2)], "k BIGINT, v BIGINT")
    assert rows(cln.dedup_by_key(df, ["k"], ["v"]), "k", "v") == [(5, 2), (None, 1)]


def test_hot_key_dedup_and_ranking(spark):
    # one key holds most rows, spread over many input partitions
    data = [(1, i) for i in range(300)] + [(k, 0) for k in range(2, 40)]
    df = spark.createDataFrame(data, "k BIGINT, v BIGINT").repartition(12)
    assert rows(cln.dedup_by_key(df, ["k"], [("v", "desc")]).filter("k = 1"), "v") == [(299,)]


def test_distributed_rank_pareto_topk_against_brute_force(spark, make_sales):
    import random
    rnd = random.Random(7)
    data = []
    for i in range(120):
        cat = f"c{rnd.randint(0, 59):02d}"
        data.append((i, 1, "2020-01-01", cat, cat, rnd.choice(["EU", "US", "EU", "EU"]),
                     str(rnd.choice([5, 10, 10, 20, 35]))))
    s = make_sales(data)
    tot = {}
    for *_, cat, _sub, _reg, rev in data:
        tot[cat] = tot.get(cat, 0) + int(rev)
    got = {r["category"]: r["rank"] for r in ins.rank_categories(s).collect()}
    assert got == {c: 1 + sum(v > tot[c] for v in tot.values()) for c in tot}
    order = sorted(tot, key=lambda c: (-tot[c], c))
    running, want = 0, {}
    for c in order:
        want[c] = running < 0.8 * sum(tot.values())
        running += tot[c]
    p = {r["category"]: r["is_core"] for r in ins.pareto(s).collect()}
    assert p == want
    cells = kpi.breakdown(s, ["region", "category"]).select("region", "category", "revenue")
    top = kpi.top_k(cells, 3, within="region", tie_cols=["category"], buckets=5)
    by_region = {}
    for r in cells.collect():
        by_region.setdefault(r["region"], []).append((-r["revenue"], r["category"]))
    want_top = sorted((reg, c) for reg, lst in by_region.items() for _, c in sorted(lst)[:3])
    assert sorted((r["region"], r["category"]) for r in top.collect()) == want_top


def test_fill_calendar_skips_null_periods(spark):
    t = spark.createDataFrame([(D("2020-01-01"), M(1), 1), (None, M(5), 2), (D("2020-03-01"), M(2), 1)],
                              "period DATE, revenue DECIMAL(28,4), orders BIGINT")
    got = rows(trd.fill_calendar(t, "month"), "period", "orders")
    assert got == [(D("2020-01-01"), 1), (D("2020-02-01"), 0), (D("2020-03-01"), 1)]
