from conftest import M, rows

from ledgerline.operators import kpi

SALES = [
    (1, 10, "2020-01-05", "A", "a1", "EU", "10.00"),
    (1, 10, "2020-01-05", "B", "b1", "EU", "5.00"),
    (2, 11, "2020-02-05", "A", "a1", "US", "1.50"),
    (3, 10, "2021-03-02", "A", "a2", "EU", "20.00"),
    (4, 12, "2021-01-10", "C", "c1", "US", "20.00"),
]


def test_kpis(make_sales):
    r = kpi.kpis(make_sales(SALES)).collect()[0]
    assert (r["revenue"], r["orders"]) == (M("56.5000"), 4)
    assert r["aov"] == 56.5 / 4


def test_kpis_sliced(make_sales):
    s = make_sales(SALES)
    r = kpi.kpis(s, start="2020-01-01", end="2021-01-01", categories=["A"]).collect()[0]
    assert (r["revenue"], r["orders"]) == (M("11.5000"), 2)
    r = kpi.kpis(s, regions=["NOWHERE"]).collect()[0]
    assert (r["revenue"], r["orders"], r["aov"]) == (None, 0, None)


def test_breakdown_and_rollup(make_sales):
    s = make_sales(SALES)
    assert rows(kpi.breakdown(s, ["category"]), "category", "revenue", "orders") == [
        ("A", M("31.5000"), 3), ("B", M("5.0000"), 1), ("C", M("20.0000"), 1)]
    r = kpi.breakdown(s, ["category", "region"], totals=True)
    got = {(x["category"], x["region"], x["level"]): (x["revenue"], x["orders"]) for x in r.collect()}
    assert got[(None, None, 3)] == (M("56.5000"), 4)     # order 1 counted once
    assert got[("A", None, 1)] == (M("31.5000"), 3)
    assert got[("A", "EU", 0)] == (M("30.0000"), 2)
    assert len(got) == 4 + 3 + 1


def test_top_k_ties_broken_by_name(make_sales):
    cells = kpi.breakdown(make_sales(SALES), ["region", "category"]).select(
        "region", "category", "revenue")
    top = kpi.top_k(cells, 1, within="region", tie_cols=["category"])
    assert rows(top, "region", "category", "rank") == [("EU", "A", 1), ("US", "C", 1)]
    # C and A tie in US at k=2? (A=1.5, C=20) -> both kept, ranked
    top2 = kpi.top_k(cells, 2, within="region", tie_cols=["category"])
    assert top2.count() == 4
