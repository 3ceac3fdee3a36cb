from conftest import D, M, rows

from ledgerline.operators import trend as trd

SALES = [
    # order, customer, date, category, sub, region, revenue
    (1, 10, "2020-01-05", "A", "a1", "EU", "10.00"),
    (1, 10, "2020-01-05", "B", "b1", "EU", "5.00"),
    (2, 11, "2020-01-05", "A", "a1", "US", "1.50"),
    (3, 10, "2020-03-02", "A", "a2", "EU", "20.00"),   # February has no sales
    (4, 12, "2021-01-10", "B", "b1", "US", "7.25"),
]


def test_daily_and_monthly_trend(make_sales):
    s = make_sales(SALES)
    assert rows(trd.trend(s, "day")) == [
        (D("2020-01-05"), M("16.5000"), 2), (D("2020-03-02"), M("20.0000"), 1),
        (D("2021-01-10"), M("7.2500"), 1)]
    monthly = trd.trend(s, "month")
    assert rows(monthly) == [
        (D("2020-01-01"), M("16.5000"), 2), (D("2020-03-01"), M("20.0000"), 1),
        (D("2021-01-01"), M("7.2500"), 1)]


def test_category_trend_counts_distinct_orders(make_sales):
    t = trd.trend(make_sales(SALES), "month", by="category")
    assert rows(t, "period", "category", "orders") == [
        (D("2020-01-01"), "A", 2), (D("2020-01-01"), "B", 1), (D("2020-03-01"), "A", 1),
        (D("2021-01-01"), "B", 1)]


def test_fill_calendar_zero_months(make_sales):
    t = trd.fill_calendar(trd.trend(make_sales(SALES), "month"), "month")
    got = rows(t)
    assert len(got) == 13                     # 2020-01 .. 2021-01
    assert got[1] == (D("2020-02-01"), M("0.0000"), 0)


def test_fill_calendar_per_group(make_sales):
    t = trd.trend(make_sales(SALES), "month", by="category")
    f = trd.fill_calendar(t, "month", by="category")
    assert f.count() == 26                    # 2 categories x 13 months
    assert f.filter("orders = 0").count() == 26 - 4


def test_growth_ytd_moving_avg(make_sales):
    t = trd.fill_calendar(trd.trend(make_sales(SALES), "month"), "month")
    g = {r["period"]: r for r in trd.growth(t).collect()}
    assert g[D("2020-01-01")]["growth"] is None
    assert g[D("2020-02-01")]["growth"] == -1.0
    assert g[D("2020-03-01")]["growth"] is None          # zero base
    y = {r["period"]: r["ytd_revenue"] for r in trd.ytd(t).collect()}
    assert y[D("2020-03-01")] == M("36.5000")
    assert y[D("2021-01-01")] == M("7.2500")             # resets each year
    m = {r["period"]: r["moving_avg"] for r in trd.moving_avg(t, 3).collect()}
    assert m[D("2020-01-01")] == 16.5
    assert m[D("2020-03-01")] == 36.5 / 3


def test_empty_input(make_sales):
    s = make_sales([])
    assert trd.trend(s, "month").count() == 0
    assert trd.fill_calendar(trd.trend(s, "day"), "day").count() == 0


def test_complete_only_drops_partial_last_period(make_sales):
    s = make_sales(SALES)           # last data day 2021-01-10: January 2021 is partial
    got = [r["period"] for r in trd.trend(s, "month", complete_only=True).collect()]
    assert sorted(got) == [D("2020-01-01"), D("2020-03-01")]
    days = trd.trend(s, "day", complete_only=True).count()
    assert days == 3                # a day with data is always complete
