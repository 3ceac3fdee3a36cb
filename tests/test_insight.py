from conftest import D, M, rows

from ledgerline.operators import insight as ins


def test_rank_and_pareto(make_sales):
    s = make_sales([
        (1, 1, "2020-01-01", "A", "a", "EU", "50"), (2, 1, "2020-01-01", "B", "b", "EU", "30"),
        (3, 1, "2020-01-01", "C", "c", "EU", "15"), (4, 1, "2020-01-01", "D", "d", "EU", "5"),
    ])
    assert rows(ins.rank_categories(s), "category", "rank") == [
        ("A", 1), ("B", 2), ("C", 3), ("D", 4)]
    p = {r["category"]: r for r in ins.pareto(s, "category", 0.8).collect()}
    assert [p[c]["is_core"] for c in "ABCD"] == [True, True, False, False]
    assert p["D"]["cum_share"] == 1.0
    assert p["A"]["share"] == 0.5


def test_seasonality_uses_complete_years(spark):
    data = []
    for y in (2019, 2020):
        for m in range(1, 13):
            data.append((D(f"{y}-{m:02d}-01"), M(200 if m == 12 else 100)))
    data.append((D("2021-01-01"), M(999999)))          # incomplete year, ignored
    monthly = spark.createDataFrame(data, "period DATE, revenue DECIMAL(28,4)")
    s = {r["month_of_year"]: r for r in ins.seasonality(monthly).collect()}
    assert s[12]["seasonality_index"] == 12 * 400 / 2600
    assert s[1]["years"] == 2


def test_spikes_need_a_full_trailing_window(spark):
    data = [(D(f"2020-{m:02d}-01"), M(100)) for m in range(1, 13)]
    data += [(D("2021-01-01"), M(111)), (D("2021-02-01"), M(110))]
    monthly = spark.createDataFrame(data, "period DATE, revenue DECIMAL(28,4)")
    out = {r["period"]: r for r in ins.spikes(monthly, 1.1).collect()}
    assert out[D("2021-01-01")]["is_spike"] is True
    assert out[D("2021-02-01")]["is_spike"] is False    # 110 is not > 1.1 * avg(100.9..)
    assert out[D("2020-06-01")]["is_spike"] is False
    assert out[D("2020-01-01")]["trailing_avg"] is None


def test_seasonality_and_spikes_per_group(spark):
    data = []
    for cat, peak in (("A", 12), ("B", 6)):
        for m in range(1, 13):
            data.append((cat, D(f"2020-{m:02d}-01"), M(300 if m == peak else 100)))
        data.append((cat, D("2021-01-01"), M(100)))
    monthly = spark.createDataFrame(data, "category STRING, period DATE, revenue DECIMAL(28,4)")
    s = {(r["category"], r["month_of_year"]): r["seasonality_index"]
         for r in ins.seasonality(monthly, by="category").collect()}
    assert s[("A", 12)] == 12 * 300 / 1400 and s[("B", 6)] == 12 * 300 / 1400
    assert s[("A", 6)] == 12 * 100 / 1400
    sp = ins.spikes(monthly, 1.1, by="category").filter("is_spike").collect()
    assert sp == []                 # the peaks have no full 12-month history
