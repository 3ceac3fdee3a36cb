from conftest import D, rows

from ledgerline.operators import cohort as coh

# customer 1: Jan, Jan (same day twice), Mar; customer 2: Jan only;
# customer 3: Feb, Apr; last data month is April.
ORDERS = [
    (1, 1, "2020-01-03"), (2, 1, "2020-01-03"), (3, 1, "2020-03-15"),
    (4, 2, "2020-01-20"),
    (5, 3, "2020-02-01"), (6, 3, "2020-04-30"),
]


def test_cohort_sizes_and_long(make_orders):
    o = make_orders(ORDERS)
    assert rows(coh.cohort_size(o)) == [(D("2020-01-01"), 2), (D("2020-02-01"), 1)]
    long = rows(coh.cohort_long(o), "cohort", "month_index", "customers", "retention")
    assert long == [(D("2020-01-01"), 0, 2, 1.0), (D("2020-01-01"), 2, 1, 0.5),
                    (D("2020-02-01"), 0, 1, 1.0), (D("2020-02-01"), 2, 1, 1.0)]


def test_dense_cells_are_zero_inside_window_only(make_orders):
    dense = rows(coh.cohort_long(make_orders(ORDERS), dense=True),
                 "cohort", "month_index", "customers")
    assert dense == [(D("2020-01-01"), 0, 2), (D("2020-01-01"), 1, 0), (D("2020-01-01"), 2, 1),
                     (D("2020-01-01"), 3, 0),
                     (D("2020-02-01"), 0, 1), (D("2020-02-01"), 1, 0), (D("2020-02-01"), 2, 1)]


def test_matrix_null_beyond_last_month(make_orders):
    m = {r["cohort"]: r for r in coh.cohort_matrix(make_orders(ORDERS), max_idx=3).collect()}
    jan, feb = m[D("2020-01-01")], m[D("2020-02-01")]
    assert (jan["m0"], jan["m1"], jan["m2"], jan["m3"]) == (1.0, 0.0, 0.5, 0.0)
    assert (feb["m0"], feb["m1"], feb["m2"], feb["m3"]) == (1.0, 0.0, 1.0, None)


def test_retention_curve_counts_eligible_cohorts_only(make_orders):
    c = {r["month_index"]: r for r in coh.retention_curve(make_orders(ORDERS)).collect()}
    assert (c[2]["retained"], c[2]["eligible"]) == (2, 3)
    assert (c[3]["retained"], c[3]["eligible"], c[3]["cohorts"]) == (0, 2, 1)


def test_repeat_rate(make_orders):
    r = coh.repeat_rate(make_orders(ORDERS)).collect()[0]
    assert (r["customers"], r["repeat_customers"]) == (3, 2)


def test_new_vs_returning(make_orders):
    got = rows(coh.new_vs_returning(make_orders(ORDERS)))
    assert got == [(D("2020-01-01"), 3, 2, 1), (D("2020-02-01"), 1, 1, 0),
                   (D("2020-03-01"), 1, 0, 1), (D("2020-04-01"), 1, 0, 1)]


def test_order_gaps(make_orders):
    assert rows(coh.order_gaps(make_orders(ORDERS))) == [(0, 1), (72, 1), (89, 1)]


def test_order_seq_matches_window_under_skew(spark, make_orders):
    # one hot customer holds most orders; many orders a day
    data = [(i, 7, f"2020-01-{1 + i % 28:02d}") for i in range(1, 400)]
    data += [(1000 + i, i % 5, "2020-02-01") for i in range(50)]
    o = make_orders(data)
    got = coh.order_seq(o)
    from pyspark.sql import Window, functions as F
    want = o.withColumn("order_seq", F.row_number().over(
        Window.partitionBy("customer_id").orderBy("order_date", "order_id")).cast("bigint"))
    assert rows(got, "order_id", "order_seq") == rows(want, "order_id", "order_seq")


def test_null_customers_are_ignored(make_orders):
    o = make_orders(ORDERS + [(9, None, "2020-05-05")])
    assert coh.cohort_size(o).count() == 2
    assert coh.repeat_rate(o).collect()[0]["customers"] == 3


def test_undated_orders_are_ignored(make_orders):
    o = make_orders(ORDERS + [(9, 4, None), (10, 1, None)])
    assert rows(coh.cohort_size(o)) == [(D("2020-01-01"), 2), (D("2020-02-01"), 1)]
    assert coh.repeat_rate(o).collect()[0]["customers"] == 3
    assert coh.order_seq(o).count() == len(ORDERS)
    assert coh.cohort_long(o).count() == 4
