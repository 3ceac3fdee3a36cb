"""Random small inputs: operators against brute-force Python, and SURVEY 5 invariants."""

import datetime as dt
import os
from collections import defaultdict
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerline.operators import cohort as coh
from ledgerline.operators import kpi
from ledgerline.operators import trend as trd

# LEDGERLINE_EXAMPLES raises the number of random cases for a deeper run.
SETTINGS = settings(max_examples=int(os.environ.get("LEDGERLINE_EXAMPLES", "8")), deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

day0 = dt.date(2020, 1, 1)
order_st = st.lists(
    st.tuples(st.integers(0, 6),            # customer (0 is hot when drawn often)
              st.integers(0, 400)),         # day offset
    min_size=1, max_size=40)
line_st = st.lists(
    st.tuples(st.sampled_from("ABC"), st.sampled_from(["EU", "US"]),
              st.integers(1, 99999)),       # cents
    min_size=1, max_size=3)


def month_index(a, b):
    return (b.year - a.year) * 12 + b.month - a.month


@SETTINGS
@given(order_st)
def test_cohorts_against_brute_force(spark, make_orders, data):
    orders = [(i + 1, c, (day0 + dt.timedelta(days=d)).isoformat()) for i, (c, d) in enumerate(data)]
    o = make_orders(orders)
    months = defaultdict(set)
    for _, c, d in orders:
        dd = dt.date.fromisoformat(d)
        months[c].add(dt.date(dd.year, dd.month, 1))
    last = max(m for s in months.values() for m in s)
    cells = defaultdict(int)
    for c, ms in months.items():
        first = min(ms)
        for m in ms:
            cells[(first, month_index(first, m))] += 1
    got = {(r["cohort"], r["month_index"]): r["customers"]
           for r in coh.cohort_long(o, dense=True).collect()}
    want = {}
    for (cohort, i), n in cells.items():
        if i == 0:
            for j in range(month_index(cohort, last) + 1):
                want[(cohort, j)] = cells.get((cohort, j), 0)
    assert got == want
    # order_seq against a sort
    seq = {r["order_id"]: r["order_seq"] for r in coh.order_seq(o).collect()}
    by_c = defaultdict(list)
    for oid, c, d in orders:
        by_c[c].append((d, oid))
    for c, lst in by_c.items():
        for n, (_, oid) in enumerate(sorted(lst), 1):
            assert seq[oid] == n
    # new + returning = all orders; new = customers
    nvr = coh.new_vs_returning(o).groupBy().sum("orders", "new_orders").collect()[0]
    assert (nvr[0], nvr[1]) == (len(orders), len(months))
    # gap histogram: one gap per order after each customer's first
    gaps = coh.order_gaps(o).groupBy().sum("occurrences").collect()[0][0] or 0
    assert gaps == len(orders) - len(months)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 120), line_st), min_size=1, max_size=25))
def test_sales_invariants(spark, make_sales, data):
    rows = []
    for oid, (c, d, lines) in enumerate(data, 1):
        day = (day0 + dt.timedelta(days=d)).isoformat()
        for cat, reg, cents in lines:
            rows.append((oid, c, day, cat, cat.lower(), reg, str(Decimal(cents) / 100)))
    s = make_sales(rows)
    total = sum(Decimal(r[6]) for r in rows)
    k = kpi.kpis(s).collect()[0]
    assert k["revenue"] == total and k["orders"] == len(data)
    for dims in (["category"], ["region"]):
        assert sum(r["revenue"] for r in kpi.breakdown(s, dims).collect()) == total
    r = {(x["category"], x["region"], x["level"]): x["orders"]
         for x in kpi.breakdown(s, ["category", "region"], totals=True).collect()}
    assert r[(None, None, 3)] == len(data)
    daily = trd.fill_calendar(trd.trend(s, "day"), "day")
    days = [x["period"] for x in daily.collect()]
    assert len(days) == (max(days) - min(days)).days + 1
    assert sum(x["revenue"] for x in daily.collect()) == total
    monthly = trd.ytd(trd.trend(s, "month"))
    by_year = defaultdict(Decimal)
    for x in sorted(monthly.collect(), key=lambda x: x["period"]):
        by_year[x["period"].year] += x["revenue"]
        assert x["ytd_revenue"] == by_year[x["period"].year]


raw_row = st.tuples(
    st.integers(1, 6),                                             # oid
    st.one_of(st.none(), st.integers(1, 3)),                       # cid
    st.sampled_from(["HIGH", " high ", "", "  ", None, "low"]),    # prio
    st.sampled_from(["1.50", " 1.5", "n/a", "", None, "20"]),      # amt
    st.sampled_from(["2020-01-02", "2020-13-40", " 2020-01-02 ", "", None]))  # dt


def _py_clean(rows):
    from decimal import Decimal, InvalidOperation

    def amt(v):
        if v is None or not v.strip():
            return None
        try:
            return Decimal(v.strip()).quantize(Decimal("0.01"))
        except InvalidOperation:
            return None

    def day(v):
        try:
            return dt.date.fromisoformat(v.strip()) if v is not None else None
        except ValueError:
            return None

    def prio(v):
        v = v.strip().upper() if v is not None else None
        return v or None

    std = {(o, c, prio(p), amt(a), day(d)) for o, c, p, a, d in rows}
    acc, rej = [], []
    for r in std:
        reason = ("missing_customer" if r[1] is None else "bad_date" if r[4] is None
                  else "bad_amount" if r[3] is None else "blank_priority" if r[2] is None else None)
        (rej if reason else acc).append(r if not reason else r + (reason,))
    return sorted(acc, key=str), sorted(rej, key=str)


@SETTINGS
@given(st.lists(raw_row, min_size=1, max_size=30))
def test_clean_against_python(spark, data):
    from ledgerline.operators import clean as cln
    from ledgerline.reports import RAW_ORDER_RULES
    raw = spark.createDataFrame(data, "oid BIGINT, cid BIGINT, prio STRING, amt STRING, dt STRING")
    acc, rej = cln.clean(raw, RAW_ORDER_RULES)
    want_acc, want_rej = _py_clean(data)
    assert sorted((tuple(r) for r in acc.collect()), key=str) == want_acc
    assert sorted((tuple(r) for r in rej.collect()), key=str) == want_rej
