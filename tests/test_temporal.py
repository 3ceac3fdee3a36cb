"""Interval and as-of joins against brute force, with hot keys and nulls."""

import datetime as dt
import random
import re

import pytest

from ledgerline.operators import temporal as tmp

T0 = dt.datetime(2021, 3, 27, 22, 0)
POINTS = "k BIGINT, pid BIGINT, at TIMESTAMP_NTZ"
SPANS = "k BIGINT, sid BIGINT, begin TIMESTAMP_NTZ, end TIMESTAMP_NTZ"
EVENTS = "k BIGINT, eid BIGINT, seen TIMESTAMP_NTZ, what STRING"


def data(seed, n=400, hot=7, days=20):
    """A third of the rows has one key, some keys and times are null."""
    rnd = random.Random(seed)
    key = lambda i: None if i % 23 == 0 else hot if i % 3 == 0 else rnd.randrange(12)
    time = lambda: T0 + dt.timedelta(minutes=rnd.randrange(days * 1440))              # noqa: E731
    points = [(key(i), i, None if i % 31 == 0 else time()) for i in range(n)]
    spans = []
    for i in range(n):
        begin = time()
        end = begin + dt.timedelta(hours=rnd.randrange(-5, 72))
        spans.append((key(i), i, begin, None if i % 29 == 0 else end))
    return points, spans


def pairs(points, spans):
    return sorted((p, s) for k, p, at in points for q, s, begin, end in spans
                  if None not in (k, at, end) and k == q and begin < at <= end)


@pytest.mark.parametrize("width, hot", [(1, 10_000), (3, 5), (30, 1)])
def test_interval_join_equals_brute_force(spark, width, hot):
    points, spans = data(1)
    got = tmp.interval_join(spark.createDataFrame(points, POINTS), spark.createDataFrame(spans, SPANS),
                            "k", "at", "begin", "end", width, hot)
    assert got.columns == ["k", "pid", "at", "sid", "begin", "end"]
    assert sorted((r.pid, r.sid) for r in got.collect()) == pairs(points, spans)


def test_interval_join_keeps_repeated_rows_and_edges(spark):
    """The begin is outside, the end inside; midnight is no border."""
    day = dt.timedelta(days=1)
    points = [(1, 1, T0), (1, 2, T0 + day), (1, 2, T0 + day), (1, 3, T0 + day + dt.timedelta(0, 0, 1))]
    spans = [(1, 1, T0, T0 + day), (1, 1, T0, T0 + day), (2, 2, T0, T0 + day)]
    got = tmp.interval_join(spark.createDataFrame(points, POINTS), spark.createDataFrame(spans, SPANS),
                            "k", "at", "begin", "end", hot_rows=1)
    assert sorted((r.pid, r.sid) for r in got.collect()) == [(2, 1)] * 4


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_pairs_of_a_key_are_compared(spark):
    points, spans = data(2, n=60)
    p, s = spark.createDataFrame(points, POINTS), spark.createDataFrame(spans, SPANS)
    plans = [final_plan(tmp.interval_join(p, s, "k", "at", "begin", "end")),
             final_plan(tmp.asof_join(p, spark.createDataFrame([], EVENTS), "k", "at", "seen",
                                      ["eid", "what"]))]
    for plan in plans:
        assert "NestedLoop" not in plan and "Cartesian" not in plan
    # The interval join's equality is on key, bin and cut.
    assert re.search(r"Join \[k#\d+L?, _bin#\d+L?, _cut#\d+\]", plans[0])


def test_a_hot_bin_is_cut(spark):
    """Half of all points in one key and hour: no (key, bin, cut) holds them."""
    points = [(1 if i % 2 else i, i, T0 + dt.timedelta(seconds=i % 600)) for i in range(4000)]
    spans = [(1, 1, T0 - dt.timedelta(hours=1), T0 + dt.timedelta(hours=1))]
    got = tmp.interval_join(spark.createDataFrame(points, POINTS), spark.createDataFrame(spans, SPANS),
                            "k", "at", "begin", "end", hot_rows=100)
    assert got.count() == 2000
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "_cut" in plan and "_cuts" in plan


def last_before(points, events, inclusive=True):
    out = {}
    for k, p, at in points:
        ok = [(seen, e, what) for q, e, seen, what in events
              if None not in (k, at, seen) and k == q and (seen <= at if inclusive else seen < at)]
        out[p] = max(ok)[1:] if ok else (None, None)
    return out


def events_of(points, seed):
    rnd = random.Random(seed)
    rows = []
    for i, (k, _, at) in enumerate(points):
        when = None if i % 17 == 0 or at is None else at + dt.timedelta(hours=rnd.choice([0, 0, 5, -30]))
        rows.append((k, 1000 + i, when, rnd.choice("abc")))
    return rows


@pytest.mark.parametrize("grain", ["day", "hour"])
@pytest.mark.parametrize("inclusive", [True, False])
def test_asof_join_equals_brute_force(spark, grain, inclusive):
    points, _ = data(3, n=300)
    events = events_of(points, 4)
    got = tmp.asof_join(spark.createDataFrame(points, POINTS), spark.createDataFrame(events, EVENTS),
                        "k", "at", "seen", ["eid", "what"], order=["eid"], inclusive=inclusive,
                        grain=grain)
    assert got.columns == ["k", "pid", "at", "eid", "what"]
    assert {r.pid: (r.eid, r.what) for r in got.collect()} == last_before(points, events, inclusive)


def test_asof_join_keeps_repeated_left_rows_and_null_values(spark):
    points = [(1, 1, T0), (1, 1, T0), (None, 2, T0), (1, 3, None), (2, 4, T0)]
    events = [(1, 5, T0 - dt.timedelta(days=400), None), (1, 6, T0 + dt.timedelta(0, 1), "later")]
    got = tmp.asof_join(spark.createDataFrame(points, POINTS), spark.createDataFrame(events, EVENTS),
                        "k", "at", "seen", ["eid", "what"])
    assert sorted(((r.pid, r.eid, r.what) for r in got.collect()), key=str) == [
        (1, 5, None), (1, 5, None), (2, None, None), (3, None, None), (4, None, None)]


def test_the_window_of_a_hot_key_is_by_slice(spark):
    points, _ = data(3, n=30)
    got = tmp.asof_join(spark.createDataFrame(points, POINTS), spark.createDataFrame([], EVENTS),
                        "k", "at", "seen", ["eid"])
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    rows = [w for w in re.findall(r"Window \[.*?\], \[(.*?)\], \[(.*?)\]", plan) if "_tag" in w[1]]
    assert rows and all("_slice" in by for by, _ in rows)


def test_clashing_columns_are_an_error(spark):
    p = spark.createDataFrame([], POINTS)
    with pytest.raises(ValueError, match="both sides"):
        tmp.interval_join(p, spark.createDataFrame([], POINTS), "k", "at", "at", "at")
    with pytest.raises(ValueError, match="both sides"):
        tmp.asof_join(p, spark.createDataFrame([], POINTS), "k", "at", "at", ["pid"])
    with pytest.raises(ValueError, match="grain"):
        tmp.asof_join(p, spark.createDataFrame([], EVENTS), "k", "at", "seen", ["eid"], grain="week")
