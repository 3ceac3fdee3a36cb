"""Streams replayed arrival by arrival: late rows, restarts, expiry of state."""

import datetime as dt
import random

import pytest
from conftest import SF_SMALL

from ledgerline import reports
from ledgerline.sources import load, schema
from ledgerline.streaming import Replay, late_windows, sessions, windowed_trend

T0 = dt.datetime(2024, 1, 1)


def batch(spark, rows):
    """Rows (event_id, minutes after T0, user, type, value)."""
    return spark.createDataFrame(
        [(i, None if m is None else T0 + dt.timedelta(minutes=m), u, k, v, None)
         for i, m, u, k, v in rows], schema("events"))


def trend_rows(df):
    return sorted(((r.period - T0).total_seconds() / 3600, r.event_type, r.events, r.value)
                  for r in df.collect())


def test_late_rows_are_dropped_counted_and_windows_written_once(spark):
    replay = Replay(spark, schema("events"), windowed_trend, "test-trend")
    first = batch(spark, [(1, 10, 1, "a", 1.0), (2, 70, 1, "a", 2.0), (3, 300, 1, "b", 4.0),
                          (4, None, 1, "a", 9.0)])
    assert replay.watermark is None and late_windows(first, replay.watermark).isEmpty()
    replay.arrive(first)
    # The watermark is 300 - 120 minutes: hours 0 and 1 are closed.
    assert replay.watermark == (T0 + dt.timedelta(hours=3) - dt.datetime(1970, 1, 1)
                                ) // dt.timedelta(microseconds=1)
    assert trend_rows(replay.table()) == [(0, "a", 1, 1), (1, "a", 1, 2)]
    second = batch(spark, [(5, 119, 1, "a", 8.0), (6, 240, 1, "b", 16.0), (7, 600, 1, "b", 1.0)])
    late = late_windows(second, replay.watermark).collect()
    assert [(r.period, r.event_type, r.late_events) for r in late] == [
        (T0 + dt.timedelta(hours=1), "a", 1)]
    replay.arrive(second)
    assert trend_rows(replay.table()) == [
        (0, "a", 1, 1), (1, "a", 1, 2), (4, "b", 1, 16), (5, "b", 1, 4)]
    # Only the open window is held, and a run without new files adds nothing.
    assert replay.state_rows == 1
    replay.run()
    assert replay.table().count() == 4


def test_the_trend_report_holds_late_rows(spark):
    rows = reports.REPORTS["stream_event_trend"](spark, SF_SMALL).collect()
    events = load(spark, SF_SMALL)["events"].count()
    assert sum(r.late_events for r in rows) > 0
    assert 0.9 * events < sum(r.events for r in rows) < events


def session_rows(df):
    return sorted((r.user_id, (r.session_start - T0).total_seconds() / 60,
                   (r.session_end - T0).total_seconds() / 60, r.events, float(r.value))
                  for r in df.collect())


def test_sessions_close_by_timer_and_their_state_expires(spark):
    replay = Replay(spark, schema("events"), lambda s: sessions(s, 60, "30 minutes"), "test-sessions")
    replay.arrive(batch(spark, [(1, 0, 1, "a", 1.0), (2, 50, 1, "a", None), (3, 0, 2, "a", 2.5),
                                (4, 0, None, "a", 1.0), (5, None, 1, "a", 1.0)]))
    assert session_rows(replay.table()) == [] and replay.state_rows == 2
    # User 1 goes on in time; user 2 says nothing more, a timer closes it.
    replay.arrive(batch(spark, [(6, 100, 1, "a", 1.0), (7, 110.5, 3, "a", 1.0)]))
    assert session_rows(replay.table()) == [(2, 0, 0, 1, 2.5)] and replay.state_rows == 2
    # An earlier event of user 1 that is not late joins the open session.
    replay.arrive(batch(spark, [(8, 99, 1, "a", 4.0), (9, 10, 1, "a", 99.0), (10, 1000, 9, "a", 1.0)]))
    assert session_rows(replay.table()) == [
        (1, 0, 100, 4, 6.0), (2, 0, 0, 1, 2.5), (3, 110.5, 110.5, 1, 1.0)]
    assert replay.state_rows == 1


def test_out_of_order_rows_join_two_open_sessions(spark):
    replay = Replay(spark, schema("events"), lambda s: sessions(s, 60, "10 hours"), "test-sessions")
    replay.arrive(batch(spark, [(1, 0, 1, "a", 1.0), (2, 100, 1, "a", 1.0)]))
    replay.arrive(batch(spark, [(3, 50, 1, "a", 1.0)]))
    replay.arrive(batch(spark, [(4, 5000, 2, "a", 1.0)]))
    assert session_rows(replay.table()) == [(1, 0, 100, 3, 3.0)]


@pytest.mark.parametrize("parts", [1, 3])
def test_a_hot_user_in_any_order_of_arrival(spark, parts):
    """Half of all events are one user's; the sessions do not depend on how the
    rows of a batch are dealt."""
    rnd = random.Random(5)
    times = sorted(rnd.sample(range(0, 20_000), 600))
    rows = [(i, m, 1 if i % 2 else rnd.randrange(2, 40), "a", 1.0) for i, m in enumerate(times)]
    replay = Replay(spark, schema("events"), lambda s: sessions(s, 60, "30 minutes"), "test-sessions")
    for k in range(3):
        part = [r for r in rows if k * 7000 <= r[1] < (k + 1) * 7000]
        rnd.shuffle(part)
        replay.arrive(batch(spark, part).repartition(parts))
    replay.arrive(batch(spark, [(9999, 50_000, 99, "a", 1.0)]))
    want = {}
    for _, m, user, _, _ in sorted(rows, key=lambda r: r[1]):
        own = want.setdefault(user, [])
        if own and m - own[-1][-1] <= 60:
            own[-1].append(m)
        else:
            own.append([m])
    assert session_rows(replay.table()) == sorted(
        (u, s[0], s[-1], len(s), float(len(s))) for u, own in want.items() for s in own)


def test_users_of_one_bucket_keep_their_own_sessions(spark):
    """One state for all users gives the sessions of a state for each."""
    rnd = random.Random(7)
    rows = [(i, rnd.randrange(3000), rnd.randrange(30), "a", 1.0) for i in range(900)]
    rows += [(i + 1000, m, 30 + i, "a", 2.0) for i, m in enumerate([0, 60, 121, 3000])]
    got, states = [], []
    for buckets in (1, 100_000):
        replay = Replay(spark, schema("events"),
                        lambda s, b=buckets: sessions(s, 60, "30 minutes", b), "test-sessions")
        for k in range(3):
            replay.arrive(batch(spark, [r for r in rows if k * 1000 <= r[1] < (k + 1) * 1000]))
            states.append(replay.state_rows)
        replay.arrive(batch(spark, [(9999, 50_000, 99, "a", 1.0)]))
        states.append(replay.state_rows)
        got.append(session_rows(replay.table()))
    assert got[0] == got[1] and sum(r[3] for r in got[0]) >= 890
    assert states[:4] == [1, 1, 1, 1] and max(states[4:7]) > 10


def test_a_batch_has_no_more_states_than_buckets(spark):
    """The calls of the state function, and so its time, do not grow with the users."""
    replay = Replay(spark, schema("events"), lambda s: sessions(s, buckets=8), "test-sessions")
    replay.arrive(batch(spark, [(i, i % 60, i, "a", 1.0) for i in range(300)]))
    assert replay.state_rows == 8
