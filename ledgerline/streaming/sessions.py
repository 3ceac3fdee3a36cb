"""Sessions of a user: arbitrary state with event-time timers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ._time import as_clock, as_instant

MINUTE = 60_000_000


#: Groups of users that share a state.  A checkpoint keeps the number it began with.
BUCKETS = 2048


def merged(spans: np.ndarray, gap: int) -> np.ndarray:
    """Rows (user, first, last, events, cents) of one user joined where one begins
    within ``gap`` of another's end; in order of user and time."""
    if not len(spans):
        return spans
    spans = spans[np.lexsort((spans[:, 1], spans[:, 0]))]
    ends = pd.Series(spans[:, 2]).groupby(spans[:, 0]).cummax().to_numpy()
    at = np.flatnonzero(np.r_[True, (spans[1:, 0] != spans[:-1, 0])
                              | (spans[1:, 1] - ends[:-1] > gap)])
    return np.stack([spans[at, 0], spans[at, 1], np.maximum.reduceat(spans[:, 2], at),
                     np.add.reduceat(spans[:, 3], at), np.add.reduceat(spans[:, 4], at)], axis=1)


def sessions(events: DataFrame, gap_minutes: int = 360, delay: str = "2 hours",
             buckets: int = BUCKETS) -> DataFrame:
    """user_id, session_start, session_end, events, value of every session.

    A session ends when a user does nothing for ``gap_minutes``.  Every batch of
    rows is first combined to one row per (user, minute), before the shuffle, so
    the state of a hot user sees far fewer rows than it has events.  A state
    holds the open sessions of the users of one bucket (``buckets`` by a hash of
    the user), so a batch calls Python once a bucket and not once a user; raise
    ``buckets`` for more than some ten million users with open sessions.  A
    session is written, and leaves the state, when the watermark (the end of the
    largest minute of earlier batches less ``delay``) shows that no event can
    still extend it, by a timer if no user of the bucket sends anything more.  Events of minutes that the watermark has reached are
    dropped as late.  Rows without user or ``ts`` have no session.
    """
    gap = gap_minutes * MINUTE
    cents = (F.col("value").cast("decimal(12,2)") * 100).cast("long")

    def combined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield (pdf.groupby(["user_id", "minute"], as_index=False)
                   .agg(first=("at", "min"), last=("at", "max"), n=("at", "size"),
                        cents=("cents", "sum")))

    minutes = (events.where("ts IS NOT NULL AND user_id IS NOT NULL")
               .withColumn("at", F.unix_micros(as_instant("ts")))
               .select("user_id", F.floor(F.col("at") / MINUTE).alias("minute"), "at",
                       F.coalesce(cents, F.lit(0)).alias("cents"))
               .mapInPandas(combined, "user_id long, minute long, first long, last long, "
                                      "n long, cents long")
               .withColumn("bucket", F.pmod(F.xxhash64("user_id"), F.lit(buckets)))
               .withColumn("seen", F.timestamp_micros((F.col("minute") + 1) * MINUTE))
               .withWatermark("seen", delay))

    def step(key: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = [np.frombuffer(state.get[0], np.int64).reshape(-1, 5)] if state.exists else []
        for pdf in rows:
            held.append(pdf[["user_id", "first", "last", "n", "cents"]].to_numpy(np.int64))
        spans = merged(np.concatenate(held), gap) if held else np.zeros((0, 5), np.int64)
        # Events still to come are not before the watermark, a full minute.
        known = state.getCurrentWatermarkMs() * 1000
        over = spans[:, 2] + gap < known
        if over.all():
            state.remove()
        else:
            open_ = spans[~over]
            state.update((open_.tobytes(),))
            first = int(open_[:, 2].min()) + gap
            state.setTimeoutTimestamp((first // MINUTE + 1) * MINUTE // 1000 - 1)
        yield pd.DataFrame(spans[over], columns=["user_id", "first", "last", "events", "cents"])

    out = "user_id long, first long, last long, events long, cents long"
    return (minutes.groupBy("bucket")
            .applyInPandasWithState(step, out, "open binary", "append",
                                    GroupStateTimeout.EventTimeTimeout)
            .select("user_id", as_clock("first").alias("session_start"),
                    as_clock("last").alias("session_end"), "events",
                    (F.col("cents") / F.lit(100).cast("decimal(3,0)")).cast("decimal(18,2)")
                    .alias("value")))
