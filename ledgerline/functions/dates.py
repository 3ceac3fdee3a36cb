"""Calendar helpers.  All periods are ``date`` values (first day of the period)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

GRAINS = ("day", "month", "year")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def period_start(c: str | Column, grain: str) -> Column:
    """First day of the ``grain`` period holding date ``c`` (a ``date``)."""
    if grain == "day":
        return _col(c).cast("date")
    if grain in ("month", "year"):
        return F.trunc(_col(c), grain)
    raise ValueError(f"grain must be one of {GRAINS}, got {grain!r}")


def period_step(grain: str) -> Column:
    """Interval between two consecutive periods, for ``F.sequence``."""
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}, got {grain!r}")
    return F.expr(f"INTERVAL 1 {grain.upper()}")


def month_index(start: str | Column, end: str | Column) -> Column:
    """Whole calendar months from ``start`` to ``end`` (int).

    Plain year/month arithmetic: 31 Jan -> 1 Feb is 1, unlike
    ``months_between``, which truncates it to 0.
    """
    s, e = _col(start), _col(end)
    return ((F.year(e) - F.year(s)) * 12 + (F.month(e) - F.month(s))).cast("int")
