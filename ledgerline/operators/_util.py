"""Small DataFrame helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_list(cols) -> list[str]:
    if cols is None:
        return []
    if isinstance(cols, str):
        return [cols]
    return list(cols)


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str],
                   how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where null matches null (``<=>``).

    Output has the key columns once (taken from the left side for inner /
    left joins) followed by the other columns of both sides.
    """
    keys = list(keys)
    r = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond: Column | None = None
    for k in keys:
        c = left[k].eqNullSafe(r[f"__r_{k}"])
        cond = c if cond is None else cond & c
    joined = left.join(r, cond, how) if cond is not None else left.join(r, how=how)
    return joined.drop(*[f"__r_{k}" for k in keys])
