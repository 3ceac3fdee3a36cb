"""Safe ratios.  Spark 4 runs ANSI mode, where ``x / 0`` raises."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(num: str | Column, den: str | Column) -> Column:
    """``num / den`` as double, null when ``den`` is 0 or null.

    Exact inputs (decimal sums, counts) are converted once and divided once,
    so the result is bit-identical across engines and partitionings.
    """
    return F.try_divide(_col(num).cast("double"), _col(den).cast("double"))
