"""Money columns.

Amounts are decimals so that sums are exact whatever the partition order;
double sums would differ run to run on a cluster.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# Fixed types: one line amount, and any sum of amounts.
AMOUNT = DecimalType(18, 4)
TOTAL = DecimalType(28, 4)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def line_revenue(price: str | Column, discount: str | Column) -> Column:
    """Net line revenue: price (2 decimals) times (1 - discount (2 decimals)).

    Typed so the product is exactly ``DECIMAL(18,4)``: (12,2) x (5,2) has 18
    digits and 4 decimals, so no wider intermediate has to be checked and
    narrowed on every row.  The value is exact either way.
    """
    p = _col(price).cast(DecimalType(12, 2))
    d = _col(discount).cast(DecimalType(4, 2))
    one = F.lit(1).cast(DecimalType(3, 2))
    return (p * (one - d)).cast(AMOUNT)


def money_sum(c: str | Column) -> Column:
    """Exact sum of an amount column, as ``TOTAL``."""
    return F.sum(_col(c)).cast(TOTAL)
