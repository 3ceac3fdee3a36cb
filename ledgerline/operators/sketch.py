"""Mergeable sketches: distinct counts and quantiles kept as states.

A state table has one row per finest group (a day and a category, say).  States
are merged for any coarser group or slice without reading the rows again, which
exact distinct counts and medians cannot do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._util import as_list

#: HyperLogLog of 2^12 registers: a standard error of 1.6 %.
LG_REGISTERS = 12
#: KLL of 400 items: the rank of a quantile is off by 0.7 % in 99 of 100 cases.
ITEMS = 400


def distinct_states(df: DataFrame, by, col: str, lg: int = LG_REGISTERS) -> DataFrame:
    """``by`` groups with ``state``: a sketch of the distinct values of ``col``.

    Nulls are no values.  Types that have no sketch of their own count by their
    text.  Map tasks send one state a group, so a hot group is combined before the
    shuffle.
    """
    own = df.schema[col].dataType.typeName() in ("integer", "long", "string", "binary")
    value = F.col(col) if own else F.col(col).cast("string")
    return df.groupBy(*as_list(by)).agg(F.hll_sketch_agg(value, lg).alias("state"))


def merge_distinct(states: DataFrame, by=()) -> DataFrame:
    """States merged to coarser groups (all rows if ``by`` is empty)."""
    return states.groupBy(*as_list(by)).agg(F.hll_union_agg("state").alias("state"))


def distinct_estimate(states: DataFrame, out: str = "distinct_values") -> DataFrame:
    """The states' estimates in place of the states."""
    return states.withColumn(out, F.hll_sketch_estimate("state")).drop("state")


def quantile_states(df: DataFrame, by, col: str, items: int = ITEMS) -> DataFrame:
    """``by`` groups with ``state``: a sketch of the ranks of ``col`` (as double).
    Nulls are no values; a group without a value has none."""
    value = F.col(col).cast("double")
    return (df.where(value.isNotNull()).groupBy(*as_list(by))
            .agg(F.kll_sketch_agg_double(value, items).alias("state")))


def merge_quantiles(states: DataFrame, by=()) -> DataFrame:
    """States merged to coarser groups (all rows if ``by`` is empty)."""
    return states.groupBy(*as_list(by)).agg(F.kll_merge_agg_double("state").alias("state"))


def quantiles(states: DataFrame, shares: dict[str, float]) -> DataFrame:
    """The values at ``shares`` (column name to share between 0 and 1) in place of
    the states."""
    return states.withColumns({
        name: F.kll_sketch_get_quantile_double("state", F.lit(float(q)))
        for name, q in shares.items()}).drop("state")
