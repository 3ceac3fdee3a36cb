"""Cleaning, preprocessing and validation (CLN-0 ... CLN-10).

Each step is a plain DataFrame -> DataFrame function on built-in functions.
``clean`` chains them: standardise text, cast safely, drop exact duplicates
(optionally keep one row per key), then split rows into accepted and
rejected with the first failing reason.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._util import as_list

REASON = "reject_reason"


# -- CLN-1 / CLN-2: duplicates --------------------------------------------------

def drop_exact_dups(df: DataFrame) -> DataFrame:
    """CLN-1: drop rows equal in every column (hash aggregate with map-side dedup)."""
    return df.distinct()


def _parse_order(order) -> list[tuple[str, bool]]:
    """``["a", ("b", "desc")]`` -> [("a", False), ("b", True)] (True = descending)."""
    out = []
    for item in as_list(order) if isinstance(order, str) else list(order):
        if isinstance(item, str):
            out.append((item, False))
        else:
            name, direction = item
            if direction.lower() not in ("asc", "desc"):
                raise ValueError(f"direction must be asc or desc, got {direction!r}")
            out.append((name, direction.lower() == "desc"))
    return out


def dedup_by_key(df: DataFrame, keys, order) -> DataFrame:
    """CLN-2: keep one row per ``keys``: the first by ``order``.

    ``order`` lists columns, each a name (ascending) or ``(name, "asc"|"desc")``.
    The remaining columns break any tie, in the same direction as the last
    order column, so the kept row is always the same.  Nulls are smallest.

    ``row_number() = 1``: Spark plans a group limit before the shuffle, which
    cuts a key with many copies to one row per map task.
    """
    keys = as_list(keys)
    spec = _parse_order(order)
    if not spec:
        raise ValueError("order must name at least one column")
    named = [n for n, _ in spec]
    rest = [c for c in df.columns if c not in keys and c not in named]
    last_desc = spec[-1][1]
    cols = [F.col(n).desc() if d else F.col(n).asc() for n, d in spec]
    cols += [F.col(c).desc() if last_desc else F.col(c).asc() for c in rest]
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*cols))
    return df.withColumn("_rn", first).filter(F.col("_rn") == 1).drop("_rn")


# -- CLN-3 / CLN-4 / CLN-5: standardise, cast, nulls -------------------------------

def standardise_text(df: DataFrame, cols, case: str | None = "upper") -> DataFrame:
    """CLN-3: trim ``cols``, fix their case, and turn blank strings into null."""
    def fix(c: str) -> Column:
        v = F.trim(F.col(c))
        if case == "upper":
            v = F.upper(v)
        elif case == "lower":
            v = F.lower(v)
        elif case is not None:
            raise ValueError("case must be 'upper', 'lower' or None")
        return F.nullif(v, F.lit(""))
    return df.withColumns({c: fix(c) for c in as_list(cols)})


def cast_safe(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """CLN-4: cast text columns; values that do not parse become null.

    ``try_cast`` keeps the job alive under ANSI mode, where a plain cast of
    a bad value raises.  Text is trimmed first.
    """
    return df.withColumns({c: F.trim(F.col(c).cast("string")).try_cast(t)
                           for c, t in types.items()})


def handle_nulls(df: DataFrame, fill: Mapping[str, object] | None = None,
                 require: Sequence[str] | None = None) -> DataFrame:
    """CLN-5: replace nulls in ``fill`` columns, then drop rows null in ``require``."""
    if fill:
        df = df.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType))
                             for c, v in fill.items()})
    if require:
        df = df.na.drop(how="any", subset=list(require))
    return df


# -- CLN-6 / CLN-7 / CLN-8: validation --------------------------------------------

@dataclass(frozen=True)
class DomainRule:
    """A value check: ``lo <= column <= hi`` and/or ``column in allowed``.

    A null value fails the rule (it cannot be shown to be valid)."""
    name: str
    column: str
    lo: object = None
    hi: object = None
    allowed: tuple = ()

    def ok(self) -> Column:
        c = F.col(self.column)
        cond = c.isNotNull()
        if self.lo is not None:
            cond = cond & (c >= F.lit(self.lo))
        if self.hi is not None:
            cond = cond & (c <= F.lit(self.hi))
        if self.allowed:
            cond = cond & c.isin(list(self.allowed))
        return cond


def check_domain(df: DataFrame, rules: Sequence[DomainRule], only_failures: bool = True,
                 out: str = "violation") -> DataFrame:
    """CLN-6: name the first rule each row breaks in ``out`` (null if none)."""
    label = None
    for r in rules:
        label = (F.when(~r.ok(), F.lit(r.name)) if label is None
                 else label.when(~r.ok(), F.lit(r.name)))
    res = df.withColumn(out, label if label is not None else F.lit(None).cast("string"))
    return res.filter(F.col(out).isNotNull()) if only_failures else res


def _pairs(on) -> list[tuple[str, str]]:
    return [(c, c) if isinstance(c, str) else tuple(c) for c in as_list(on)] \
        if not isinstance(on, str) else [(on, on)]


def orphans(child: DataFrame, parent: DataFrame, on) -> DataFrame:
    """CLN-7: rows of ``child`` with no matching row in ``parent`` (left anti join).

    ``on``: column names shared by both, or ``(child_col, parent_col)`` pairs.
    """
    pairs = _pairs(on)
    # The parent is cut to its distinct keys first: the map-side dedup
    # collapses a hot key (AQE can split a skewed *left* side of an anti
    # join, never the right one) and only key columns are shuffled.
    keys = parent.select(*[F.col(b).alias(f"_p{i}") for i, (_, b) in enumerate(pairs)]).distinct()
    cond = None
    for i, (a, _) in enumerate(pairs):
        c = child[a] == keys[f"_p{i}"]
        cond = c if cond is None else cond & c
    return child.join(keys, cond, "left_anti")


def check_dates(child: DataFrame, parent: DataFrame, on, child_date: str, parent_date: str,
                summary: bool = True) -> DataFrame:
    """CLN-8: child rows dated before their parent (e.g. shipped before ordered).

    With ``summary`` one row: ``rows_checked`` (child rows with a parent) and
    ``rows_failed``; otherwise the failing child rows.  Only the key and
    date columns of the parent are read.  A child row is checked once: where
    parent rows share a key, against the latest of their dates.
    """
    pairs = _pairs(on)
    # One row a key; the join reuses the aggregate's partitioning.
    p = (parent.groupBy(*[F.col(b).alias(f"_p_{b}") for _, b in pairs])
         .agg(F.max(parent_date).alias("_p_date")))
    cond = None
    for a, b in pairs:
        c = child[a] == p[f"_p_{b}"]
        cond = c if cond is None else cond & c
    joined = child.join(p, cond, "inner")
    bad = F.col(child_date) < F.col("_p_date")
    if summary:
        return joined.agg(F.count(F.lit(1)).alias("rows_checked"),
                          F.count(F.when(bad, True)).alias("rows_failed"))
    return joined.filter(bad).select(*child.columns)


# -- CLN-9 / CLN-0: split and the whole pipeline -------------------------------------

def split(df: DataFrame, checks: Sequence[tuple[str, str]], reason_col: str = REASON,
          checkpoint: bool = False):
    """CLN-9: (accepted, rejected).  ``checks`` = [(reason, SQL predicate of a bad row)].

    A rejected row carries the first reason whose predicate is true.  Both
    outputs come from one labelled plan; with ``checkpoint`` the labelled rows
    are written to the session's reliable checkpoint folder first (eager), so
    both read that copy, and a lost executor does not send the job back to the
    raw input.
    """
    labelled = label_rejects(df, checks, reason_col)
    if checkpoint:
        from ..session import ensure_checkpoint_dir
        ensure_checkpoint_dir(labelled.sparkSession)
        labelled = labelled.checkpoint(eager=True)
    accepted = labelled.filter(F.col(reason_col).isNull()).drop(reason_col)
    rejected = labelled.filter(F.col(reason_col).isNotNull())
    return accepted, rejected


def label_rejects(df: DataFrame, checks: Sequence[tuple[str, str]],
                  reason_col: str = REASON) -> DataFrame:
    """Add ``reason_col``: the first check whose predicate is true, else null.

    A predicate that evaluates to null counts as passed.
    """
    label = None
    for reason, predicate in checks:
        bad = F.coalesce(F.expr(predicate), F.lit(False))
        label = F.when(bad, F.lit(reason)) if label is None else label.when(bad, F.lit(reason))
    return df.withColumn(reason_col, label if label is not None else F.lit(None).cast("string"))


@dataclass(frozen=True)
class CleanRules:
    """What ``clean`` does, in order.

    text:   columns to trim / upper-case / blank-to-null
    casts:  column -> Spark SQL type, cast with ``try_cast``
    keys, order: if ``keys`` is set, keep one row per key (``dedup_by_key``)
    checks: (reason, SQL predicate marking a bad row), first match wins
    """
    text: tuple = ()
    casts: Mapping[str, str] = field(default_factory=dict)
    keys: tuple = ()
    order: tuple = ()
    checks: tuple = ()


def standardised(raw: DataFrame, rules: CleanRules) -> DataFrame:
    """CLN-3 + CLN-4 + CLN-1 (+ CLN-2): the cleaned rows before the checks."""
    df = standardise_text(raw, list(rules.text)) if rules.text else raw
    if rules.casts:
        df = cast_safe(df, rules.casts)
    df = drop_exact_dups(df)
    if rules.keys:
        df = dedup_by_key(df, list(rules.keys), list(rules.order))
    return df


def clean(raw: DataFrame, rules: CleanRules, checkpoint: bool = False):
    """CLN-0: clean raw rows end to end; returns (accepted, rejected).

    ``checkpoint`` is passed to ``split``.
    """
    return split(standardised(raw, rules), list(rules.checks), checkpoint=checkpoint)


def reject_counts(rejected: DataFrame, reason_col: str = REASON) -> DataFrame:
    """Rows per reject reason (``reason``, ``rows``)."""
    return rejected.groupBy(F.col(reason_col).alias("reason")).agg(F.count(F.lit(1)).alias("rows"))


# -- CLN-10: profile ------------------------------------------------------------------

def profile(df: DataFrame, cols=None) -> DataFrame:
    """CLN-10: per column: rows, nulls, distinct values, min and max (as text).

    Two passes over the input, however many columns: one global aggregate for
    counts and bounds (in the column's own type, then cast to text), and one
    over (column, value) pairs for the exact distinct counts, which map-side
    combining cuts to each task's distinct values before the shuffle.
    """
    cols = as_list(cols) or df.columns

    def value(c: str) -> Column:
        # 0.0 and -0.0 are one value
        v = F.col(c) + F.lit(0.0) if df.schema[c].dataType.typeName() in ("float", "double") \
            else F.col(c)
        return v.cast("string")

    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), value(c).alias("value")) for c in cols])).alias("p"))
    distinct = (pairs.select("p.*").filter(F.col("value").isNotNull()).distinct()
                .groupBy("column").agg(F.count(F.lit(1)).alias("distinct_values")))
    facts = df.agg(*[F.struct(
        F.lit(c).alias("column"), F.count(F.lit(1)).alias("rows"),
        (F.count(F.lit(1)) - F.count(F.col(c))).alias("nulls"),
        F.min(F.col(c)).cast("string").alias("min_value"),
        F.max(F.col(c)).cast("string").alias("max_value")).alias(f"s{i}")
        for i, c in enumerate(cols)])
    rows = facts.select(F.explode(F.array(*[f"s{i}" for i in range(len(cols))])).alias("s"))
    return (rows.select("s.*").join(distinct, "column", "left")
            .select("column", "rows", "nulls",
                    F.coalesce("distinct_values", F.lit(0).cast("bigint")).alias("distinct_values"),
                    "min_value", "max_value"))
