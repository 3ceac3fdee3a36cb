"""Operator 3: mixing sources to target weights by subset-sum budget fitting.

1. Sizes (words) of all documents go to a narrow table on the shared folder.
2. Targets: sources in code point order (null last) weigh 1, 2, 3, repeating;
   they share the total size by weight, no target above ``repeat`` times its
   source's size, the excess shared again by weight.
3. Budgets: a source gives ``floor(target / size)`` whole rounds; the rest is a
   budget that a subset of its documents fills (few documents that leave a gap
   are taken unequally often).  Documents are counted by exact
   length; every length first gives its proportional part, then single
   documents, and bounded-knapsack dynamic programming fits the last words.
   Where that leaves a gap, which only few or very long documents do, the sets
   of all reachable sums are merged document by document, whatever their length;
   they are thinned out only where they would pass ``SUMS`` entries in all.
4. Picks: within a (source, length) class the documents with the smallest
   seeded hashes of id and text are taken.  Classes are cut into sub-classes of
   about ``SUB_CLASS`` rows by the hash, so no window holds a hot class; rows
   without id are told apart by their place in their file.

The table of sources is collected (one row a source, at most ``MAX_SOURCES``,
else an error); a source's counts by length are fitted in one task and number
at most its distinct lengths.

Defined results: null text has size 0; documents of size 0 are never taken; a
null source is a source of its own; rows that repeat id, text and source are
separate documents that are picked in any order; ids may be null, repeat and be
of any type; an empty table gives an empty result; extra columns are ignored by
``mix`` and kept by ``apply_mix``, which takes every row as often as planned for
that row.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, identified, staged, text_or_empty

WEIGHTS = (1, 2, 3)
REPEAT = 3
SEED = 20
MAX_SOURCES = 100_000
SUB_CLASS = 2_000
#: Words that the dynamic programming fits as a last step.
DP_WORDS = 1 << 16
#: Entries that the sets of reachable sums may hold in all.
SUMS = 1 << 23


def targets(sizes: Sequence[int], weights: Sequence[float], repeat: int = REPEAT) -> list[float]:
    """Share the total of ``sizes`` by ``weights``, each at most ``repeat``
    times its size; what is above is shared again among the others."""
    total, caps = sum(sizes), [repeat * s for s in sizes]
    out = [0.0] * len(sizes)
    open_, left = [i for i in range(len(sizes)) if caps[i] > 0], float(total)
    while open_:
        unit = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if weights[i] * unit >= caps[i]]
        if not full:
            for i in open_:
                out[i] = weights[i] * unit
            break
        for i in full:
            out[i] = float(caps[i])
            left -= caps[i]
        open_ = [i for i in open_ if i not in set(full)]
    return out


def fill(sizes: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each size to take, in all near ``budget`` words
    and never above it.  ``sizes`` are distinct."""
    sizes, counts = sizes.astype(np.int64), counts.astype(np.int64)
    total = int((sizes * counts).sum())
    if budget <= 0 or total <= 0:
        return np.zeros(len(sizes), np.int64)
    if budget >= total:
        return np.where(sizes > 0, counts, 0)
    exact = np.where(sizes > 0, counts * (budget / total), 0)
    # Few documents may leave a gap: then less is given by proportion.
    tries = []
    for share in (1.0, 0.5, 0.0):
        tries.append(_fill_from(sizes, counts, budget, exact, np.floor(exact * share)))
        if int((sizes * tries[-1]).sum()) == budget:
            break
    else:
        tries.append(_from_sums(sizes, counts, budget))
    return max(tries, key=lambda took: int((sizes * took).sum()))


def _fill_from(sizes, counts, budget, exact, base) -> np.ndarray:
    took = base.astype(np.int64)
    rest = budget - int((sizes * took).sum())
    # One more of the lengths that the rounding cut most, then of the longest.
    for i in np.argsort(-(exact - took), kind="stable"):
        if rest <= DP_WORDS:
            break
        if 0 < sizes[i] <= rest and took[i] < counts[i]:
            took[i] += 1
            rest -= int(sizes[i])
    for i in np.argsort(-sizes, kind="stable"):
        if rest <= DP_WORDS or sizes[i] <= 0:
            break
        more = min(int(counts[i] - took[i]), rest // int(sizes[i]))
        took[i] += more
        rest -= more * int(sizes[i])
    for i, k in _subset_sum(sizes, counts - took, min(rest, DP_WORDS)):
        took[i] += k
    return took


def _from_sums(sizes, counts, budget) -> np.ndarray:
    """The best subset by the set of all sums up to ``budget`` that documents can
    reach, the longest documents first; exact unless the sets are thinned."""
    use = [i for i in np.argsort(-sizes, kind="stable") if 0 < sizes[i] <= budget and counts[i]]
    parts = []                              # numbers of a length in powers of two
    for i in use:
        left, part = min(int(counts[i]), budget // int(sizes[i])), 1
        while left:
            parts.append((i, min(part, left)))
            left, part = left - parts[-1][1], part * 2
    most = max(1024, SUMS // max(1, len(parts)))
    reach, steps = np.zeros(1, np.int64), []
    for i, k in parts:
        new = reach + int(sizes[i]) * k
        steps.append((i, k, reach))
        reach = np.union1d(reach, new[new <= budget])
        if len(reach) > most:               # the largest sum of every part of the budget
            slot = reach // (budget // most + 1)
            reach = reach[np.append(slot[1:] != slot[:-1], True)]
        if reach[-1] == budget:
            break
    took, at = np.zeros(len(sizes), np.int64), int(reach[-1])
    for i, k, before in reversed(steps):
        if before[np.searchsorted(before, at) % len(before)] != at:
            took[i] += k
            at -= int(sizes[i]) * k
    rest = budget - int((sizes * took).sum())
    for i, k in _subset_sum(sizes, counts - took, min(rest, DP_WORDS)):
        took[i] += k
    return took


def copies(sizes: np.ndarray, counts: np.ndarray, target: float, repeat: int) -> np.ndarray:
    """How often the documents of each size are taken in all, at most ``repeat``
    times each, near ``target`` words: whole rounds over all documents and a
    subset once more; where that leaves a gap, fewer rounds and more copies."""
    total = int((sizes * counts).sum())
    rounds = min(repeat, int(target // total)) if total else 0
    best = None
    for low, most in [(rounds, rounds + 1), *((r, repeat) for r in range(rounds, -1, -1))]:
        budget, limit = round(target) - low * total, counts * (min(most, repeat) - low)
        units = np.where(sizes > 0, low * counts + fill(sizes, limit, budget), 0)
        gap = round(target) - int((sizes * units).sum())
        if best is None or gap < best[0]:
            best = gap, units
        if gap <= 0:
            break
    return best[1].astype(np.int64)


def _subset_sum(sizes: np.ndarray, counts: np.ndarray, budget: int) -> list[tuple[int, int]]:
    """Bounded knapsack: (index, number) whose sum is the largest within
    ``budget``.  Sums are bits of an integer; counts are split in powers of
    two; the search ends as soon as the budget itself can be reached."""
    reach, mask, steps = 1, (1 << (budget + 1)) - 1, []
    for i in np.argsort(sizes, kind="stable"):
        size = int(sizes[i])
        if size <= 0 or size > budget:
            continue
        left, part = min(int(counts[i]), budget // size), 1
        while left > 0 and not reach >> budget & 1:
            k = min(part, left)
            steps.append((int(i), k, reach))
            reach |= reach << (size * k) & mask
            left, part = left - k, part * 2
    at, used = reach.bit_length() - 1, []
    for i, k, before in reversed(steps):
        if not before >> at & 1:
            used.append((i, k))
            at -= int(sizes[i]) * k
    return used


def _source_key():
    return F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("src")


def _classes(narrow: DataFrame, weights: Sequence[float], repeat: int) -> DataFrame:
    """src, size, n, source_size, target, rounds, extra: what each class gives."""
    found = (narrow.groupBy("src").agg(F.sum("size").alias("total"))
             .limit(MAX_SOURCES + 1).collect())
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    found.sort(key=lambda r: (r.src == "", r.src))
    total = [int(r.total) for r in found]
    share = targets(total, [weights[i % len(weights)] for i in range(len(found))], repeat)
    plan = {r.src: (s, t) for r, s, t in zip(found, total, share)}

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        size, target = plan[group["src"].iloc[0]]
        group = group.sort_values("size", ignore_index=True)
        units = copies(group["size"].to_numpy(), group["n"].to_numpy(), target, repeat)
        return group.assign(source_size=size, target=target, rounds=units // group["n"],
                            extra=units % group["n"])

    return (narrow.groupBy("src", "size").agg(F.count(F.lit(1)).alias("n")).groupBy("src")
            .applyInPandas(fit, "src string, size long, n long, source_size long, "
                                "target double, rounds long, extra long"))


def _mixed(docs: DataFrame, weights: Sequence[float], repeat: int, seed: int) -> DataFrame:
    """doc_id, size, source_size, target, taken, _file and _index for every row of
    ``docs``, which is identified."""
    spark = docs.sparkSession
    told = F.when(F.col("doc_id").isNull(), F.col("_index")).otherwise(F.lit(0))
    rows = docs.select(
        "doc_id", _source_key(), "_file", "_index",
        F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64(F.lit(seed), F.col("doc_id"), text_or_empty(), told).alias("u"))
    narrow = staged(spark, rows, "mix-sizes")
    classes = staged(spark, _classes(narrow, weights, repeat), "mix-classes")
    rows = (narrow.join(classes, ["src", "size"])
            .withColumn("subs", F.ceil(F.col("n") / SUB_CLASS))
            # 31 bits of the hash, scaled to the number of sub-classes
            .withColumn("sub", F.expr("shiftright(shiftrightunsigned(u, 33) * subs, 31)")))
    key = ["src", "size", "sub"]
    before = (Window.partitionBy("src", "size").orderBy("sub")
              .rowsBetween(Window.unboundedPreceding, -1))
    quota = (rows.where("extra > 0").groupBy(*key)
             .agg(F.count(F.lit(1)).alias("m"), F.first("extra").alias("want"))
             .select(*key, (F.col("want") - F.coalesce(F.sum("m").over(before), F.lit(0)))
                     .alias("quota")))
    order = Window.partitionBy(*key).orderBy("u", "_file", "_index")
    picked = (rows.withColumn("rank", F.row_number().over(order))
              .join(quota, key, "left")
              .withColumn("pick", (F.col("rank") <= F.coalesce("quota", F.lit(0))).cast("int")))
    return picked.select("doc_id", "size", "source_size", "target",
                         ((F.col("rounds") + F.col("pick")) * F.col("size")).alias("taken"),
                         "_file", "_index")


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, repeat: int = REPEAT,
        seed: int = SEED) -> DataFrame:
    """doc_id, size, source_size, target, taken for every row."""
    return _mixed(identified(docs), weights, repeat, seed).drop("_file", "_index")


def apply_mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, repeat: int = REPEAT,
              seed: int = SEED) -> DataFrame:
    """The rows of ``docs`` that the mix takes, with all their columns, each as
    often as it is taken."""
    own = identified(docs)
    taken = (_mixed(own, weights, repeat, seed).where("taken > 0")
             .select("_file", "_index", (F.col("taken") / F.col("size")).cast("int").alias("_copies")))
    return (own.join(taken, ["_file", "_index"])
            .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
            .select(*docs.columns))
