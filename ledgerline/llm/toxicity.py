"""Operator 9: toxicity by compression distance.

Two zstandard dictionaries are trained on labelled rows: both hold the same
ordinary text, the toxic one also the most telling words of every toxic row.  A
text is cut into windows of ``WINDOW`` words, overlapping by half, and every
window is compressed with each dictionary; a window that the toxic dictionary
compresses better by some bytes is suspicious.  The beginnings of words are
written in capitals, so that a beginning and the same letters within a word do
not match.  The differences of all windows of a text (largest, second largest,
how many and which share reach some thresholds, number of windows) give the
score by a logistic curve, calibrated on training rows that the dictionaries
have not seen and shifted so that 0.5 is the threshold of best F1 there.

Training, on rows whose crc32(doc_id as text) mod 5 is not 0 and a bounded
sample of at most about ``MAX_TOXIC`` toxic and ``MAX_CLEAN`` other rows, chosen
by a hash of doc_id, of a text longer than ``TEXT_CHARS`` characters that many in
``SLICES`` evenly spread slices:

- A run of ``RUN`` bytes is telling if it is so much more frequent in toxic rows
  that not one run would be so by chance; its weight is the logarithm of the
  ratio.  There is no least share of rows, so a small language or genre has its
  own runs.  Every toxic row gives the ``ROW_WORDS`` words of the largest weights,
  in turns, to the toxic dictionary; the heaviest come last (cheapest to reach).
- Ordinary windows, and in some rounds those that still look suspicious, are the
  common part of both dictionaries, without words of a weight of ``OWN`` or more.

Labels, lang, source and doc_id are no inputs of a score.

Defined results: null and empty texts have no window and get the score of no
evidence; without a training row of both kinds every score is 0; texts are
scored whole, their windows made a piece at a time; null doc_ids are scored, not held out and not learned from;
documents may have no label, a label or several (the largest counts); rows with
equal texts have equal scores; repeated rows give a row each; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain, zip_longest

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, text_or_empty, text_pieces

WINDOW = 6
STRIDE = 3
LEVEL = 3
MAX_TOXIC = 1200
MAX_CLEAN = 2400
COMMON_BYTES = 32_000
MARKED_BYTES = 16_000
ROW_WORDS = 4
HARD_WINDOWS = 250
ROUNDS = 3
RUN, MOST_RUNS = 6, 3       # bytes of a run; how often one counts in a row
OWN = 2.0
BEGINNING = 4
#: Characters of a training text; a longer one gives as many slices, spread evenly.
TEXT_CHARS, SLICES = 32_768, 8


def _words(text: str) -> list[str]:
    return [w[:BEGINNING].upper() + w[BEGINNING:] for w in text.lower().split()]


def windows(text: str) -> list[bytes]:
    """The text in windows of ``WINDOW`` words that overlap by half, lower
    case but for the beginnings of words, single blanks."""
    return list(chain.from_iterable(window_blocks(text)))


def window_blocks(text: str) -> Iterator[list[bytes]]:
    """The windows of a text, a piece of it at a time."""
    words: list[str] = []
    some = False

    def made(starts: range) -> list[bytes]:
        return [f" {' '.join(words[i:i + WINDOW])} ".encode("utf-8", "replace") for i in starts]

    for piece in text_pieces(text):
        if whole := range(0, len(words) - WINDOW + 1, STRIDE):
            yield made(whole)
            words, some = words[whole[-1] + STRIDE:], True
        words += _words(piece)
    if words:
        yield made(range(0, max(0 if some else 1, len(words) - WINDOW + STRIDE), STRIDE))


def _runs(part: bytes) -> np.ndarray:
    """The runs of ``RUN`` bytes, as numbers."""
    n = max(0, len(part) - RUN + 1)
    return np.ndarray((n,), "<u8", part + bytes(8), strides=(1,)) & np.uint64(2 ** (8 * RUN) - 1)


class Telling:
    """Weights of the runs that tell toxic rows."""

    def __init__(self, toxic: list[str], clean: list[str]):
        made = [self._counts(t) for t in toxic]
        keys, at = np.unique(np.concatenate([k for k, _ in made]), return_inverse=True)
        n = np.bincount(at, np.concatenate([c for _, c in made]), len(keys))
        other = np.ones(len(keys))
        for t in clean:
            k, c = self._counts(t)
            at = np.minimum(np.searchsorted(keys, k), max(0, len(keys) - 1))
            if len(keys):
                hit = keys[at] == k
                other[at[hit]] += c[hit]
        expected = other * len(toxic) / len(clean)
        weight = np.log(n / expected)
        # Half the deviance of a Poisson count: below 1 / len(keys) by chance.
        keep = (weight > 0) & (n * weight - (n - expected) > np.log(max(1, len(keys))))
        self.keys, self.weights = keys[keep], weight[keep]
        self.known: dict[bytes, float] = {}

    @staticmethod
    def _counts(text: str) -> tuple[np.ndarray, np.ndarray]:
        k, c = np.unique(_runs(f" {' '.join(_words(text))} ".encode("utf-8", "replace")),
                         return_counts=True)
        return k, np.minimum(c, MOST_RUNS)

    def weight(self, word: bytes) -> float:
        """Largest weight of a run of the word (0: none is telling)."""
        if word not in self.known:
            runs = _runs(b" " + word + b" ")
            at = np.searchsorted(self.keys, runs)
            at[at == len(self.keys)] = 0
            hit = self.keys[at] == runs if len(self.keys) else np.zeros(len(runs), bool)
            self.known[word] = float(self.weights[at[hit]].max(initial=0.0))
        return self.known[word]

    def words(self, text: str) -> list[tuple[float, bytes]]:
        """The ``ROW_WORDS`` words of the largest weights."""
        words = {w.encode("utf-8", "replace") for w in _words(text)}
        return sorted(((x, w) for w in words if (x := self.weight(w)) > 0),
                      reverse=True)[:ROW_WORDS]

    def ordinary(self, part: bytes) -> bytes:
        """The window without words that belong to the toxic part."""
        return b" " + b" ".join(w for w in part.split(b" ") if w and self.weight(w) < OWN) + b" "


class Compressor:
    """Lengths of windows under one dictionary."""

    def __init__(self, content: bytes):
        data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        data.precompute_compress(level=LEVEL)
        self.compress = zstandard.ZstdCompressor(
            level=LEVEL, dict_data=data, write_content_size=False, write_checksum=False,
            write_dict_id=False).compress

    def lengths(self, parts: list[bytes]) -> np.ndarray:
        return np.fromiter(map(len, map(self.compress, parts)), np.int64, len(parts))


class Pair:
    """The two dictionaries' compressors."""

    def __init__(self, common: bytes, marked: bytes):
        self.common, self.marked = common, marked
        self.ordinary, self.toxic = Compressor(common), Compressor(common + marked)

    def gains(self, parts: list[bytes]) -> np.ndarray:
        """Bytes that the toxic dictionary saves on each window."""
        return self.ordinary.lengths(parts) - self.toxic.lengths(parts)

    def evidence(self, text: str) -> np.ndarray:
        top, by_gain = np.zeros(2, np.int64), np.zeros(7, np.int64)
        for parts in window_blocks(text):
            gains = self.gains(parts)
            top = np.sort(np.concatenate([top, gains]))[:-3:-1]
            by_gain += np.bincount(np.clip(gains, 0, 6), minlength=7)
        reach = by_gain[::-1].cumsum()[::-1]        # windows that gain 0, 1, ... at least
        counts = [np.log1p(reach[t]) for t in (3, 4, 5, 6)]
        shares = [np.log1p(20 * reach[t] / max(reach[0], 8)) for t in (2, 3, 5)]
        return np.array([1.0, top[0] / 4, top[1] / 4, *counts, np.log1p(reach[0]) / 4, *shares])


class Model:
    def __init__(self, common: bytes, marked: bytes, weights: np.ndarray):
        self.common, self.marked, self.weights = common, marked, weights
        self.pair = None

    def __getstate__(self):
        return {"common": self.common, "marked": self.marked, "weights": self.weights,
                "pair": None}

    def score(self, text: str) -> float:
        if not len(self.weights):
            return 0.0
        if self.pair is None:           # compressors are made where they are used
            self.pair = Pair(self.common, self.marked)
        x = float(self.pair.evidence(text) @ self.weights)
        return 1 / (1 + np.exp(-min(30.0, max(-30.0, x))))


def _logistic(x: np.ndarray, y: np.ndarray, pull: float = 0.01) -> np.ndarray:
    """Weights of least logistic loss (Newton steps, weakly pulled to zero)."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) / len(y) + pull * w
        hess = (x * (p * (1 - p))[:, None]).T @ x / len(y) + pull * np.eye(len(w))
        w = w - np.linalg.solve(hess, grad)
    return w


def train(rows: list[tuple[str, int]]) -> Model:
    """Learn from (text, label 0/1) rows; a third of them calibrates."""
    nothing = Model(b"", b"", np.zeros(0))
    fit = [r for i, r in enumerate(rows) if i % 3 != 2]
    toxic, clean = [t for t, y in fit if y], [t for t, y in fit if not y]
    if not toxic or not clean:
        return nothing
    telling = Telling(toxic, clean)
    # Every toxic row gives its best word, then every one its second ...
    picked, size = {}, 0
    for found in chain.from_iterable(zip_longest(*map(telling.words, toxic))):
        if found and found[1] not in picked:
            size += len(found[1]) + 1
            if size > MARKED_BYTES:
                break
            picked[found[1]] = found[0]
    marked = b" " + b" ".join(sorted(picked, key=lambda w: (picked[w], w))) + b" "
    # The common part: windows of ordinary rows, spread evenly over each.
    parts = [windows(t) for t in clean]
    each = -(-COMMON_BYTES // (len(parts) * 45))
    some = [p[i] for p in parts if p
            for i in np.unique(np.linspace(0, len(p) - 1, min(each, len(p))).astype(int))]
    size, common = 0, []
    for at in np.random.default_rng(3).permutation(len(some)):
        size += len(some[at])
        if size > COMMON_BYTES:
            break
        common.append(telling.ordinary(some[at]))
    all_clean = [w for p in parts for w in p]
    pair = Pair(b"".join(common), marked)
    for _ in range(ROUNDS):
        gains = pair.gains(all_clean)
        worst = (telling.ordinary(all_clean[i])
                 for i in np.argsort(-gains, kind="stable") if gains[i] >= 3)
        hard = [w for _, w in zip(range(HARD_WINDOWS), filter(bytes.strip, worst))]
        if not hard:
            break
        common += dict.fromkeys(hard)
        pair = Pair(b"".join(common), marked)
    held = [r for i, r in enumerate(rows) if i % 3 == 2] or fit
    if len({y for _, y in held}) < 2:
        held = rows
    x = np.array([pair.evidence(t) for t, _ in held])
    y = np.array([label for _, label in held], float)
    weights = _logistic(x, y)
    z = x @ weights
    cuts = np.unique(z)
    f1 = [2 * (y * (z >= c)).sum() / max(1e-9, y.sum() + (z >= c).sum()) for c in cuts]
    at = int(np.argmax(f1))
    below = cuts[at - 1] if at else cuts[at] - 1.0
    weights[0] -= (cuts[at] + below) / 2
    return Model(pair.common, pair.marked, weights)


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, max_toxic: int = MAX_TOXIC,
        max_clean: int = MAX_CLEAN) -> Model:
    """Learn from a bounded sample of the labelled training rows."""
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out())
             .groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic")))
    n = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(n) < 2:
        return train([])
    share = F.when(F.col("toxic") == 1, max_toxic / n[1]).otherwise(max_clean / n[0])
    draw = F.expr("shiftrightunsigned(xxhash64(47, doc_id), 11)") / F.lit(float(2**53))
    # At most about max_toxic + max_clean narrow rows.
    drawn = F.broadcast(known.where(draw < share))
    long, each = F.char_length("text"), TEXT_CHARS // SLICES
    sliced = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(SLICES - 1)), lambda i: F.substring(
        F.col("text"), (i * ((long - each) / (SLICES - 1)) + 1).cast("int"), F.lit(each))), " ")
    rows = (docs.select("doc_id", text_or_empty().alias("text")).join(drawn, "doc_id")
            .select("doc_id", F.when(long > TEXT_CHARS, sliced).otherwise(F.col("text")).alias("text"),
                    "toxic").collect())
    rows.sort(key=lambda r: (zlib.crc32(str(r.doc_id).encode()), r.text))
    return train([(r.text, r.toxic) for r in rows])


def score(docs: DataFrame, labels: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    bounded_batches(docs.sparkSession)
    own = model or fit(docs, labels)

    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([own.score(t) for t in texts], dtype=float)

    return (docs.select("doc_id", held_out().alias("held_out"),
                        scores(text_or_empty()).alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))
