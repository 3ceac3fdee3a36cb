"""Operator 4: language identification by hierarchical discrimination.

A text becomes the square roots of its shares of hashed byte trigrams (lower
case, everything but letters turned into blanks).  Linear support vector
machines, one versus one, first choose the language family and then, within
it, the language.  The score multiplies, over both steps, the smallest
calibrated probability of the chosen class against another.

Learning uses the text and label of training rows only: those with a label and
crc32(doc_id as text) mod 4 other than 2.  The sample is bounded: at most about
``PER_LANG`` rows a language and ``MAX_ROWS`` in all, chosen by a hash of
doc_id; three quarters train, one quarter calibrates.  Prediction covers every
row and whole texts, which are read a piece at a time: the trigrams of all pieces,
those across a cut included, are counted together.

Defined results: null texts and texts without a letter are ``und`` with score
0; so is every text if there is no training row; null labels are not learned;
null doc_ids are not held out and not learned; repeated rows give a row each; of
languages with equal votes and probability the first by name is predicted;
an empty table gives an empty result; extra columns are ignored by
``identify`` and kept by ``keep``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import PIECE_CHARS, bounded_batches, map_rows, text_or_empty, text_pieces

BITS = 12
DIMS = 1 << BITS
PER_LANG = 800
MAX_ROWS = 6_000
MAX_LANGS = 500
UNKNOWN = "und"
#: ``keep`` rejects texts below this score, which only coin tosses are.
MIN_SCORE = 0.3
LETTER = re.compile(r"[^\W\d_]")
#: Bytes of lower-cased UTF-8 that are kept; all others become blanks.
_KEPT = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))

#: Families of languages by ISO 639-1 code.
FAMILIES = {
    "germanic": "af da de en fo fy is lb nl nn nb no sv yi",
    "romance": "ca es fr gl it la oc pt rm ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv",
    "celtic": "br cy ga gd",
    "uralic": "et fi hu",
    "turkic": "az kk ky tr tt ug uz",
    "indic": "as bn gu hi mr ne or pa sa si sd ur",
    "iranian": "fa ku ps tg",
    "semitic": "am ar he mt",
    "dravidian": "kn ml ta te",
    "malayic": "id jv ms su tl",
    "sinitic": "zh",
}
_FAMILY = {code: name for name, codes in FAMILIES.items() for code in codes.split()}


def family(lang: str) -> str:
    """The family of a language code; a code that is not listed is its own."""
    return _FAMILY.get(re.split("[-_]", lang.lower())[0], lang)


def features(texts: list[str]) -> np.ndarray:
    """One row a text: square roots of trigram shares, so rows have length 1."""
    out = np.zeros((len(texts), DIMS), np.float32)
    for row, text in zip(out, texts):
        n = np.zeros(DIMS, np.int64)
        for part in _kept(text):
            n += _trigrams(part)
        if n.any():
            row[:] = np.sqrt(n / n.sum())
    return out


def _kept(text: str) -> Iterator[bytes]:
    """The lower-cased words between single blanks, piece by piece; each part
    begins with the last two bytes before it, so every trigram is in one part."""
    held, blank = b"", True
    for piece in text_pieces(text, PIECE_CHARS, 2 * PIECE_CHARS):
        raw = piece.lower().encode("utf-8").translate(_KEPT)
        words = b" ".join(raw.split())
        if words:
            held += (b" " if blank or raw[:1] == b" " else b"") + words
            yield held
            held, blank = held[-2:], False
        blank = blank or raw[-1:] == b" "
    if held:
        yield held + b" "


def _trigrams(part: bytes) -> np.ndarray:
    """Counts of hashed trigrams."""
    b = np.frombuffer(part, np.uint8).astype(np.uint32)
    at = (b[:-2] * np.uint32(0x9E3779B1) ^ b[1:-1] * np.uint32(0x85EBCA6B)
          ^ b[2:] * np.uint32(0xC2B2AE35))
    at ^= at >> np.uint32(15)
    at *= np.uint32(0x2C1B3C6D)
    return np.bincount(at >> np.uint32(32 - BITS), minlength=DIMS)


def _svm(x: np.ndarray, y: np.ndarray, c: float = 30.0, rounds: int = 150) -> np.ndarray:
    """Weights (bias last) of a linear machine with squared hinge loss, the
    classes weighted alike; accelerated gradient descent."""
    # All in the rows' own precision: a wider vector would make numpy copy the
    # whole matrix in every round.
    kind = np.float32
    y = y.astype(kind)
    cost = (np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())) * c).astype(kind)
    norms = np.einsum("ij,ij->i", x, x) + 1
    step = kind(1.0 / (1.0 + 2 * float((cost * norms).sum())))
    w = ahead = np.zeros(x.shape[1] + 1, kind)
    t = 1.0
    for _ in range(rounds):
        slack = np.maximum(kind(0), 1 - y * (x @ ahead[:-1] + ahead[-1]))
        pull = cost * slack * y
        new = ahead - step * (ahead - 2 * np.append(pull @ x, pull.sum()))
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, w, t = (new + kind((t - 1) / t_new) * (new - w)).astype(kind), new, t_new
    return w


def _slope(margins: np.ndarray, y: np.ndarray) -> float:
    """Slope of the logistic curve that turns margins into probabilities."""
    best, least = 4.0, np.inf
    for a in np.geomspace(0.5, 32, 25):
        loss = np.logaddexp(0, -a * y * margins).mean() if len(y) else 0
        if loss < least:
            best, least = float(a), loss
    return best


class Choice:
    """One-versus-one machines among some classes."""

    def __init__(self, names: list[str], x: np.ndarray, labels: np.ndarray, held: np.ndarray):
        self.names, self.pairs, rows, self.slopes = names, [], [], []
        for i, a in enumerate(names):
            for j in range(i + 1, len(names)):
                at = (labels == a) | (labels == names[j])
                y = np.where(labels[at] == a, 1.0, -1.0)
                train, test = ~held[at], held[at]
                if abs(y[train].sum()) == train.sum():
                    train = test = np.ones(len(y), bool)
                w = _svm(x[at][train], y[train])
                self.pairs.append((i, j))
                rows.append(w)
                self.slopes.append(_slope(x[at][test] @ w[:-1] + w[-1], y[test]))
        self.weights = np.array(rows, np.float32).reshape(len(rows), DIMS + 1)

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the chosen class and its probability, by row."""
        k = len(self.names)
        least = np.ones((len(x), k))
        wins = np.zeros((len(x), k))
        if k > 1:
            margins = x @ self.weights[:, :-1].T + self.weights[:, -1]
            for (i, j), m, slope in zip(self.pairs, margins.T, self.slopes):
                p = 1 / (1 + np.exp(-np.clip(slope * m, -30, 30)))
                wins[:, i] += p > 0.5
                wins[:, j] += p <= 0.5
                least[:, i] = np.minimum(least[:, i], p)
                least[:, j] = np.minimum(least[:, j], 1 - p)
        best = np.argmax(wins + least, axis=1)
        return best, least[np.arange(len(x)), best]


class Model:
    """Family machines, and language machines within each family."""

    def __init__(self, x: np.ndarray, langs: list[str]):
        labels = np.array(langs, object)
        kin = np.array([family(v) for v in langs], object)
        held = np.arange(len(langs)) % 4 == 3
        self.top = Choice(sorted(set(kin)), x, kin, held) if langs else None
        self.within = {}
        for name in sorted(set(kin)):
            at = kin == name
            self.within[name] = Choice(sorted(set(labels[at])), x[at], labels[at], held[at])

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        rows = [i for i, t in enumerate(texts) if LETTER.search(t)] if self.top else []
        for begin in range(0, len(rows), 256):
            part = np.array(rows[begin:begin + 256])
            x = features([texts[i] for i in part])
            which, p = self.top.predict(x)
            for k in np.unique(which):
                own = which == k
                choice = self.within[self.top.names[k]]
                best, q = choice.predict(x[own])
                for i, b, s in zip(part[own], best, p[own] * q):
                    langs[i], scores[i] = choice.names[b], float(s)
        return langs, scores


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, per_lang: int = PER_LANG, max_rows: int = MAX_ROWS) -> Model:
    """Learn from a bounded sample of the training rows."""
    rows = (docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
            .select("doc_id", F.col("lang").cast("string").alias("lang"),
                    text_or_empty().alias("text")))
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
              .limit(MAX_LANGS + 1).collect()}
    if len(counts) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    if not counts:
        return Model(np.zeros((0, DIMS), np.float32), [])
    want = max(2, min(per_lang, max_rows // len(counts)))
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, want / n))])
    draw = F.expr("shiftrightunsigned(xxhash64(41, doc_id), 11)") / F.lit(float(2**53))

    def start():
        def work(cols):
            ids, langs, texts = cols
            return [ids, langs, [r.astype(np.float16).tobytes() for r in features(texts)]]
        return work

    # Text without letters teaches nothing.
    some = rows.where((draw < share[F.col("lang")]) & F.col("text").rlike(r"\p{L}"))
    drawn = map_rows(some, [F.col("doc_id").cast("string").alias("doc_id"), F.col("lang"),
                            F.col("text")], "doc_id string, lang string, x binary", start).collect()
    drawn.sort(key=lambda r: (r.doc_id, r.lang, bytes(r.x)))
    x = np.array([np.frombuffer(r.x, np.float16) for r in drawn], np.float32)
    return Model(x.reshape(-1, DIMS), [r.lang for r in drawn])


def predicted(docs: DataFrame, model: Model | None = None) -> Column:
    """The prediction (struct lang, score) of ``docs``' text column."""
    bounded_batches(docs.sparkSession)
    own = fit(docs) if model is None else model

    @F.pandas_udf("lang string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            langs, scores = own.predict(list(texts))
            yield pd.DataFrame({"lang": langs, "score": scores})

    return predict(text_or_empty())


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row."""
    own = fit(docs) if model is None else model

    def start():
        def work(cols):
            ids, held, texts = cols
            return [ids, held, *own.predict(texts)]
        return work

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_rows(docs, [F.col("doc_id"), held_out().alias("held_out"),
                           text_or_empty().alias("text")],
                    f"doc_id {kind}, held_out boolean, lang_pred string, score double", start)


def keep(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The rows whose language is identified, with all their columns."""
    return (docs.withColumn("_langid", predicted(docs))
            .where((F.col("_langid.lang") != UNKNOWN) & (F.col("_langid.score") >= min_score))
            .drop("_langid"))
