"""Operator 8: document fingerprints by a homomorphic multiset hash.

Every paragraph (line) is hashed to a wide vector and a document's fingerprint
is the sum of its paragraphs' vectors: equality lanes modulo 2^64, filled from
a 512-bit digest of the paragraph, and likeness lanes modulo 2^32, in which
each run of 16 bytes of the paragraph adds +1 or -1 to one lane.  The order of
paragraphs does not matter, and paragraphs are inserted or deleted by adding
or subtracting their vectors (``insert``, ``delete``).  Likeness is 1 for equal
fingerprints, else the cosine of the likeness lanes within 0 and 0.999999:
near the share of text that two documents have in common, with a standard
error of about 1/16 (256 lanes).

The edited text of a document takes its end from the document that follows in
descending doc_id.  Rows are dealt to slices of doc_id whose bounds come from
approximate percentiles (so a slice is a pure function of the row), sorted, and
read in a stream; a doc_id that would fill several slices, or the rows without
one, is cut by the hash of the text that orders its rows; the largest row of a slice also goes to the slice above, and
the largest of all to the lowest, so each text is shuffled about once and no
task holds more than its slice's batch.

Defined results: null text is empty; the empty text is one empty paragraph;
doc_ids are integers (else an error); null doc_ids come last; rows with the same
doc_id follow each other in the order of their texts' hashes; one row alone follows itself; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from .common import bounded_batches, identified, partitions, text_or_empty

EQUAL_LANES = 8
LIKE_LANES = 256
RUN = 16                    # bytes
CHUNK = 1 << 20             # runs hashed at once
NULL_ID = -2**63            # order of null doc_ids: below all others
_K1, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class Fingerprint:
    """Sum of paragraph vectors; supports + and - of other fingerprints."""

    __slots__ = ("equal", "like")

    def __init__(self, equal: np.ndarray, like: np.ndarray):
        self.equal, self.like = equal, like

    def __add__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.equal + other.equal, self.like + other.like)

    def __sub__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.equal - other.equal, self.like - other.like)

    def __str__(self) -> str:
        return (self.equal.astype("<u8").tobytes().hex()
                + base64.b64encode(self.like.astype("<u4").tobytes()).decode())

    @staticmethod
    def parse(text: str) -> Fingerprint:
        cut = EQUAL_LANES * 16
        return Fingerprint(np.frombuffer(bytes.fromhex(text[:cut]), "<u8").astype(np.uint64),
                           np.frombuffer(base64.b64decode(text[cut:]), "<u4").astype(np.uint32))


def of_paragraphs(paragraphs: list[bytes]) -> Fingerprint:
    """The sum of the vectors of some paragraphs (UTF-8)."""
    digests = b"".join(hashlib.blake2b(p, digest_size=8 * EQUAL_LANES).digest()
                       for p in paragraphs)
    equal = (np.frombuffer(digests, "<u8").astype(np.uint64)
             .reshape(-1, EQUAL_LANES).sum(axis=0, dtype=np.uint64))
    # Line feeds around every paragraph keep runs of two paragraphs apart.
    pad = b"\n" * (RUN - 1)
    data = pad + pad.join(paragraphs) + pad
    n = len(data) - RUN + 1
    low = np.ndarray((n,), "<u8", data, strides=(1,))
    high = np.ndarray((n,), "<u8", data, offset=8, strides=(1,))
    bins = np.zeros(2 * LIKE_LANES, np.int64)
    for at in range(0, n, CHUNK):
        mixed = low[at:at + CHUNK] * _K1 ^ high[at:at + CHUNK] * _K2
        mixed ^= mixed >> np.uint64(29)
        mixed *= _K1
        bins += np.bincount((mixed >> np.uint64(55)).astype(np.int64), minlength=2 * LIKE_LANES)
    like = (bins[0::2] - bins[1::2]).astype(np.uint32)
    return Fingerprint(equal, like)


def of_text(text: str) -> Fingerprint:
    return of_paragraphs(text.encode("utf-8").split(b"\n"))


def insert(mark: Fingerprint, paragraphs: list[bytes]) -> Fingerprint:
    return mark + of_paragraphs(paragraphs) if paragraphs else mark


def delete(mark: Fingerprint, paragraphs: list[bytes]) -> Fingerprint:
    return mark - of_paragraphs(paragraphs) if paragraphs else mark


def likeness(a: Fingerprint, b: Fingerprint) -> float:
    if np.array_equal(a.equal, b.equal) and np.array_equal(a.like, b.like):
        return 1.0
    x, y = a.like.view(np.int32).astype(float), b.like.view(np.int32).astype(float)
    size = np.sqrt((x @ x) * (y @ y))
    return float(min(0.999999, max(0.0, (x @ y) / size))) if size else 0.0


def edited(text: str, following: str) -> tuple[str, int]:
    """The edited text, and where its first touched paragraph begins."""
    tail = len(text) // 3
    head = text[:len(text) - tail]
    return head + following[:tail], head.rfind("\n") + 1


def _key():
    return F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NULL_ID))


def _order():
    """Order of rows of one doc_id: by their texts, rows without id also by their
    place in their file."""
    place = F.when(F.col("doc_id").isNull(), F.col("_index")).otherwise(F.lit(0))
    return F.xxhash64(text_or_empty(), place)


class Slices:
    """Slices of the descending order of (doc_id, order of its rows).

    ``cuts`` are quantiles of doc_id, upper bounds of the slices but the last.
    A doc_id that is several quantiles holds that many slices, cut evenly by the
    hash that orders its rows.
    """

    def __init__(self, cuts: list[int]):
        self.keys, self.first, self.times = np.unique(
            np.array(cuts, np.int64), return_index=True, return_counts=True)
        self.number = len(cuts) + 1
        self.hot = bool((self.times > 1).any())

    def of(self, key: np.ndarray, order: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.keys, key, side="left")
        out = np.where(at < len(self.keys), np.append(self.first, 0)[at], self.number - 1)
        if len(self.keys):
            at = np.minimum(at, len(self.keys) - 1)
            times = self.times[at].astype(np.uint64)
            # The last of a doc_id, by its hash, is in its lowest slice.
            share = ~(order.astype(np.int64).view(np.uint64) ^ np.uint64(2**63)) >> np.uint64(32)
            out += np.where(self.keys[at] == key, share * times >> np.uint64(32), 0).astype(np.int64)
        return out


def _lent(rows: DataFrame, slices: Slices, column) -> dict[tuple[int, int], tuple[int, int]]:
    """The largest row (doc_id, hash) of every slice, with the next slice that has
    rows; for the largest of all, the lowest slice.  At most a row a slice."""
    tops = (rows.select("k", "g", column.alias("slice"))
            .groupBy("slice").agg(F.max(F.struct("k", (-1 - F.col("g")).alias("g"))).alias("top"))
            .collect())
    tops = sorted((r.slice, (r.top.k, -1 - r.top.g)) for r in tops)
    return {top: (tops[(i + 1) % len(tops)][0], 1 if i + 1 < len(tops) else 2)
            for i, (_, top) in enumerate(tops)}


def following_pairs(docs: DataFrame, slices: int | None = None) -> DataFrame:
    """Rows (doc_id, text, kind) dealt and sorted so that the row after each
    one of kind 0 in its partition is the one that follows it."""
    spark = docs.sparkSession
    n = slices or partitions(spark)
    rows = identified(docs).select("doc_id", text_or_empty().alias("text"), _key().alias("k"),
                                   _order().alias("g"))
    cuts, top = rows.agg(F.percentile_approx("k", [i / n for i in range(1, n)] or [0.5],
                                             max(10_000, 10 * n)), F.max("k")).first()
    own = Slices((cuts or []) if n > 1 else [])

    @F.pandas_udf("int")
    def number(k: pd.Series, g: pd.Series) -> pd.Series:
        return pd.Series(own.of(k.to_numpy(), g.to_numpy()).astype(np.int32))

    # Where no doc_id fills a slice, the quantiles are the slices' largest rows.
    lent = _lent(rows, own, number("k", "g")) if own.hot else None
    above = dict(zip(own.keys.tolist(), (own.first + own.times).tolist()))

    @F.pandas_udf("array<struct<slice:int,kind:int>>")
    def places(key: pd.Series, order: pd.Series) -> pd.Series:
        out = []
        for s, k, g in zip(own.of(key.to_numpy(), order.to_numpy()).tolist(), key.tolist(),
                           order.tolist()):
            made = [{"slice": s, "kind": 0}]
            if lent is not None:
                if (k, g) in lent:
                    made.append(dict(zip(("slice", "kind"), lent[k, g])))
            else:
                if k in above:
                    made.append({"slice": above[k], "kind": 1})
                if k == top:
                    made.append({"slice": 0, "kind": 2})
            out.append(made)
        return pd.Series(out)

    dealt = (rows.withColumn("place", F.explode(places("k", "g")))
             .select("doc_id", "text", "k", "g", "place.slice", "place.kind"))
    return (dealt.repartitionById(own.number, F.col("slice"))
            .sortWithinPartitions("kind", F.col("k").desc(), "g"))


def fingerprints(docs: DataFrame, slices: int | None = None) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next for every row."""
    if not isinstance(docs.schema["doc_id"].dataType, IntegralType):
        raise TypeError("doc_id must be an integer")
    bounded_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, "
              "edited_fingerprint string, near_edited double, near_next double")

    def row(held, following):
        (doc_id, text, own), (_, next_text, other) = held, following
        new, start = edited(text, next_text)
        changed = insert(delete(own, text[start:].encode("utf-8").split(b"\n")),
                         new[start:].encode("utf-8").split(b"\n"))
        return (doc_id, len(text), hashlib.sha256(new.encode("utf-8")).hexdigest(), str(own),
                str(changed), likeness(own, changed), likeness(own, other))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, names = None, None
        for batch in batches:
            names = names or [f.strip().split(" ")[0] for f in schema.split(",")]
            ids, texts, kinds = (batch.column(i).to_pylist() for i in range(3))
            made = []
            for doc_id, text, k in zip(ids, texts, kinds):
                if k and held is None:
                    break                   # nothing waits for a borrowed row
                now = (doc_id, text, of_text(text))
                if held is not None:
                    made.append(row(held, now))
                held = None if k else now
            if made:
                types = [batch.schema.field(0).type, pa.int64(), *[pa.string()] * 3,
                         *[pa.float64()] * 2]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*made), types)], names=names)

    return following_pairs(docs, slices).select("doc_id", "text", "kind").mapInArrow(run, schema)
