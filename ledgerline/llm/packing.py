"""Operator 13: packing documents into sequences by exact-complement hashing.

1. Every text becomes its token ids and an end id; longer ones are cut into
   pieces of ``CAPACITY`` ids, the last of which may be shorter.  Each task
   numbers its pieces by length while it writes them.
2. The plan needs only how many pieces of each length there are (at most
   ``CAPACITY`` numbers).  It opens a sequence with the longest length left and
   looks the gap up in tables of single, pair and triple sums of the lengths
   that are available; a combination that fills the gap exactly is consumed as
   often as the counts allow, at once.  Where no such combination exists, the
   best-fitting length goes in and the rest of the gap is looked up again.
3. A length's pieces are numbered over the whole table (numbers within a task,
   shifted by the tasks before it), and a number says which copy of which
   pattern a piece belongs to, so pieces find their place without a window over
   a hot length.

Defined results: null and empty texts are the end id alone; repeated rows and
ids are packed each; a text of any length is encoded whole, a megabyte at a
time; special tokens' strings are their ids; pieces of the same length may
change places between runs only if the input files do; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import string
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from .common import bounded_batches, staged, text_or_empty
from .merges import merge_words
from .token_count import WordCounter, cut, groups, lower

CAPACITY = 4096
END = 1
TAIL = ".,;:!?"
ALNUM = frozenset(string.ascii_letters + string.digits)


class WordIds(WordCounter):
    """The ids of texts with one word-level vocabulary file."""

    def __init__(self, path: str):
        super().__init__(path)
        self.memo: dict[str, bytes] = {}

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        """The ids of every piece: merged together, a line each."""
        text = "\n".join(pieces)
        words = self.pre.findall(lower(text if text.isascii() else unicodedata.normalize("NFC", text)))
        gap = np.fromiter(("\n".__eq__(w) for w in words), bool, len(words))
        owner = np.cumsum(gap)[~gap]
        raw = "".join(words).replace("\n", "").encode("utf-8")
        if not raw:
            return [b""] * len(pieces)
        flat = np.frombuffer(raw, np.uint8)
        chars = np.fromiter(map(len, words), np.int64, len(words))[~gap]
        at = np.append(np.flatnonzero((flat & 0xC0) != 0x80), len(flat))
        ends = at[np.cumsum(chars)]
        sym = self.first[flat]
        sym[ends - 1] = self.last[flat[ends - 1]]
        ids, merged = merge_words(sym, np.diff(ends, prepend=0), self.table)
        counts = np.bincount(owner, weights=merged, minlength=len(pieces)).astype(np.int64)
        data, cut = ids.astype("<u4").tobytes(), (4 * np.cumsum(counts)).tolist()
        return list(map(data.__getitem__, map(slice, [0, *cut], cut)))

    def _learn(self, parts: list[str]) -> None:
        # Punctuation after a letter or digit is a pre-token of its own, so words
        # that differ only in it are merged once.
        bare = [p.rstrip(TAIL) for p in parts]
        tailed = [(p, b) for p, b in zip(parts, bare) if len(b) < len(p) and b and b[-1] in ALNUM
                  and "<|" not in b]
        plain = set(parts).difference(p for p, _ in tailed)
        plain.update(b for _, b in tailed)
        plain.update(p[len(b):] for p, b in tailed)
        odd = {p for p in plain if "<|" in p}
        fresh = list(plain.difference(self.memo, odd))
        made = self._pieces(fresh) if fresh else []
        memo = self.memo
        memo.update(zip(fresh, made))
        for p, b in tailed:
            memo[p] = memo[b] + memo[p[len(b):]]
        self.held += 2 * sum(map(len, made)) + 200 * (len(fresh) + len(tailed))
        if odd:
            # Special tokens stand between the pieces of a part.
            for p in odd:
                ids = self._pieces(self.special.split(p) if self.special else [p])
                names = self.special.findall(p) if self.special else []
                self.memo[p] = ids[0] + b"".join(
                    np.array([self.table.special[s]], "<u4").tobytes() + i
                    for s, i in zip(names, ids[1:]))
                self.held += len(self.memo[p]) + 200

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        out: list[list[bytes]] = [[] for _ in texts]
        for group in groups(texts):
            # Lower case before the cut leaves fewer parts; special tokens' own
            # case counts.
            parts = [cut(t.lower() if t.isascii() and "<|" not in t else t) for _, t in group]
            self.meet(parts)
            for (i, _), own in zip(group, parts):
                out[i].append(b"".join(map(self.memo.__getitem__, own)))
        return [b"".join(x) if len(x) != 1 else x[0] for x in out]


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and the task's number (``part``)
    with the piece's number among those of its length there (``own``)."""
    bounded_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = _parse_datatype_string(
        f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, part int, own long")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, seen = WordIds(vocabulary), np.zeros(capacity + 1, np.int64)
        part = TaskContext.get().partitionId()
        last = np.array([end], "<u4").tobytes()
        for batch in batches:
            names, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            out: list[tuple] = []
            for name, data in zip(names, coder.encode(texts)):
                data += last
                for k, at in enumerate(range(0, len(data), 4 * capacity)):
                    ids = data[at:at + 4 * capacity]
                    n = len(ids) // 4
                    out.append((name, k, at // 4, n, zlib.crc32(ids), part, int(seen[n])))
                    seen[n] += 1
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, f.type) for v, f in zip(zip(*out), arrow)], schema=arrow)

    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(run, schema)


def _exact(have: np.ndarray, gap: int) -> list[int] | None:
    """One, two or three available lengths whose sum is ``gap``; ``have`` holds
    the number left of every length, 0 to the capacity.  The first that fits of
    single, pair and triple, each with the longest length possible."""
    if have[gap] > 0:
        return [gap]
    pair = _pair(have, gap)
    if pair:
        return pair
    for a in np.flatnonzero(have[:gap + 1])[::-1]:
        a = int(a)
        if 3 * a < gap:
            break
        have[a] -= 1
        rest = _pair(have, gap - a) if gap > a else None
        have[a] += 1
        if rest:
            return [a, *rest]
    return None


def _pair(have: np.ndarray, total: int) -> list[int] | None:
    """Two available lengths with this sum, the longer as long as possible."""
    low = np.arange(1, total // 2 + 1)
    fits = (have[low] > 0) & (have[total - low] > 0)
    if total % 2 == 0 and len(low):
        fits[-1] = have[total // 2] > 1
    hit = np.flatnonzero(fits)
    return [total - int(low[hit[0]]), int(low[hit[0]])] if len(hit) else None


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """How to pack ``counts[length]`` pieces of every length: (number of
    sequences, [(length, how many of it in each)]), a row for each pattern."""
    have, out = counts.astype(np.int64).copy(), []
    have[0] = 0
    longest = capacity
    while True:
        while longest and not have[longest]:
            longest -= 1
        if not longest:
            return out
        have[longest] -= 1
        used, gap = [longest], capacity - longest
        while gap:
            exact = _exact(have, gap)
            if exact:
                for x in exact:
                    have[x] -= 1
                used += exact
                break
            fits = np.flatnonzero(have[:gap + 1])
            if not len(fits):
                break
            best = int(fits[-1])
            # While the gap holds it twice over, no exact filling is near.
            many = int(max(1, min(have[best], gap // best - 3)))
            have[best] -= many
            used += [best] * many
            gap -= best * many
        lengths, each = np.unique(used, return_counts=True)
        # The same pattern as often as what is left allows.
        again = int((have[lengths] // each).min())
        have[lengths] -= again * each
        out.append((again + 1, [(int(a), int(b)) for a, b in
                                zip(lengths[::-1], each[::-1])]))


def _places(patterns) -> dict[str, np.ndarray]:
    """The plan by length: from which number on (``begin``) pieces of ``length``
    are dealt to sequences from ``first`` on, ``each`` to a sequence, at
    ``offset``; sorted by (length, begin)."""
    rows, first = [], 0
    dealt: dict[int, int] = {}
    for times, own in patterns:
        offset = 0
        for length, each in own:
            begin = dealt.get(length, 0)
            rows.append((length, begin, first, each, offset))
            dealt[length] = begin + times * each
            offset += length * each
        first += times
    cols = np.array(sorted(rows), np.int64).reshape(-1, 5).T
    return dict(zip(("length", "begin", "first", "each", "offset"), cols))


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset per piece."""
    spark = docs.sparkSession
    cut = staged(spark, pieces(docs, vocabulary, capacity, end), "packing-pieces")
    per = cut.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    earlier = (Window.partitionBy("length").orderBy("part")
               .rowsBetween(Window.unboundedPreceding, -1))
    shift = staged(spark, per.select("part", "length", "n", F.coalesce(
        F.sum("n").over(earlier), F.lit(0)).alias("shift")), "packing-shifts")
    counts = np.zeros(capacity + 1, np.int64)
    for r in shift.groupBy("length").agg(F.sum("n").alias("n")).collect():   # at most capacity rows
        counts[r.length] = r.n
    place = _places(plan(counts, capacity))
    schema = _parse_datatype_string("sequence_id long, offset long")
    kept = [f for f in cut.schema.fields if f.name not in ("part", "own")]
    out = type(schema)([*kept, *schema.fields])
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Plans are sorted by (length, begin): one key for both.
        step = int(max(place["begin"], default=0)) + 1
        keys = place["length"] * step + place["begin"]
        for batch in batches:
            length = batch.column("length").to_numpy()
            number = batch.column("number").to_numpy()
            want = length * step + np.minimum(number, step - 1)
            at = np.searchsorted(keys, want, side="right") - 1
            since = number - place["begin"][at]
            each = place["each"][at]
            made = [place["first"][at] + since // each, place["offset"][at] + since % each * length]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(f.name) for f in kept], *map(pa.array, made)], schema=arrow)

    return (cut.join(shift.select("part", "length", "shift"), ["part", "length"])
            .select(*[f.name for f in kept], (F.col("own") + F.col("shift")).alias("number"))
            .mapInArrow(run, out))
