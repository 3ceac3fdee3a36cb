"""Operator 11: phrase collocation mining with broadcast double-array tries.

Texts are lower-cased (A-Z), cut into pieces at punctuation and line ends and
into words at blanks and tabs.  Everything is counted per language.

1. Words are counted, and those with ``LEAST`` occurrences get a code; a phrase
   with ``LEAST`` occurrences has no other words.  Codes are unique over
   (language, word), so one trie serves all languages.
2. Texts become arrays of codes on the shared folder; 0 stands for a rare word
   or the end of a piece, so no phrase runs over it.
3. Level by level (2 to ``LONGEST`` words): the Apriori-safe candidates, phrases
   whose first and last words but one are candidates of the level before and
   which can reach ``LEAST`` occurrences, go to the tasks as a double-array
   trie.  numpy moves the states of all text positions one word on at a time,
   bincounts the accepting states and, in the same pass, collects the next
   level's candidates; a task's counts are summed over the shards of the corpus.
4. Scores, the drop of phrases inside longer ones and the ranks are joins and a
   grouped limit over the counted phrases, in exact decimals.

A task and the driver hold one dictionary of at most ``MAX_WORDS`` words or one
trie of at most ``MAX_STATES`` states and ``MAX_PHRASES`` phrases; where there are
more, they are cut by code, phrases also within a first word, and every cut costs
one more pass over the texts or their codes.

Defined results: null texts have no words; a null language is ``und`` (together
with texts that say so); null doc_ids count like others, repeated rows each;
texts of any length are read whole, a megabyte at a time; ties in rank go by
``a`` and then by the phrase; an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, staged, text_or_empty

LEAST = 30
LONGEST = 4
TOP = 2000
#: A phrase inside a longer one that has this share of its occurrences goes.
SHARE = (80, 100)
SCALE = 2_000_000
#: Words of one dictionary and phrases of one trie in a task.
MAX_WORDS = 1_000_000
MAX_PHRASES = 2_000_000
#: States of one trie, counted as if its phrases shared none but the first word.
MAX_STATES = 4_000_000
#: Nodes that look for places in a trie at once.
PLACED = 1 << 16
#: Code points (words) numbered in one window.
NUMBERED = 10_000
#: Bytes of text cut into words at once, and entries of a task's buffers.
CHUNK = 1 << 20
BUFFER = 1 << 20

_UPPER = bytes(range(65, 91))
_ENDS = b".,;:!?\n\x0b\x0c\r"
_TO = bytes.maketrans(_UPPER + _ENDS + b"\t", _UPPER.lower() + b"\n" * len(_ENDS) + b" ")


def words_of(raw: bytes) -> Iterator[list[bytes]]:
    """The words of a text in lists of about ``CHUNK`` bytes; ``\\n`` stands for
    an end of a piece, empty strings for nothing."""
    data, begin = raw.translate(_TO), 0
    while begin < len(data):
        end = data.find(b" ", begin + CHUNK)
        end = len(data) if end < 0 else end
        yield data[begin:end].replace(b"\n", b" \n ").split(b" ")
        begin = end


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                       text_or_empty().cast("binary").alias("raw"))


def count_words(docs: DataFrame) -> DataFrame:
    """lang, word, n for every word of ``docs``."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}
        size = 0

        def flushed():
            for lang, counter in held.items():
                del counter[b""], counter[b"\n"]
                if counter:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(counter)), pa.array(list(counter), pa.binary()),
                         pa.array(list(counter.values()), pa.int64())], ["lang", "word", "n"])
            held.clear()

        for batch in batches:
            for lang, raw in zip(*(c.to_pylist() for c in batch.columns)):
                counter = held.setdefault(lang, Counter())
                for words in words_of(raw):
                    counter.update(words)
                size += len(raw)
                if size > 16 * CHUNK:
                    yield from flushed()
                    size = 0
        yield from flushed()

    found = _texts(docs).mapInArrow(run, "lang string, word binary, n long")
    return (found.groupBy("lang", "word").agg(F.sum("n").alias("n"))
            .withColumn("word", F.col("word").cast("string")))


def numbered(df: DataFrame, name: str, total: int, *key: str) -> DataFrame:
    """``df`` with the dense column ``name`` (1 to ``total``), written first:
    rows are numbered in buckets by hash, buckets start where the last ended."""
    buckets = max(1, math.ceil(total / NUMBERED))
    dealt = df.withColumn("_bucket", F.pmod(F.xxhash64(*key), F.lit(buckets)))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    start = (dealt.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
             .select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")))
    own = F.row_number().over(Window.partitionBy("_bucket").orderBy(*key))
    return (dealt.withColumn("_own", own).join(start, "_bucket")
            .withColumn(name, (F.col("_start") + F.col("_own")).cast("long"))
            .drop("_bucket", "_start", "_own"))


class Dictionary(dict):
    """Codes of (language, word); a piece's end and unknown words are 0, empty
    strings -1."""

    def __init__(self, words=()):
        super().__init__(words)
        self[b""] = -1

    def __missing__(self, word):
        return 0


def coded(docs: DataFrame, words: DataFrame, total: int) -> DataFrame:
    """``codes`` (little-endian 32-bit codes) for each row of ``docs``."""
    spark = docs.sparkSession
    rows = _texts(docs).withColumn("codes", F.lit(None).cast("binary"))
    cuts = max(1, math.ceil(total / MAX_WORDS))
    for k in range(cuts):
        low, high = k * total // cuts, (k + 1) * total // cuts
        sent = part = run = None        # the driver holds the words of one cut
        part = words.where((F.col("code") > low) & (F.col("code") <= high)).select(
            "lang", F.col("word").cast("binary").alias("word"), "code").toArrow()
        # Columns, not rows, go with the function: they are small to send.
        sent = [part.column(c).combine_chunks() for c in ("lang", "word", "code")]
        last = k + 1 == cuts

        def run(batches: Iterator[pa.RecordBatch], sent=sent, last=last):
            known: dict[str, Dictionary] = {}
            for lang, word, code in zip(*(c.to_pylist() for c in sent)):
                known.setdefault(lang, Dictionary())[word] = code
            none = Dictionary()
            for batch in batches:
                langs, raws, before = (c.to_pylist() for c in batch.columns)
                out = []
                for lang, raw, old in zip(langs, raws, before):
                    get = known.get(lang, none).__getitem__
                    made = [np.fromiter(map(get, w), np.int32, len(w)) for w in words_of(raw)]
                    new = np.concatenate(made) if made else np.zeros(0, np.int32)
                    new = new[new >= 0]
                    out.append((new if old is None
                                else np.maximum(new, np.frombuffer(old, "<i4"))).astype("<i4").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([None] * len(out) if last else langs, pa.string()),
                     pa.array([None] * len(out) if last else raws, pa.binary()),
                     pa.array(out, pa.binary())], ["lang", "raw", "codes"])

        rows = staged(spark, rows.mapInArrow(run, "lang string, raw binary, codes binary"),
                      "phrase-codes")
    return rows.select("codes")


class Trie:
    """A double-array trie over sorted, different phrases of equal length.

    A first word with code ``low + c`` is slot ``c + 1`` below the root (slot 0).
    Every further word is ``digits`` steps over the base-256 digits of its code,
    the highest first: from slot ``s`` digit ``d`` leads to ``base[s] + d`` if
    ``check`` there is ``s``.  Where a phrase ends ``base`` holds its number.
    """

    def __init__(self, phrases: np.ndarray, low: int, high: int, digits: int):
        self.low, self.high, self.digits = low, high, digits
        n, self.length = phrases.shape
        first = high - low
        # Logical nodes: 0 to first - 1 are the first words; those below them are
        # the runs of rows that begin alike, so a node's children are neighbours.
        parent, digit, made = [], [], first
        at = (phrases[:, 0] - low).astype(np.int32)
        new = np.diff(at, prepend=-1) != 0
        for p in range(1, self.length):
            for d in reversed(range(digits)):
                step = (phrases[:, p] >> 8 * d & 255).astype(np.uint8)
                new[1:] |= step[1:] != step[:-1]
                parent.append(at[new])
                digit.append(step[new])
                at = np.cumsum(new, dtype=np.int32) + np.int32(made - 1)
                made += len(parent[-1])
        parent = np.concatenate(parent) if parent else np.zeros(0, np.int32)
        digit = np.concatenate(digit) if digit else np.zeros(0, np.uint8)
        base, size = _place(parent, digit, made, first + 1)
        slot = np.concatenate([np.arange(1, first + 1, dtype=np.int32), base[parent] + digit])
        self.check = np.full(size, -1, np.int32)
        self.check[slot[:first]] = 0
        self.check[slot[first:]] = slot[parent]
        self.base = np.zeros(size, np.int32)
        self.base[slot] = base
        self.base[slot[at]] = np.arange(n, dtype=np.int32)

    def positions(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, phrase number) of every place of ``codes`` where a phrase
        begins; ``codes`` ends with ``length`` zeros."""
        at = np.flatnonzero((codes >= self.low) & (codes < self.high))
        state = codes[at] - np.int32(self.low - 1)
        for p in range(1, self.length):
            word = codes[at + p]
            live = word > 0
            at, state, word = at[live], state[live], word[live]
            for d in reversed(range(self.digits)):
                to = self.base[state] + (word >> 8 * d & 255)
                live = self.check[to] == state
                at, state, word = at[live], to[live], word[live]
        return at, self.base[state]


def _place(parent: np.ndarray, digit: np.ndarray, nodes: int, start: int) -> tuple[np.ndarray, int]:
    """Base of every node such that no two children share a slot, and the size;
    ``parent`` is sorted.

    Nodes with many children get 256 slots each.  Those with 2 to 15 try places
    behind these, ``PLACED`` at a time and the larger ones first, until each has
    one; the fewer children, the fuller the slots may be.  Only children take
    what is left free.
    """
    base = np.zeros(nodes, np.int32)
    other = np.ones(len(parent), bool)
    other[1:] = parent[1:] != parent[:-1]
    begin = np.flatnonzero(other).astype(np.int32)
    count = np.diff(begin, append=np.int32(len(parent)))
    owner = parent[begin]
    large = np.flatnonzero(count >= 16)
    base[owner[large]] = start + 256 * np.arange(len(large))
    blocks = 256 * len(large)
    sizes, held = [], 0
    for least, most, filled in ((8, 15, 0.25), (4, 7, 0.4), (2, 3, 0.6)):
        found = np.flatnonzero((count >= least) & (count <= most)).astype(np.int32)
        held += int(count[found].sum())
        sizes.append((found, most, max([256, math.ceil(held / filled), *(x[2] for x in sizes)])))
    # The last 256 are for steps beyond the last child, the first 255 for those
    # of an only child with a high digit.
    region = max(blocks + sizes[-1][2], len(parent)) + 512
    taken = np.zeros(region, bool)
    for b in range(0, len(large), PLACED // 256):
        some = large[b:b + PLACED // 256]
        rows = np.repeat(np.arange(b, b + len(some)) * 256, count[some])
        taken[rows + digit[_ranges(begin[some], count[some])]] = True
    claim = np.zeros(region, np.int32)
    rng = np.random.Generator(np.random.PCG64(11))
    for left, most, places in sizes:
        while len(left):
            failed = []
            for b in range(0, len(left), PLACED // most):
                some = left[b:b + PLACED // most]
                tried = blocks + rng.integers(0, places, len(some), dtype=np.int32)
                group = np.repeat(np.arange(len(some), dtype=np.int32), count[some])
                want = tried[group] + digit[_ranges(begin[some], count[some])]
                # Of those that want a slot, one has it.
                claim[want] = group
                good = (claim[want] == group) & ~taken[want]
                fits = np.bincount(group[~good], minlength=len(some)) == 0
                taken[want[fits[group]]] = True
                base[owner[some[fits]]] = start + tried[fits]
                failed.append(some[~fits])
            left = np.concatenate(failed)
    single = np.flatnonzero(count == 1).astype(np.int32)
    free = np.flatnonzero(~taken[255:region - 256])[:len(single)].astype(np.int32) + 255
    base[owner[single]] = start + free - digit[begin[single]]
    return base, start + region


def _ranges(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers from each ``begin`` on, ``count`` of them, one after the other."""
    before = np.cumsum(count) - count
    return np.arange(int(count.sum())) + np.repeat(begin - before, count)


def _joined(batch: pa.RecordBatch, pad: int) -> np.ndarray:
    """The codes of all rows of a batch, zeros between them."""
    gap = b"\0" * 4 * pad
    return np.frombuffer(gap.join(batch.column(0).to_pylist()) + gap, "<i4")


def sweep(codes: DataFrame, make, whole: bool, grow: bool, least: int) -> DataFrame:
    """One pass of a trie over the texts: rows (grown: false, phrase, n) of its
    phrases and, with ``grow``, rows (grown: true, phrase, next) of the candidates
    one word longer that occur ``least`` times.

    Both travel as one number, below zero for a phrase, so that the many
    candidates of a large corpus are narrow rows.
    """
    bounded_batches(codes.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, n = make()
        counts = np.zeros(n, np.int64)
        grown: list[np.ndarray] = []

        def rows(keys, number):
            return pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(number, pa.int64())], ["key", "n"])

        def flushed():
            keys, number = np.unique(np.concatenate(grown), return_counts=True)
            grown.clear()
            for b in range(0, len(keys), BUFFER // 8):
                yield rows(keys[b:b + BUFFER // 8], np.minimum(number[b:b + BUFFER // 8], least))

        for batch in batches:
            text = _joined(batch, trie.length + 1)
            for begin in range(0, len(text), BUFFER):
                # Overlap: a phrase may begin here and end in the next part.
                part = text[begin:begin + BUFFER + trie.length + 1]
                part = np.concatenate([part, np.zeros(trie.length + 1, part.dtype)])
                at, phrase = trie.positions(part)
                here = at < BUFFER
                counts += np.bincount(phrase[here], minlength=n)
                if grow:
                    found = np.zeros(len(part) + 1, bool)
                    found[at] = True
                    nxt = part[at + trie.length]
                    after = part[at + 1]
                    # The phrase without its first word must be a candidate too,
                    # if this trie knows all phrases with that first word: at its
                    # ends others may know some.
                    safe = found[at + 1] if whole else (
                        found[at + 1] | (after <= trie.low) | (after >= trie.high - 1))
                    use = here & (nxt > 0) & safe
                    grown.append(phrase[use].astype(np.int64) << 32 | nxt[use])
                    if sum(map(len, grown)) > BUFFER:
                        yield from flushed()
        if grown:
            yield from flushed()
        hit = np.flatnonzero(counts)
        yield rows(-1 - hit, counts[hit])

    grown = F.col("key") >= 0
    return (codes.mapInArrow(run, "key long, n long")
            .groupBy("key").agg(F.sum("n").alias("n")).where(f"key < 0 OR n >= {least}")
            .select(grown.alias("grown"), "n",
                    F.when(grown, F.shiftright("key", 32)).otherwise(-1 - F.col("key")).alias("phrase"),
                    F.col("key").bitwiseAND(0xFFFFFFFF).alias("next")))


class _Words:
    """The trie of the first level: a state for each word code."""

    length = 1

    def __init__(self, low: int, high: int):
        self.low, self.high = low, high

    def positions(self, codes):
        at = np.flatnonzero((codes >= self.low) & (codes < self.high))
        return at, codes[at] - np.int32(self.low)


def in_order(df: DataFrame, name: str, key: str) -> DataFrame:
    """``df`` with the dense column ``name`` (from 0 on) in the order of ``key``:
    sorted parts are written, parts start where the last ended."""
    at = F.col("_at")
    dealt = staged(df.sparkSession, df.orderBy(key).select(
        F.monotonically_increasing_id().alias("_at"), "*"), "phrase-sorted").withColumn(
        "_part", F.shiftright(at, 33))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    start = (dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
             .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")))
    return (dealt.join(start, "_part")
            .withColumn(name, F.col("_start") + at.bitwiseAND((1 << 33) - 1))
            .drop("_part", "_start", "_at"))


def _cuts(total: int, most: int) -> list[tuple[int, int]]:
    """Ranges of phrase numbers of at most ``most`` each."""
    cuts = max(1, math.ceil(total / most))
    return [(k * total // cuts, (k + 1) * total // cuts) for k in range(cuts)]


def trie_of(phrases: DataFrame, begin: int, end: int, level: int, digits: int) -> Trie:
    """The trie of the phrases with the numbers ``begin`` to ``end - 1``."""
    own = phrases.select("id", "w").toArrow()
    flat = np.empty((end - begin, level), np.int32)
    for part in own.to_batches():
        flat[part.column(0).to_numpy() - begin] = (
            part.column(1).flatten().to_numpy().reshape(-1, level))
    del own
    return Trie(flat, int(flat[0, 0]), int(flat[-1, 0]) + 1, digits)


def mined(docs: DataFrame, least: int = LEAST, longest: int = LONGEST,
          max_phrases: int = MAX_PHRASES) -> tuple[DataFrame, DataFrame]:
    """(all words: lang, word, n and a code for the frequent ones; counted
    phrases of 1 to ``longest`` words: w, their codes, and f)."""
    spark = docs.sparkSession
    counted = staged(spark, count_words(docs), "phrase-word-counts")
    often = counted.where(F.col("n") >= least)
    total = often.count()
    words = staged(spark, numbered(often, "code", total, "lang", "word"), "phrase-words")
    grams = words.select(F.array(F.col("code").cast("int")).alias("w"), F.col("n").alias("f"))
    if not total:
        return counted.withColumn("code", F.lit(None).cast("long")), grams
    texts = coded(docs, words, total)
    digits = max(1, math.ceil(total.bit_length() / 8))
    phrases, known, levels = None, total, [grams]
    for level in range(1, longest + 1):
        parts, grow = [], level < longest
        most = max(1, min(max_phrases, MAX_STATES // (digits * max(1, level - 1))))
        cuts = _cuts(known, most) if level > 1 else [(0, total)]
        for begin, end in cuts:
            if level == 1:
                make = lambda n=total: (_Words(1, n + 1), n)                # noqa: E731
                back = words.select((F.col("code") - 1).alias("phrase"),
                                    F.array(F.col("code").cast("int")).alias("w"))
            else:
                own = phrases.where((F.col("id") >= begin) & (F.col("id") < end))
                make = None             # the driver holds one trie
                trie = trie_of(own, begin, end, level, digits)
                make = lambda trie=trie, n=end - begin: (trie, n)           # noqa: E731
                del trie
                back = own.select((F.col("id") - begin).alias("phrase"), "w")
            found = staged(spark, sweep(texts, make, len(cuts) == 1, grow, least),
                           "phrase-counts")
            parts.append(found.join(back, "phrase"))
        found = parts[0]
        for more in parts[1:]:
            found = found.union(more)
        if level > 1:
            levels.append(found.where("NOT grown").select("w", F.col("n").alias("f"))
                          .where(F.col("f") >= least))
        if not grow:
            break
        longer = staged(spark, found.where("grown").select(
            F.concat("w", F.array(F.col("next").cast("int"))).alias("w")), "phrase-candidates")
        known = longer.count()
        if not known:
            break
        phrases = staged(spark, in_order(longer, "id", "w"), "phrase-numbered")
    out = levels[0]
    for more in levels[1:]:
        out = out.union(more)
    return staged(spark, counted.join(words.select("lang", "word", "code"), ["lang", "word"], "left"),
                  "phrase-words"), staged(spark, out, "phrase-grams")


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP,
                 max_phrases: int = MAX_PHRASES) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of each language."""
    words, grams = mined(docs, least, longest, max_phrases)
    spark = docs.sparkSession
    f = grams.select(F.col("w").alias("part"), F.col("f").alias("pf"))
    size = F.size("w")
    phrases = grams.where(size > 1)
    cuts = phrases.select("w", "f", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.withColumn("left", F.slice("w", F.lit(1), F.col("k"))).withColumn(
        "right", F.slice("w", F.col("k") + 1, F.size("w") - F.col("k")))
    whole = "decimal(38,0)"
    score = F.expr(f"CAST({SCALE} AS {whole}) * CAST(f AS DECIMAL(19,0)) DIV "
                   "(CAST(l AS DECIMAL(19,0)) + CAST(r AS DECIMAL(19,0)))")
    cuts = (cuts.join(f.toDF("left", "l"), "left").join(f.toDF("right", "r"), "right")
            .select("w", "f", "k", "l", "r", score.alias("score")))
    # The lowest score, then the smallest k.
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("c")
    scored = cuts.groupBy("w", "f").agg(lowest)
    # What lies inside longer phrases, with the most occurrences of one.
    inside = (phrases.where(size > 2)
              .select("f", "w", F.explode(F.sequence(F.lit(2), size - 1)).alias("k"))
              .select("f", "w", "k", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("k") + 1))
                      .alias("at"))
              .select(F.slice("w", F.col("at"), F.col("k")).alias("w"), "f")
              .groupBy("w").agg(F.max("f").alias("longer")))
    held = (f"CAST({SHARE[1]} AS DECIMAL(19,0)) * CAST(longer AS DECIMAL(19,0)) "
            f">= CAST({SHARE[0]} AS DECIMAL(19,0)) * CAST(f AS DECIMAL(19,0))")
    kept = (scored.join(inside, "w", "left").where(f"longer IS NULL OR NOT ({held})")
            .select("w", F.col("f").alias("a"), "c.l", "c.r", "c.score"))
    spelled = (kept.select("w", F.posexplode("w").alias("p", "code"))
               .join(words.where("code IS NOT NULL").select("code", "lang", "word"), "code")
               .groupBy("w").agg(F.array_join(F.transform(
                   F.array_sort(F.collect_list(F.struct("p", "word"))), lambda x: x["word"]),
                   " ").alias("phrase"), F.first("lang").alias("lang")))
    named = kept.join(spelled, "w")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = staged(spark, named.withColumn("rank", F.row_number().over(order))
                  .where(F.col("rank") <= top), "phrase-best")
    return (best.join(totals, "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n",
                    F.col("score").cast("long").alias("score")))
