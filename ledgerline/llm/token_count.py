"""Operator 2: token counts by rank-synchronous array merging.

The vocabulary is a word-level BPE file (lower case, word-end suffix).  A text
is cut at ASCII white space; the parts not met before in this task are
normalised, cut into pre-tokens and merged together: their symbols lie in
ragged numpy arrays, every pre-token applies its own lowest-rank pair in the
same round, and the symbols that survive are counted.  Counts of parts are
kept (up to about ``MEMO_BYTES`` a task), so a repeated part costs one lookup.

Defined results: null and empty texts have 0 bytes and 0 tokens; a text of any
length is counted whole, a megabyte at a time; ties between pairs of equal rank
are applied from the left; repeated rows are counted each; an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, map_rows, text_or_empty
from .merges import MergeTable, byte_alphabet, merge_words

#: Bytes of parts and counts that one task keeps.
MEMO_BYTES = 128 << 20
#: Characters of a text cut into parts at once.
CHUNK = 1 << 20
#: Fixed value: how the vocabulary's file cuts normalised text into pre-tokens.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SUFFIX = "</w>"
CONTROL = re.compile("[\x1c-\x1f]")
#: Capitals of newer Unicode versions, which not every Python lowers.
NEWER = {"\ua7cb": "\u0264", "\ua7dc": "\u019b"}
PART = re.compile(WORD)


def lower(text: str) -> str:
    """Lower case character by character (no final-sigma rule)."""
    for old, new in NEWER.items():
        if old in text:
            text = text.replace(old, new)
    return text.lower() if "Σ" not in text else "".join(c.lower() for c in text)


def cut(text: str) -> list[str]:
    """The parts of a text between ASCII white space."""
    # str.split also cuts at U+001C..1F, which the vocabulary's pattern keeps.
    return text.split() if not CONTROL.search(text) else PART.findall(text)


def groups(texts: list[str]) -> Iterator[list[tuple[int, str]]]:
    """Groups of (number, text or piece of it) of about four ``CHUNK``; longer
    texts are cut at blanks, where parts end."""
    group, size = [], 0
    for i, text in enumerate(texts):
        begin = 0
        while begin < len(text):
            end = text.find(" ", begin + CHUNK) if len(text) - begin > CHUNK else -1
            end = len(text) if end < 0 else end
            group.append((i, text[begin:end]))
            size += end - begin
            begin = end
            if size > 4 * CHUNK:
                yield group
                group, size = [], 0
    if group:
        yield group


class WordCounter:
    """Counts the tokens of texts with one vocabulary file."""

    def __init__(self, path: str):
        self.table = MergeTable(path)
        v, letters = self.table.vocab, byte_alphabet()
        self.first = np.array([v[c] for c in letters], np.int32)
        self.last = np.array([v[c + SUFFIX] for c in letters], np.int32)
        self.pre = regex.compile(PRE_TOKEN + r"|\n")
        names = sorted(self.table.special, key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, names))) if names else None
        self.memo: dict[str, int] = {}
        self.held = 0

    def _learn(self, parts: list[str]) -> None:
        # All parts in one string, a line each: white space ends a pre-token,
        # and the added line feeds are found as tokens that part the owners.
        pieces, extra = parts, None
        if self.special and any("<|" in p for p in parts):
            cut = [self.special.split(p) for p in parts]
            extra = np.fromiter(map(len, cut), np.int64, len(cut))
            pieces = [x for c in cut for x in c]
        text = "\n".join(pieces)
        words = self.pre.findall(lower(text if text.isascii() else unicodedata.normalize("NFC", text)))
        gap = np.fromiter(("\n".__eq__(w) for w in words), bool, len(words))
        owner = np.cumsum(gap)[~gap]
        raw = "".join(words).replace("\n", "").encode("utf-8")
        counts = np.zeros(len(pieces), np.int64)
        if raw:
            flat = np.frombuffer(raw, np.uint8)
            # Bytes of each pre-token: its characters' first bytes counted on.
            chars = np.fromiter(map(len, words), np.int64, len(words))[~gap]
            at = np.append(np.flatnonzero((flat & 0xC0) != 0x80), len(flat))
            ends = at[np.cumsum(chars)]
            sym = self.first[flat]
            sym[ends - 1] = self.last[flat[ends - 1]]
            _, merged = merge_words(sym, np.diff(ends, prepend=0), self.table)
            counts = np.bincount(owner, weights=merged, minlength=len(pieces)).astype(np.int64)
        if extra is not None:
            counts = np.add.reduceat(counts, np.cumsum(extra) - extra) + extra - 1
        self.memo.update(zip(parts, counts.tolist()))
        # A string takes up to four bytes a character, an entry about 200 beside.
        self.held += sum(map(len, parts)) * (1 if text.isascii() else 4) + 200 * len(parts)

    def meet(self, parts: list[list[str]]) -> None:
        """Learn the parts that are new; forget the others if they are too many."""
        if self.held > MEMO_BYTES:
            self.memo.clear()
            self.held = 0
        new = set().union(*parts).difference(self.memo)
        if new:
            self._learn(list(new))

    def counts(self, texts: list[str]) -> list[int]:
        out, memo = [0] * len(texts), self.memo
        for group in groups(texts):
            parts = [cut(t) for _, t in group]
            self.meet(parts)
            for (i, _), own in zip(group, parts):
                out[i] += sum(map(memo.__getitem__, own))
        return out


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row of ``docs``."""

    def start():
        counter = WordCounter(vocabulary)

        def work(cols):
            ids, texts = cols
            n = counter.counts(texts)
            return [ids, [len(t.encode("utf-8")) for t in texts], n, [x > limit for x in n]]
        return work

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_rows(docs, [F.col("doc_id"), text_or_empty().alias("text")],
                    f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean", start)
