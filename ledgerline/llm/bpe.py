"""Operator 6: byte-level BPE encoding and decoding by batched merge rounds.

A text is cut at single blanks and line feeds into units, units not met before
in this task by the vocabulary's pattern into pre-tokens.  These are put into
one flat array of byte symbols and merged in rounds; the lowest-rank pair of each word is found by binary search over the
sorted pair keys (``merges``).  A text's ids are the ids of its pre-tokens one
after the other; decoding looks up the bytes of every id.

Defined results: null and empty texts encode to no ids and decode to the empty
text; the special token's string inside a text is its one id, as the library's
default; texts of any length are encoded whole, a megabyte at a time; ties between
pairs of equal rank are applied from the left; repeated rows each give their
row; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import codecs
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, text_or_empty
from .merges import MergeTable, byte_alphabet, merge_words

#: Bytes of units and ids that one task keeps.
MEMO_BYTES = 128 << 20
#: Characters of a text encoded at once, and ids decoded at once.
CHUNK = 1 << 20
#: Fixed value: how byte-level vocabularies of this kind cut text.
PRE_TOKEN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"
             r"|\s+(?!\S)|\s+")
#: White space other than blank and line feed; Python's, which holds the pattern's.
ODD = re.compile(r"[^\S \n]")
BLANK = re.compile(r"[^\s] (?=[^\s])")


class ByteBpe:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        self.table = MergeTable(path)
        letters = byte_alphabet()
        back = {c: b for b, c in enumerate(letters)}
        self.first = np.array([self.table.vocab[c] for c in letters], np.int32)
        self.pieces = [b""] * int(self.table.size)
        for token, i in self.table.vocab.items():
            self.pieces[i] = bytes(back[c] for c in token)
        for token, i in self.table.special.items():
            self.pieces[i] = token.encode("utf-8")
        self.pre = regex.compile(PRE_TOKEN)
        names = sorted(self.table.special, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        self.memo: dict[str, bytes] = {}
        self.held = 0

    def _merge(self, words: list[str]) -> tuple[bytes, np.ndarray]:
        """The ids of all words as bytes, and where each word's end."""
        flat = np.frombuffer("".join(words).encode("utf-8"), np.uint8)
        # Bytes of each word: its characters' first bytes counted on.
        chars = np.fromiter(map(len, words), np.int64, len(words))
        at = np.append(np.flatnonzero((flat & 0xC0) != 0x80), len(flat))
        ends = at[np.cumsum(chars)]
        ids, merged = merge_words(self.first[flat], np.diff(ends, prepend=0), self.table)
        return ids.astype("<u4").tobytes(), 4 * np.cumsum(merged)

    def _units(self, text: str) -> list[str] | None:
        """Cut a text into units that the pattern cuts independently: words
        between single white space, each with the one before it (the first
        gets a line feed); None if the text has other white space or a
        special token."""
        if (not text or "  " in text or "\n\n" in text or " \n" in text or "\n " in text
                or text[0] in " \n" or text[-1] in " \n" or "<|" in text or ODD.search(text)):
            return None
        units = ("\n" + text).replace("\n", " \n").split(" ")
        return units[1:]

    def _learn(self, units: list[str]) -> None:
        """Ids of new units: cut and merged as one text."""
        spaced = [u if u[0] == "\n" else " " + u for u in units]
        words = self.pre.findall("".join(spaced))
        data, ends = self._merge(words)
        word_end = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        unit_end = np.cumsum(np.fromiter(map(len, spaced), np.int64, len(spaced)))
        cut = ends[np.searchsorted(word_end, unit_end)].tolist()
        self.memo.update(zip(units, map(data.__getitem__, map(slice, [0, *cut], cut))))
        # A string takes up to four bytes a character, an entry about 200 beside.
        self.held += 4 * sum(map(len, units)) + len(data) + 200 * len(units)

    def _whole(self, texts: list[str]) -> list[bytes]:
        """Ids of texts that have no units, special tokens set in between."""
        words, plan = [], []
        for text in texts:
            own = []
            for k, piece in enumerate(self.special.split(text) if self.special else [text]):
                if k % 2:
                    own.append(np.array([self.table.special[piece]], "<u4").tobytes())
                else:
                    found = self.pre.findall(piece)
                    own.append((len(words), len(words) + len(found)))
                    words += found
            plan.append(own)
        data, ends = self._merge(words) if words else (b"", np.zeros(0, np.int64))
        ends = np.r_[0, ends]
        return [b"".join(x if isinstance(x, bytes) else data[ends[x[0]]:ends[x[1]]] for x in own)
                for own in plan]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        out: list[list[bytes]] = [[] for _ in texts]
        group: list[tuple[int, str]] = []
        size = 0

        def done():
            for (i, _), ids in zip(group, self._encode([t for _, t in group])):
                out[i].append(ids)
            group.clear()

        for i, text in enumerate(texts):
            for piece in _pieces(text):
                group.append((i, piece))
                size += len(piece)
                if size > 4 * CHUNK:
                    done()
                    size = 0
        done()
        return [b"".join(x) if len(x) != 1 else x[0] for x in out]

    def _encode(self, texts: list[str]) -> list[bytes]:
        cut = [self._units(t) for t in texts]
        memo = self.memo
        if self.held > MEMO_BYTES:
            memo.clear()
            self.held = 0
        new = list(set().union(*[c for c in cut if c]).difference(memo))
        if new:
            self._learn(new)
        odd = iter(self._whole([t for t, c in zip(texts, cut) if c is None]))
        # The line feed put before the first unit is one id: drop it.
        return [next(odd) if parts is None else b"".join(map(memo.__getitem__, parts))[4:]
                for parts in cut]

    def decoded(self, ids: bytes) -> Iterator[str]:
        """The text of ids, piece by piece."""
        reader = codecs.getincrementaldecoder("utf-8")("replace")
        for at in range(0, len(ids), 4 * CHUNK):
            found = np.frombuffer(ids[at:at + 4 * CHUNK], "<u4").tolist()
            yield reader.decode(b"".join(map(self.pieces.__getitem__, found)))
        yield reader.decode(b"", True)

    def decode(self, ids: bytes) -> str:
        return "".join(self.decoded(ids))


def _pieces(text: str) -> Iterator[str]:
    """A text in pieces of about ``CHUNK`` characters, cut before a single blank
    between two words, where a pre-token ends."""
    begin = 0
    while len(text) - begin > CHUNK:
        gap = BLANK.search(text, begin + CHUNK)
        if not gap:
            break
        yield text[begin:gap.start() + 1]
        begin = gap.start() + 1
    yield text[begin:]


def _digest(parts: Iterator[str]) -> str:
    out = hashlib.sha256()
    for part in parts:
        out.update(part.encode("utf-8"))
    return out.hexdigest()


def _mapped(docs: DataFrame, vocabulary: str, extra: str, columns) -> DataFrame:
    def start():
        bpe = ByteBpe(vocabulary)

        def work(cols):
            ids, texts = cols
            return [ids, *columns(bpe, bpe.encode(texts))]
        return work

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_rows(docs, [F.col("doc_id"), text_or_empty().alias("text")],
                    f"doc_id {kind}, {extra}", start)


def encode_decode(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, ids (array of int) and the decoded text of every row."""
    def columns(bpe, coded):
        return [[np.frombuffer(c, "<u4").tolist() for c in coded], [bpe.decode(c) for c in coded]]
    return _mapped(docs, vocabulary, "ids array<int>, decoded string", columns)


def encoded(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_tokens, ids (array of int), ids_sha256, decoded_sha256: the tokens
    with the digests that tell whether they decode to the text."""
    def columns(bpe, coded):
        return [[len(c) // 4 for c in coded], [np.frombuffer(c, "<i4") for c in coded],
                [hashlib.sha256(c).hexdigest() for c in coded],
                [_digest(bpe.decoded(c)) for c in coded]]
    return _mapped(docs, vocabulary, "n_tokens long, ids array<int>, ids_sha256 string, "
                                     "decoded_sha256 string", columns)


def digests(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: the digests of what
    ``encode_decode`` returns, taken in the task that made it."""
    def columns(bpe, coded):
        return [[len(c) // 4 for c in coded],
                [hashlib.sha256(c).hexdigest() for c in coded],
                [_digest(bpe.decoded(c)) for c in coded]]
    return _mapped(docs, vocabulary,
                   "n_tokens long, ids_sha256 string, decoded_sha256 string", columns)
