"""Byte-pair merges in numpy, many words at a time.

``MergeTable`` holds the merges of a vocabulary file as sorted pair keys;
``merge_words`` applies them to a flat array of symbols.
"""

from __future__ import annotations

import json

import numpy as np

#: Rank of a pair that never merges.
NONE = np.int32(2**31 - 1)


def byte_alphabet() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte:
    printable Latin-1 bytes stand for themselves, the others follow from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(other)) for b in range(256)]


class MergeTable:
    """Pair keys (left id * size + right id) in order, with rank and product."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.vocab: dict[str, int] = spec["model"]["vocab"]
        self.special: dict[str, int] = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.size = max([*self.vocab.values(), *self.special.values()]) + 1
        self.key = np.uint32 if self.size**2 < 2**32 else np.uint64
        pairs = [tuple(m) if not isinstance(m, str) else tuple(m.split(" "))
                 for m in spec["model"]["merges"]]
        v = self.vocab
        keys = np.array([v[a] * self.size + v[b] for a, b in pairs], self.key)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.product = np.array([v[a + b] for a, b in pairs], np.int32)     # by rank

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each adjacent pair, by binary search; NONE if it never merges."""
        key = left.astype(self.key) * self.key(self.size) + right.astype(self.key)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)


def merge_words(symbols: np.ndarray, lengths: np.ndarray, table: MergeTable):
    """Merge all words to the end.

    ``symbols`` holds the symbol ids of all words one after the other,
    ``lengths`` (each at least 1) the number of symbols of each word.  In every
    round each unfinished word applies its own lowest-rank pair at all its
    places (from the left, without overlap), all words at the same time;
    words without a pair left leave the arrays.  Returns the same two arrays
    for the merged words.
    """
    word_no = np.arange(len(lengths), dtype=np.int32)
    sym, lens = symbols.astype(np.int32), lengths.astype(np.int64)
    out_lens = np.zeros(len(lengths), np.int64)
    done_sym, done_word = [], []
    own = np.repeat(word_no, lens)              # the word of each symbol
    rank = np.full(len(sym), NONE)              # of the pair that starts there

    def rate(at: np.ndarray) -> None:
        at = at[at < len(sym) - 1]
        at = at[own[at] == own[at + 1]]
        rank[at] = table.rank(sym[at], sym[at + 1])

    rate(np.arange(len(sym)))
    while len(sym):
        low = np.minimum.reduceat(rank, np.cumsum(lens) - lens)
        live = low < NONE
        if np.count_nonzero(live) < 0.8 * len(live):
            over = ~live[own]
            done_sym.append(sym[over])
            done_word.append(word_no[own[over]])
            out_lens[word_no[~live]] = lens[~live]
            word_no, sym, rank = word_no[live], sym[~over], rank[~over]
            lens, low = lens[live], low[live]
            own = np.repeat(np.arange(len(lens), dtype=np.int32), lens)
            if not len(sym):
                break
        hit = np.flatnonzero((rank == low[own]) & (rank < NONE))
        # A run of neighbouring hits is one symbol repeated: take every other.
        first = np.r_[True, np.diff(hit) != 1]
        run = np.maximum.accumulate(np.where(first, np.arange(len(hit)), 0))
        left = hit[(hit - hit[run]) % 2 == 0]
        sym[left] = table.product[rank[left]]
        rank[left] = NONE
        keep = np.ones(len(sym), bool)
        keep[left + 1] = False
        lens = lens - np.bincount(own[left], minlength=len(lens))
        sym, rank, own = sym[keep], rank[keep], own[keep]
        # Only the pairs beside a product have changed.
        left = left - np.arange(len(left))
        before = left[left > 0] - 1
        rank[before] = NONE
        rate(before)
        rate(left)
    if not done_sym:
        return np.zeros(0, np.int32), out_lens
    words = np.concatenate(done_word)
    return np.concatenate(done_sym)[np.argsort(words, kind="stable")], out_lens
