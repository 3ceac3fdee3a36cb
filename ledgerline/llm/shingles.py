"""Hashed words and word shingles of many texts at once, in numpy.

A word is a run of letters, digits and characters outside ASCII, in lower
case.  Word hashes are differences of a running polynomial over the bytes of
all texts, so there is no Python work per word.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2**64)
_IN_WORD = np.array([b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 for b in range(256)])
#: Characters hashed together, and where a longer text may be cut.
PIECE = 1 << 20
_GAP = re.compile(r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]")
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, n of each at least."""
    size = 1 << max(12, n.bit_length())
    if size not in _POWERS:
        up, down = np.full(size, _BASE, np.uint64), np.full(size, _INVERSE, np.uint64)
        up[0] = down[0] = 1
        _POWERS.clear()
        _POWERS[size] = np.cumprod(up), np.cumprod(down)
    return _POWERS[size]


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word of all texts, number of words of each text)."""
    raw = [t.lower().encode("utf-8", "replace") for t in texts]
    sizes = np.fromiter(map(len, raw), np.int64, len(raw)) + 1
    data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    if not len(raw):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    inside = _IN_WORD[data]
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    start, end = edge[0::2], edge[1::2]
    up, down = _powers(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=total[1:])
    hashes = mixed((total[end] - total[start]) * down[start]
                   + (end - start).astype(np.uint64))
    counts = np.diff(np.searchsorted(start, np.r_[0, np.cumsum(sizes)]))
    return hashes, counts


def shingle_hashes(words: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every run of k words within a text, number of them by text).

    A text of fewer than k words, but at least one, has one shingle: all its
    words.
    """
    begin = np.cumsum(counts) - counts
    full = np.maximum(counts - k + 1, 0)
    made = np.maximum(full, (counts > 0).astype(counts.dtype))
    at = np.repeat(begin, made) + _ramp(made)
    short = np.repeat(counts < k, made)
    length = np.where(short, np.repeat(counts, made), k)
    out = np.zeros(len(at), np.uint64)
    for j in range(k):
        use = j < length
        word = words[np.minimum(at + j, max(0, len(words) - 1))] if len(words) else out
        out = np.where(use, mixed(out + word), out)
    return out, made


def gram_sets(texts: list[str], k: int) -> list[np.ndarray]:
    """The sorted set of shingle hashes of each text.

    Texts are hashed together up to ``PIECE`` characters; a longer one is read
    in pieces that end between words, the last k - 1 words carried on, so what
    is held grows with its different shingles only.
    """
    out: list[np.ndarray] = []
    group: list[str] = []
    size = 0

    def done():
        hashes, counts = shingle_hashes(*word_hashes(group), k)
        ends = np.cumsum(counts)
        out.extend(np.unique(hashes[a:b]) for a, b in zip(ends - counts, ends))
        group.clear()

    for text in texts:
        if len(text) > PIECE:
            if group:
                done()
                size = 0
            out.append(_long_set(text, k))
            continue
        group.append(text)
        size += len(text)
        if size > PIECE:
            done()
            size = 0
    if group:
        done()
    return out


def pieces(text: str) -> Iterator[str]:
    """``text`` in pieces of about ``PIECE`` characters, cut where no word is."""
    begin = 0
    while begin < len(text):
        end = min(begin + PIECE, len(text))
        if end < len(text):
            gap = _GAP.search(text, end)
            end = gap.start() if gap else len(text)
        yield text[begin:end]
        begin = end


def _long_set(text: str, k: int) -> np.ndarray:
    held, found = np.zeros(0, np.uint64), []
    for piece in pieces(text):
        words, _ = word_hashes([piece])
        held = np.concatenate([held, words])
        if len(held) >= k:
            made, _ = shingle_hashes(held, np.array([len(held)]), k)
            found.append(np.unique(made))
            held = held[len(held) - k + 1:].copy()
    if not found:
        return np.unique(shingle_hashes(held, np.array([len(held)]), k)[0])
    return _merged(found)


def _merged(parts: list[np.ndarray]) -> np.ndarray:
    """The sorted set of all ``parts``, which are used up: one copy is held, and
    sorted and thinned where it lies."""
    out, at = np.empty(sum(map(len, parts)), np.uint64), 0
    while parts:
        part = parts.pop()
        out[at:at + len(part)] = part
        at += len(part)
    out.sort()
    kept = 0
    for begin in range(0, len(out), PIECE):
        part = out[begin:begin + PIECE].copy()
        fresh = np.r_[not kept or part[0] != out[kept - 1], part[1:] != part[:-1]]
        part = part[fresh]
        out[kept:kept + len(part)] = part
        kept += len(part)
    return out[:kept]


def _ramp(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... within each count."""
    total = int(counts.sum())
    return np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)


def minhash_functions(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers (odd) and addends of n 32-bit hash functions."""
    rng = np.random.Generator(np.random.PCG64(seed))
    a, b = rng.integers(0, 2**32, (2, n), dtype=np.uint32)
    return a | np.uint32(1), b


def band_shape(similarity: float, recall: float, rows: int) -> int:
    """Bands of ``rows`` rows that meet at ``similarity`` with probability
    ``recall``: the least b with 1 - (1 - s^r)^b >= recall."""
    return int(np.ceil(np.log(1 - recall) / np.log(1 - similarity**rows)))
