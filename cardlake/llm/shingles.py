"""Word shingles of texts as 64-bit hashes, computed by numpy inside tasks.

Words are the runs of bytes other than space, tab, line feed, vertical tab,
form feed and carriage return, after A-Z became a-z.  A text's shingles are
its distinct runs of ``width`` words; a text with fewer words has its whole
word sequence as one shingle, a text without words has none.

A word is hashed eight bytes at a time, and each step goes through a mixing
bijection, so no pattern of bytes cancels out (sums of powers modulo 2**64 do,
for words of some thousand bytes); words longer than ``LONG`` bytes take BLAKE2b.
Two different shingles have one hash with a chance of about 2**-64.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np

WIDTH = 5
_STEP = 0xD1B54A32D192ED03
LONG = 128         # bytes of the longest word that is hashed in blocks
STRETCH = 1 << 20  # bytes of text whose words are hashed side by side
# of the rolling sums over byte windows
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
SPAN = 1 << 16     # bytes of which the powers below are kept


def _powers(n: int, base: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    x = 1
    for i in range(n):
        out[i] = x
        x = x * base & _MASK
    return out


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads low bits over all bits."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class Shingler:
    """Holds the tables that hashing needs; make one per task."""

    def __init__(self, width: int = WIDTH):
        self.width = width
        self.lower = np.arange(256, dtype=np.uint8)
        self.lower[65:91] += 32
        self.space = np.zeros(256, bool)
        self.space[[9, 10, 11, 12, 13, 32]] = True
        # the bytes of a last block that belong to the word
        self.mask = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)

    def words(self, data: bytes) -> np.ndarray:
        """A hash of every word, in order."""
        b = np.frombuffer(data, np.uint8)
        gap = np.flatnonzero(self.space[b])
        start = np.concatenate(([0], gap + 1))
        end = np.concatenate((gap, [len(b)]))
        real = end > start
        start, end = start[real], end[real]
        out = np.empty(len(start), np.uint64)
        at = 0
        while at < len(start):
            stop = max(at + 1, int(np.searchsorted(end, start[at] + STRETCH, "right")))
            low = start[at]
            out[at:stop] = self._hashes(self.lower[b[low:end[stop - 1]]], start[at:stop] - low, end[at:stop] - low)
            at = stop
        return out

    def _hashes(self, b: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        size = end - start
        h = mix(size.astype(np.uint64) + np.uint64(_STEP))
        blocks = np.lib.stride_tricks.sliding_window_view(np.concatenate((b, np.zeros(8, np.uint8))), 8)
        rows = np.flatnonzero(size <= LONG)
        for j in range(0, LONG, 8):
            rows = rows[size[rows] > j]
            if not len(rows):
                break
            block = blocks[start[rows] + j].view("<u8")[:, 0] & self.mask[np.minimum(size[rows] - j, 8)]
            h[rows] = mix((h[rows] ^ block) * np.uint64(_STEP) + np.uint64(j + 1))
        for i in np.flatnonzero(size > LONG):
            whole = hashlib.blake2b(b[start[i]:end[i]].tobytes(), digest_size=8).digest()
            h[i] = int.from_bytes(whole, "little")
        return h

    def sequence(self, words: np.ndarray) -> np.ndarray:
        """A hash of every run of ``width`` words, in order (see the module text)."""
        n = min(self.width, len(words))
        if n == 0:
            return words
        h = np.full(len(words) - n + 1, n, np.uint64)
        for i in range(n):
            h = h * np.uint64(_STEP) + words[i:len(words) - n + 1 + i]
        return mix(h)

    def shingles(self, text: str | None) -> np.ndarray:
        """Sorted distinct shingles of a text (null: none)."""
        if not text:
            return np.zeros(0, np.uint64)
        return np.unique(self.sequence(self.words(text.encode("utf-8", "surrogatepass"))))


def texts(column) -> Iterator[str | None]:
    """Python strings of an Arrow column, one at a time."""
    return (v.as_py() for v in column)
