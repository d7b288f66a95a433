"""Words and hashes of many texts at once, as arrays.

A word is ``[^\\x20\\x09-\\x0D]+``. All work is on the UTF-8 bytes: the separators are ASCII, so
they never fall inside a character.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

from millrace.llm.common import text_buffer

SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

LONG_WORD = 512
_MASKS = np.array([(1 << (8 * n)) - 1 for n in range(9)], dtype=np.uint64)
_M1, _M2, _ODD = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), 0x9E3779B97F4A7C15


def mix(h: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


@dataclass
class Words:
    """``data[starts[i]:ends[i]]`` is word i; words ``first[d]`` to ``first[d + 1]`` are of text d."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        lens = self.ends - self.starts
        h = lens.astype(np.uint64) * np.uint64(_ODD)
        overlapping = np.ndarray((max(len(self.data) - 7, 0),), dtype="<u8", buffer=self.data, strides=(1,))
        long = np.flatnonzero(lens > LONG_WORD)
        active, at = np.flatnonzero((lens > 0) & (lens <= LONG_WORD)), 0
        while len(active):
            rest = np.minimum(lens[active] - at, 8)
            piece = overlapping[self.starts[active] + at] & _MASKS[rest]
            h[active] = mix(h[active] ^ piece) + np.uint64(_ODD)
            at += 8
            active = active[lens[active] > at]
        for i in long:
            h[i] = xxhash.xxh64_intdigest(self.data[self.starts[i] : self.ends[i]].tobytes(), 7)
        return mix(h)


def scan(texts: pa.Array, lower: bool = False) -> Words:
    data, offsets = text_buffer(texts)
    if lower:
        data = LOWER[data]
    n = len(data) - 8
    inside = np.zeros(n + 2, dtype=bool)
    np.logical_not(SPACES[data[:n]], out=inside[1:-1])
    start = inside[1:-1] & ~inside[:-2]
    end = inside[1:-1] & ~inside[2:]
    # A text ends a word even where no separator does.
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < n)]
    start[edges] = inside[edges + 1]
    end[edges - 1] = inside[edges]
    starts = np.flatnonzero(start)
    return Words(data, starts, np.flatnonzero(end) + 1, np.searchsorted(starts, offsets))


def joined(words: Words) -> Words:
    """The same words with exactly one space between neighbours."""
    lens = words.ends - words.starts
    ends = np.cumsum(lens + 1) - 1
    starts = ends - lens
    keep = np.zeros(len(words.data) + 1, dtype=np.int8)
    keep[words.starts] += 1
    keep[words.ends] -= 1
    inside = np.cumsum(keep[:-1], dtype=np.int8).astype(bool)
    total = int(ends[-1]) + 1 if len(ends) else 0
    data = np.full(total + 8, 0x20, dtype=np.uint8)
    place = np.ones(total, dtype=bool)
    place[ends] = False
    data[:total][place] = words.data[inside]
    return Words(data, starts, ends, words.first)


_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = 1 << max(12, (n - 1).bit_length())
        inverse = pow(_ODD, -1, 1 << 64)
        for name, base in (("up", _ODD), ("down", inverse)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash for each run of ``width`` neighbouring hashes, also across texts; callers mask those."""
    n = len(hashes)
    if n < width:
        return np.zeros(0, dtype=np.uint64)
    up, down = _powers(n)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(hashes * up, out=sums[1:])
    return mix((sums[width:] - sums[:-width]) * down[: n - width + 1])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each run of ``width`` neighbours, in log(width) passes."""
    if len(values) < width:
        return values[:0]
    least, span = values, 1
    while span < width:
        step = min(span, width - span)
        least = np.minimum(least[: len(least) - step], least[step:])
        span += step
    return least
