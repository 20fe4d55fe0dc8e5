"""Words and word shingles of many texts at once, as 64-bit hashes in numpy.

Words are runs of bytes other than blank and 0x09 to 0x0D, with A-Z lower-cased.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

U = np.uint64
POWER, INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
STEP = 0xD1342543DE82EF95


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers after which all bits depend on all bits."""
    h = (values ^ (values >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def _byte_values(lower: bool) -> np.ndarray:
    codes = np.arange(256, dtype=np.uint64)
    if lower:
        codes[65:91] += U(32)
    return mix(codes + U(0x5851F42D4C957F2D))


BYTES, LOWERED = _byte_values(False), _byte_values(True)
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base squared ... as 64-bit numbers; kept, and grown by doubling."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.ones(max(n, 1 << 16), dtype=np.uint64)
        have[1:] = U(base)
        have = np.multiply.accumulate(have)
        _powers[base] = have
    return have[:n]


def prefix_sums(data: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of value * power over the first i bytes; hashes of stretches are differences."""
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(values[data] * powers(POWER, len(data)), out=out[1:])
    return out


def stretch_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mix((sums[ends] - sums[starts]) * powers(INVERSE, len(sums))[starts] + (ends - starts).astype(np.uint64))


class Words(NamedTuple):
    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    # First word of each text, and the number of words at the end.
    offsets: np.ndarray


def words(data: np.ndarray, offsets: np.ndarray) -> Words:
    inner = ~IS_SPACE[data]
    before = np.zeros(len(data), dtype=bool)
    before[1:] = inner[:-1]
    after = np.zeros(len(data), dtype=bool)
    after[:-1] = inner[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    before[edges] = False
    after[edges - 1] = False
    starts = np.flatnonzero(inner & ~before)
    ends = np.flatnonzero(inner & ~after) + 1
    hashes = stretch_hashes(prefix_sums(data, LOWERED), starts, ends)
    return Words(hashes, starts, ends, np.searchsorted(starts, offsets))


def shingles(w: Words, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words, and each text's first one.

    A text with fewer words has one shingle of all its words, a text without words none.
    """
    counts = np.diff(w.offsets)
    n = len(w.hashes)
    rolled = np.zeros(n, dtype=np.uint64)
    for back in range(min(size, n)):
        rolled[: n - back] += w.hashes[back:] * powers(STEP, size)[back]
    rolled = mix(rolled + U(size))
    keep = np.ones(n, dtype=bool)
    for back in range(1, size):
        at = w.offsets[1:] - back
        keep[at[(at >= w.offsets[:-1])]] = False
    short = np.flatnonzero((counts > 0) & (counts < size))
    for text in short:
        own = w.hashes[w.offsets[text] : w.offsets[text + 1]]
        at = w.offsets[text]
        keep[at] = True
        rolled[at] = mix(np.sum(own * powers(STEP, size)[: len(own)], dtype=np.uint64)[None] + U(len(own)))[0]
    sizes = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    return rolled[keep], np.concatenate([[0], np.cumsum(sizes)])
