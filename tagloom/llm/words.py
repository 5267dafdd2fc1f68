"""Words of many texts at once, as 64-bit hashes computed on the bytes of an Arrow buffer.

A word is a run of bytes other than blank and 0x09-0x0D.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from tagloom.llm.tokens import plain, text_buffers

BLANK = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

STEP = np.uint64(0x9E3779B97F4A7C15)
_BYTE = np.random.default_rng(1).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit words."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_starts(ends: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """Places where a run of ``inside`` begins; a run ends with its text."""
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    rows = ends[:-1][ends[:-1] < len(inside)]
    first[rows] |= inside[rows]
    return np.flatnonzero(first)


def word_hashes(texts: pa.Array, fold: bool) -> tuple[np.ndarray, np.ndarray]:
    """A hash per word, and the number of the first word of each text (one more for the end).

    ``fold`` lower-cases A-Z first.
    """
    ends, data = text_buffers(plain(texts))
    inside = ~BLANK[data]
    starts = word_starts(ends, inside) if len(data) else np.zeros(0, np.int64)
    of = np.searchsorted(starts, ends)
    if not len(starts):
        return np.zeros(0, np.uint64), of
    letters = data[inside]
    if fold:
        letters = LOWER[letters]
    begin = np.cumsum(inside)[starts] - 1  # of each word among the letters
    length = np.diff(np.append(begin, len(letters)))
    place = np.arange(len(letters)) - np.repeat(begin, length)
    powers = np.cumprod(np.full(int(length.max()), STEP), dtype=np.uint64)
    return mix(np.add.reduceat(_BYTE[letters] * powers[place], begin) + length.astype(np.uint64)), of
