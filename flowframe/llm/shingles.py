"""Word shingles of whole texts as 64-bit fingerprints, for a batch of texts at once.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z. A text's set holds its
distinct 5-word shingles; a text of one to four words has one member, the whole
sequence; a text without words has none. A null text counts as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WORDS = 5
#: Bytes of text hashed in one go: the working arrays are some fifty times as large.
SLICE_BYTES = 1 << 18

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers, one to one (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _GOLDEN)[_FOLD] * ~_SPACE
_PLACE = mix(np.arange(1001, 1001 + WORDS, dtype=np.uint64) * _GOLDEN) | np.uint64(1)
_powers = np.cumprod(np.full(256, 0x5851F42D4C957F2D, dtype=np.uint64))


def _powers_to(n: int) -> np.ndarray:
    global _powers
    while len(_powers) < n:
        _powers = np.cumprod(np.full(2 * len(_powers), 0x5851F42D4C957F2D, dtype=np.uint64))
    return _powers


def _word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word in order, and where each text's words begin."""
    solid = ~_SPACE[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    cuts = bounds[:-1][bounds[:-1] < len(data)]
    first[cuts] = solid[cuts]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.empty(0, dtype=np.uint64), np.zeros(len(bounds), dtype=np.int64)
    spans = np.diff(starts, append=len(data))
    place = np.arange(starts[0], len(data)) - np.repeat(starts, spans)
    parts = _BYTE[data[starts[0] :]] * _powers_to(int(spans.max()))[place]
    return mix(np.add.reduceat(parts, starts - starts[0])), np.searchsorted(starts, bounds)


def _sets(data: np.ndarray, bounds: np.ndarray) -> Iterator[np.ndarray]:
    words, at = _word_hashes(data, bounds)
    n = len(words) - WORDS + 1
    if n > 0:
        runs = sum(words[j : n + j] * _PLACE[j] for j in range(WORDS))
        runs = mix(runs)
    for low, high in zip(at[:-1], at[1:], strict=True):
        if high - low >= WORDS:
            yield np.unique(runs[low : high - WORDS + 1])
        elif high > low:
            short = (words[low:high] * _PLACE[: high - low]).sum() + np.uint64(high - low)
            yield mix(np.array([short], dtype=np.uint64))
        else:
            yield np.empty(0, dtype=np.uint64)


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """Each text's set as sorted distinct fingerprints; memory follows the longest text."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.empty(0, dtype=np.uint8)
    low = 0
    while low < len(texts):
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + SLICE_BYTES, side="right")) - 1)
        bounds = offsets[low : high + 1]
        yield from _sets(data[bounds[0] : bounds[-1]], bounds - bounds[0])
        low = high
