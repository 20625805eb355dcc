"""Words of many texts at once, as arrays over their UTF-8 bytes.

A batch of texts is one byte array with offsets. Word bounds and word hashes come from a few
passes over the array; no Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x100000001B3
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = {}

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def byte_class(*spans: tuple[int, int]) -> np.ndarray:
    member = np.zeros(256, bool)
    for first, last in spans:
        member[first : last + 1] = True
    return member


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, past last row, bytes, offsets) of runs of rows with about ``limit`` bytes.

    Nulls have no bytes. A text longer than the limit is a run of its own.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(texts))
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def word_bounds(data: np.ndarray, offsets: np.ndarray, member: np.ndarray):
    """(starts, ends, words before each text) of maximal runs of member bytes within a text."""
    inside = member[data]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    opens[cuts] = inside[cuts]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    closes[cuts - 1] = inside[cuts - 1]
    starts = np.flatnonzero(opens)
    ends = np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def _power_table(size: int, base: int) -> np.ndarray:
    held = _powers.get(base)
    if held is None or len(held) < size:
        steps = np.full(max(size, SLICE_BYTES + 1), base, np.uint64)
        steps[0] = 1
        held = np.multiply.accumulate(steps)
        if size <= SLICE_BYTES + 1:  # workers live on: what they keep is bounded
            _powers[base] = held
    return held[:size]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes, equal for equal bytes wherever they stand."""
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power_table(len(data), _BASE), out=total[1:])
    h = (total[ends] - total[starts]) * _power_table(len(data) + 1, _BASE_INVERSE)[starts]
    return mix(h + (ends - starts).astype(np.uint64) * _ODD)


def chained(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` consecutive hashes (fewer rows than given by width - 1)."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = hashes[:n].copy()
    for k in range(1, width):
        h = mix(h * np.uint64(3) + hashes[k : k + n] + np.uint64(k))
    return h
