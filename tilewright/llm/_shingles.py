"""Word shingles of whole texts, hashed with numpy straight from Arrow buffers.

A word is a maximal run of bytes other than space and the control characters
tab to carriage return, after ASCII lower-casing.  A text's shingles are its
distinct runs of five words; a text of one to four words has its whole word
sequence as its only shingle, and a text without words (or null) has none.
Shingles are represented by 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_SEED = 0x5EED_2024
_U = np.uint64
_BASE = 0x9E3779B97F4A7C17  # base of the rolling polynomial: 3 modulo 4
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_BLOCK = 1 << 19  # bytes hashed at a time; a longer text is taken alone


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng(_SEED)
    byte = rng.integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
    upper = np.arange(65, 91)
    byte[upper] = byte[upper + 32]
    space = np.zeros(256, bool)
    space[[0x20, *range(0x09, 0x0E)]] = True
    place = rng.integers(1, 1 << 63, 8, dtype=np.uint64) * _U(2) + _U(1)
    return byte, space, place


_BYTE, _SPACE, _PLACE = _tables()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class _Powers:
    """Powers of the base and of its inverse, kept as far as they were needed."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, _BLOCK)
            up, down = _powers(_BASE, size), _powers(_BASE_INVERSE, size)
            if size > _BLOCK:
                return up, down
            cls.up, cls.down = up, down
        return cls.up, cls.down


def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (one more than texts) and bytes of an Arrow string array, nulls as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()).fill_null(b"") if texts.null_count else texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = texts.buffers()[2]
    return offsets, np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)


def _word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start offset and hash of every word of the bytes, which end in no half word."""
    space = _SPACE[data]
    edge = np.diff(np.concatenate(([1], space.view(np.int8), [1])))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    up, down = _Powers.upto(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[: len(data)], out=sums[1:])
    return starts, mix((sums[ends] - sums[starts]) * down[starts])


def word_counts(texts: pa.Array) -> np.ndarray:
    """Words of each text; null counts as empty."""
    offsets, data = text_buffers(texts)
    if not len(texts):
        return np.zeros(0, np.int64)
    base = offsets[0]
    space = _SPACE[data[base : offsets[-1]]]
    first = ~space
    first[1:] &= space[:-1]
    heads = offsets[:-1][offsets[:-1] < offsets[-1]] - base
    first[heads] = ~space[heads]
    sums = np.concatenate(([0], np.cumsum(first)))
    return sums[offsets[1:] - base] - sums[offsets[:-1] - base]


def shingle_sets(texts: pa.Array, width: int = 5):
    """Yields for each text in turn its sorted distinct shingle hashes (uint64)."""
    offsets, data = text_buffers(texts)
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + _BLOCK, "right")) - 1)
        # a space after each text keeps words from running over its end
        lengths = offsets[i + 1 : j + 1] - offsets[i:j]
        starts = np.concatenate(([0], np.cumsum(lengths + 1)))
        block = np.full(int(starts[-1]), 0x20, np.uint8)
        keep = np.ones(len(block), bool)
        keep[starts[1:] - 1] = False
        block[keep] = data[offsets[i] : offsets[j]]
        at, words = _word_hashes(block)
        bounds = np.searchsorted(at, starts)
        if len(words) >= width:
            grams = words[: len(words) - width + 1] * _PLACE[0]
            for k in range(1, width):
                grams += words[k : len(words) - width + 1 + k] * _PLACE[k]
            grams = mix(grams)
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            if b - a >= width:
                yield np.unique(grams[a : b - width + 1])
            elif b > a:
                short = (words[a:b] * _PLACE[: b - a]).sum(dtype=np.uint64) + _U((b - a) * 0x1F3D5B79)
                yield mix(np.array([short], np.uint64))
            else:
                yield np.empty(0, np.uint64)
        i = j
