"""Word and shingle hashes of texts, vectorised over an Arrow batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Bytes of text hashed together; one longer text is hashed alone, whole.
CHUNK_BYTES = 1 << 21
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 3  # odd, and base - 1 is not a multiple of 4
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (murmur finaliser)."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U(33))
    x = x * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


_CODES = mix(np.arange(1, 257, dtype=_U))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64."""
    out = np.full(n, base & _MASK, _U)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def chunks(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets of rows in them), CHUNK_BYTES at a time; null counts as empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    if not n:
        return
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[texts.offset:texts.offset + n + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.empty(0, np.uint8)
    row = 0
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + CHUNK_BYTES, "right")) - 1
        end = min(n, max(end, row + 1))
        yield row, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of every row, and the first word of each row.

    A word is a run of bytes other than 0x20 and 0x09-0x0D; rows end words.  A
    word's hash is a polynomial in its bytes' codes, taken from prefix sums.
    """
    n = len(data)
    inside = ~_SPACE[data]
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < n)]
    starts[cuts] = inside[cuts]
    ends[cuts - 1] = inside[cuts - 1]
    first, last = np.flatnonzero(starts), np.flatnonzero(ends)
    prefix = np.zeros(n + 1, _U)
    np.cumsum(_CODES[_LOWER[data]] * powers(_BASE, n), out=prefix[1:])
    inverse = pow(_BASE, -1, 1 << 64)
    raw = (prefix[last + 1] - prefix[first]) * powers(inverse, n)[first]
    hashes = mix(raw + (last + 1 - first).astype(_U) * _U(0xD6E8FEB86659FD93))
    return hashes, np.searchsorted(first, offsets)


def shingle_sets(texts: pa.Array, width: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, sorted distinct shingle hashes of each row), chunk by chunk.

    Fewer words than ``width`` make one shingle; no words make none.
    """
    for row, data, offsets in chunks(texts):
        words, at = word_hashes(data, offsets)
        rolled = words.copy()
        for k in range(1, width):
            rolled[:-k] = rolled[:-k] * _U(0xA24BAED4963EE407) + words[k:] if k < len(words) else rolled[:-k]
        rolled = mix(rolled)
        sets = []
        for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
            if b - a >= width:
                sets.append(np.unique(rolled[a:b - width + 1]))
            elif b > a:
                one = np.array([b - a], _U)
                for k in range(a, b):
                    one = mix(one * _U(0x9FB21C651E98DF25) ^ words[k:k + 1])
                sets.append(one)
            else:
                sets.append(np.empty(0, _U))
        yield row, sets
