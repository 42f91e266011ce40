"""Vectorised scanning of text columns: words, word hashes and segment reductions in numpy.

A whole slice of an Arrow string column is scanned as one byte buffer, so the
cost per word is a few array operations rather than Python objects. Bytes
0x41-0x5A are lower-cased when asked; bytes of multi-byte characters are all
0x80 and above, so neither that nor the white-space test can touch them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19

_BYTES = np.arange(256, dtype=np.uint8)
IS_SPACE = (_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D))
LOWER = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 32, _BYTES).astype(np.uint8)

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_VALUE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, grown by doubling and kept per worker."""
    t = _powers.get(base)
    if t is None:
        t = np.ones(1, dtype=np.uint64)
    while len(t) < n:
        t = np.concatenate([t, t * np.uint64(pow(base, len(t), 1 << 64))])
    if len(t) <= 4 * SLICE_BYTES:      # a giant text must not leave a giant table behind
        _powers[base] = t
    return t[:n]


def text_slices(texts: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, row offsets) of consecutive rows holding about
    ``max_bytes``; one longer text is a slice of its own. Null reads as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    if n == 0:
        return
    _, off_buf, data_buf = texts.buffers()
    offs = np.frombuffer(off_buf, dtype=np.int64)[texts.offset:texts.offset + n + 1]
    data = np.frombuffer(data_buf, dtype=np.uint8) if data_buf is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        end = int(np.searchsorted(offs, offs[first] + max_bytes, side="right")) - 1
        end = min(max(end, first + 1), n)
        yield first, end, data[offs[first]:offs[end]], offs[first:end + 1] - offs[first]
        first = end


def find_words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, word offsets by row) of the words of a slice."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, dtype=np.int64)
        return none, none, np.zeros(len(offs), dtype=np.int64)
    word = ~IS_SPACE[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offs] = True
    first = word.copy()
    first[1:] &= ~word[:-1] | edge[1:n]
    last = word.copy()
    last[:-1] &= ~word[1:] | edge[1:n]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offs)


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """64-bit hash of each word: a polynomial over random byte values, finalised."""
    if len(starts) == 0:
        return np.zeros(0, dtype=np.uint64)
    values = _BYTE_VALUE[LOWER] if lower else _BYTE_VALUE
    sums = np.empty(len(data) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(values[data] * _power_table(_BASE, len(data)), out=sums[1:])
    h = (sums[ends] - sums[starts]) * _power_table(_INVERSE, len(data))[starts]
    return mix64(h ^ (ends - starts).astype(np.uint64))


def row_of(word_offs: np.ndarray) -> np.ndarray:
    """Row number of each word."""
    return np.repeat(np.arange(len(word_offs) - 1), np.diff(word_offs))


def segment_sum(values: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive offsets; empty segments give 0."""
    total = np.zeros(len(values) + 1, dtype=np.int64 if values.dtype.kind in "bui" else np.float64)
    np.cumsum(values, out=total[1:])
    return total[offs[1:]] - total[offs[:-1]]
