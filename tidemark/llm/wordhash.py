"""Hashes of the words of whole texts, for many texts at once in numpy.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case. A word's hash is a polynomial over random words per byte,
modulo 2**64, taken from one running sum over the bytes of all texts, and mixed.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Iterator

import numpy as np

BASE = 0x9E3779B97F4A7C15 | 1
MIX1, MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
BATCH_BYTES = 1_000_000


def mix(x):
    """A bijection of 64-bit words whose bits all depend on each other."""
    x = x ^ (x >> np.uint64(30))
    x *= MIX1
    x ^= x >> np.uint64(27)
    x *= MIX2
    x ^= x >> np.uint64(31)
    return x


@functools.cache
def _bytes_table(lower: bool):
    table = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
    if lower:
        table[65:91] = table[97:123]
    return table


_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int):
    """BASE**i and its inverse, modulo 2**64."""
    if len(_POWERS.get("up", ())) <= n:
        size = max(n + 1, BATCH_BYTES + 1)
        inverse = pow(BASE, -1, 2**64)
        for name, base in (("up", BASE), ("down", inverse)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps)
    return _POWERS["up"], _POWERS["down"]


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def word_hashes(data, ends, lower: bool = True, spans: bool = False):
    """Hashes of all words in the texts that end at ``ends`` in ``data``, and the number of words before each text's end.

    With ``spans`` also each word's first byte and the byte behind its last.
    """
    n = len(data)
    if not n:
        none = np.empty(0, np.int64)
        return (np.empty(0, np.uint64), np.zeros(len(ends), np.int64), *((none, none) if spans else ()))
    up, down = _powers(n)
    inside = ~_SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    borders = ends[ends < n]
    first[borders] = inside[borders]
    starts = np.flatnonzero(first)
    # A word ends before white space or a text's end.
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    before = borders[borders > 0] - 1
    last[before] = inside[before]
    stops = np.flatnonzero(last) + 1
    sums = _bytes_table(lower)[data]
    sums *= up[:n]
    np.cumsum(sums, out=sums)
    total = sums[stops - 1]
    head = starts > 0
    total[head] -= sums[starts[head] - 1]
    return (mix(total * down[starts]), np.searchsorted(starts, ends), *((starts, stops) if spans else ()))


def give_back() -> None:
    """Return freed memory to the system, so that an idle worker does not hold what its last task used."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    if (trim := getattr(ctypes.CDLL(None), "malloc_trim", None)) is not None:
        trim(0)


def text_batches(batches: Iterator, text: str = "text", size: int = BATCH_BYTES) -> Iterator:
    """(part of an Arrow batch, bytes of its texts, end of each text), in parts of about ``size`` bytes. Null is empty."""
    import pyarrow as pa

    for batch in batches:
        column = batch.column(text)
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
        column = column.cast(pa.large_binary())
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
        start = 0
        while start < len(column):
            stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + size, "right")) - 1)
            stop = min(stop, len(column))
            yield batch.slice(start, stop - start), data[offsets[start] : offsets[stop]], offsets[start + 1 : stop + 1] - offsets[start]
            start = stop
    give_back()


_C = mix(np.arange(11, 19, dtype=np.uint64) * np.uint64(BASE)) | np.uint64(1)


def shingles(words, counts_end, k: int = 5):
    """Per text the sorted distinct hashes of its ``k``-word shingles; of fewer words, one for all of them."""
    n = len(words)
    rolled = np.zeros(max(0, n - k + 1), np.uint64)
    for i in range(k):
        rolled += words[i : n - k + 1 + i] * _C[i] if n >= k else np.uint64(0)
    rolled = mix(rolled)
    found, start = [], 0
    for end in counts_end.tolist():
        if end - start >= k:
            found.append(np.unique(rolled[start : end - k + 1]))
        elif end > start:
            parts = np.append(words[start:end] * _C[: end - start], _C[k : k + 1] * np.uint64(end - start))
            found.append(mix(parts.sum(keepdims=True, dtype=np.uint64)))
        else:
            found.append(np.empty(0, np.uint64))
        start = end
    return found
