"""Hashes of all words of many texts at once, on Arrow's buffers.

A word's hash is a polynomial over its bytes modulo 2^64, taken from running sums over the buffer, and then mixed. Work
is done in slices of one MB, so memory does not depend on the batch; one longer text is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
#: BASE times this is 1 modulo 2^64.
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits all depend on all input bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Powers:
    """Powers of BASE and of its inverse, made once per worker and grown when a longer slice comes."""

    up = powers(BASE, 1)
    down = powers(INVERSE, 1)

    @classmethod
    def to(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            cls.up, cls.down = powers(BASE, n), powers(INVERSE, n)
        return cls.up, cls.down


@dataclass
class Words:
    """Words of texts ``first`` to ``last`` of a column: bytes ``start`` to ``end`` of ``data``, text number and hash.

    ``bounds[i]`` to ``bounds[i + 1]`` are the words of text ``first + i``. Null texts have none.
    """

    first: int
    last: int
    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray

    @property
    def owner(self) -> np.ndarray:
        """Number, from ``first``, of the text that each word is in."""
        return np.repeat(np.arange(self.last - self.first), np.diff(self.bounds))


def lowered(data: np.ndarray) -> np.ndarray:
    """ASCII capitals as small letters; bytes of other characters are never capitals."""
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def word_slices(texts: pa.Array, lower: bool = False) -> Iterator[Words]:
    """The words of a string column, slice by slice."""
    texts = texts.cast(pa.large_string())
    n = len(texts)
    if not n:
        return
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + n + 1]
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8) if buffer is not None and buffer.size else np.zeros(0, np.uint8)
    lengths = np.diff(offsets)
    if texts.null_count:
        lengths = np.where(texts.is_valid().to_numpy(zero_copy_only=False), lengths, 0)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield _words(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first], lengths[first:last], first, last, lower)
        first = last


def _words(data: np.ndarray, offsets: np.ndarray, lengths: np.ndarray, first: int, last: int, lower: bool) -> Words:
    if lower:
        data = lowered(data)
    size = len(data)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.ones(size + 1, dtype=bool)  # does a word that covers this byte have to begin here?
    edge[:size] = False
    edge[offsets] = True
    before = np.ones(size, dtype=bool)
    before[1:] = blank[:-1]
    start = np.flatnonzero(~blank & (before | edge[:size]))
    after = np.ones(size, dtype=bool)
    after[:-1] = blank[1:]
    end = np.flatnonzero(~blank & (after | edge[1:])) + 1
    up, down = Powers.to(size + 1)
    sums = np.zeros(size + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:size], out=sums[1:])
    hashes = mixed((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))
    bounds = np.searchsorted(start, offsets)
    if (lengths != np.diff(offsets)).any():  # bytes under a null do not count
        keep = np.repeat(lengths > 0, np.diff(bounds))
        counts = np.where(lengths > 0, np.diff(bounds), 0)
        start, end, hashes, bounds = start[keep], end[keep], hashes[keep], np.concatenate([[0], np.cumsum(counts)])
    return Words(first, last, data, start, end, hashes, bounds)


def sequences(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every ``width`` consecutive words, also across texts: callers leave those out."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        out = out * BASE + hashes[k : k + n]
    return mixed(out)
