"""Hashes of words and word windows for whole batches of texts at once, with numpy.

Words are runs of bytes other than the six ASCII white-space bytes. A word's hash is a sum of random byte
values weighted by place, finished with a mixer: 64 bits, equal for equal words everywhere. Window hashes
chain word hashes in order. Nothing here holds more than one batch.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_STEP, _M1, _M2 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SLICE_BYTES = 4 << 20


def mixed(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_powers = np.ones(1, np.uint64)


def _weights(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        _powers = np.cumprod(np.append(np.uint64(1), np.full(max(n, 64), _STEP)))
    return _powers


@dataclass
class Words:
    """hashes of all words in a row; doc: which text each is of; counts: words of each text."""

    hashes: np.ndarray
    doc: np.ndarray
    counts: np.ndarray

    def windows(self, k: int) -> np.ndarray:
        """Hashes of the k words from each word on; those that leave their text mean nothing (see inside)."""
        n = max(0, len(self.hashes) - k + 1)
        h = np.zeros(n, np.uint64)
        for j in range(k):
            h = h * _STEP + self.hashes[j : j + n]
        return mixed(h + np.uint64(k))

    def inside(self, k: int) -> np.ndarray:
        """Whether the k words from each word on are all of one text."""
        n = max(0, len(self.hashes) - k + 1)
        return self.doc[:n] == self.doc[k - 1 : k - 1 + n]


def slices(texts: pa.Array):
    """(first, texts) in pieces of a few MB; null: empty."""
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + _SLICE_BYTES, "right")) - 1)
        yield at, texts.slice(at, to - at)
        at = to


def hashed(texts: pa.Array, lower: bool = False) -> Words:
    """Word hashes of one slice (large_binary, no nulls); lower: A-Z as a-z."""
    n = len(texts)
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    raw = np.frombuffer(texts.buffers()[2], np.uint8)[ends[0] : ends[-1]] if ends[-1] > ends[0] else np.zeros(0, np.uint8)
    bounds = (ends - ends[0]).astype(np.int64)
    space = _IS_SPACE[raw]
    begins, stops = ~space, ~space
    begins[1:] &= space[:-1]
    stops[:-1] &= space[1:]
    inner = bounds[1:-1][(bounds[1:-1] > 0) & (bounds[1:-1] < len(raw))]
    begins[inner] = ~space[inner]
    stops[inner - 1] = ~space[inner - 1]
    begin, stop = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    counts = np.diff(np.searchsorted(begin, bounds))
    if not len(begin):
        return Words(np.zeros(0, np.uint64), np.zeros(0, np.int64), counts)
    length = stop - begin
    place = np.arange(len(raw), dtype=np.int64)[~space] - np.repeat(begin, length)
    value = _BYTE[(_LOWER[raw] if lower else raw)[~space]] * _weights(int(length.max()))[place]
    total = np.append(np.uint64(0), np.cumsum(value))
    cut = np.append(0, np.cumsum(length))
    hashes = mixed(total[cut[1:]] - total[cut[:-1]] + length.astype(np.uint64) * _M1)
    return Words(hashes, np.repeat(np.arange(n), counts), counts)
