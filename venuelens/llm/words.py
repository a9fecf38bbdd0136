"""Words of many texts at once: numpy arrays over the bytes of an Arrow column, for use inside Spark tasks."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: A-Z become a-z; every other byte stays.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of words between white space, and of words of digits, letters and all that is not ASCII.
NO_SPACE = np.ones(256, dtype=bool)
NO_SPACE[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

_BLOCK = 1 << 16
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_BASE, _BLOCK), _powers(_INVERSE, _BLOCK)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers; one-to-one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Lower-cased bytes of some texts, and their words: byte range, 64-bit hash and row of each."""

    data: np.ndarray
    offsets: np.ndarray  # byte range of row r: offsets[r] to offsets[r + 1]
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray  # words of row r: first[r] to first[r + 1]

    @property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def ngrams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Index of the first word of every run of n words in one row, and the hashes of the runs."""
        rows = self.rows
        at = np.flatnonzero(rows[: len(rows) - n + 1] == rows[n - 1 :]) if len(rows) >= n else np.zeros(0, np.int64)
        h = np.zeros(len(at), dtype=np.uint64)
        for i in range(n):
            h = h * _BASE + self.hashes[at + i]
        return at, mix(h + np.uint64(n))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and their offsets; NULL is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def hash_ranges(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the bytes of ascending, disjoint ranges."""
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        low = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, low + _BLOCK, side="right")))
        size = int(ends[j - 1] - low)
        up, down = (_UP, _DOWN) if size <= _BLOCK else (_powers(_BASE, size), _powers(_INVERSE, size))
        sums = np.zeros(size + 1, dtype=np.uint64)
        np.cumsum((data[low : low + size].astype(np.uint64) + np.uint64(1)) * up[:size], out=sums[1:])
        s, e = starts[i:j] - low, ends[i:j] - low
        out[i:j] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        i = j
    return out


def words_of(texts: pa.Array, letters: np.ndarray) -> Words:
    """Words are the longest runs of bytes marked in `letters`, after A-Z are lower-cased."""
    raw, offsets = text_bytes(texts)
    data = LOWER[raw]
    inside = letters[data]
    n = len(data)
    before = np.zeros(n, dtype=bool)
    before[1:] = inside[:-1]
    before[offsets[:-1][offsets[:-1] < n]] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(n, dtype=bool)
    after[:-1] = inside[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return Words(data, offsets, starts, ends, hash_ranges(data, starts, ends), np.searchsorted(starts, offsets))


def slices(batch: pa.RecordBatch, column: str, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about `most_bytes` of text, so that the arrays of a piece stay small; whole rows."""
    _, offsets = text_bytes(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most_bytes, side="right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def char_offsets(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Code points before each byte position of UTF-8 data."""
    heads = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=heads[1:])
    return heads[at]


def strings_of(w: Words, letters: np.ndarray) -> pa.StringArray:
    """All words of `words_of` with the same `letters` as strings, one after another: their bytes alone, in order, are the values."""
    ends = np.zeros(len(w.starts) + 1, dtype=np.int32)
    np.cumsum(w.ends - w.starts, out=ends[1:])
    return pa.Array.from_buffers(pa.string(), len(w.starts), [None, pa.py_buffer(ends), pa.py_buffer(w.data[letters[w.data]])])
