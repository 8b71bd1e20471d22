"""Words and word shingles of many texts at once, as arrays.

Words are runs of a-z, 0-9 and all code points beyond ASCII after lower-casing
A-Z. Everything is computed on the UTF-8 bytes of a slice of texts together: a
word's hash is the difference of two prefix sums, so no text becomes Python
objects. Slices are bounded in bytes (one longer text is a slice of its own).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 18

_FOLD = np.zeros(256, np.uint8)
_FOLD[0x30:0x3A] = np.arange(0x30, 0x3A)
_FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
_FOLD[0x80:] = np.arange(0x80, 0x100)

_RANDOM = np.random.default_rng(20240229)
_VALUE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_VALUE[0] = 0
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = _RANDOM.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@lru_cache(maxsize=2)
def _powers(base: int, size: int) -> np.ndarray:
    found = np.full(size, base, np.uint64)
    found[0] = 1
    return np.multiply.accumulate(found)


def mixed(keys: np.ndarray) -> np.ndarray:
    """A 64-bit permutation that spreads every bit."""
    keys = keys ^ (keys >> np.uint64(32))
    keys = keys * np.uint64(0xD6E8FEB86659FD93)
    keys = keys ^ (keys >> np.uint64(29))
    return keys * np.uint64(0xBF58476D1CE4E5B9) ^ (keys >> np.uint64(31))


@dataclass
class Words:
    """The words of a slice of texts; ``first`` has one entry more than there are texts."""

    folded: np.ndarray  # lower-cased bytes, 0 where no word is
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray  # each text's first word
    hashes: np.ndarray

    def text(self, word: int) -> str:
        return self.folded[self.start[word] : self.end[word]].tobytes().decode("utf-8", "replace")

    def prefixes(self, size: int) -> np.ndarray:
        """Hashes of the first ``size`` bytes of each word (the whole of shorter ones)."""
        return _hashes(self.folded, self.start, np.minimum(self.end, self.start + size))

    def runs(self, size: int) -> np.ndarray:
        """A hash of the ``size`` words from each word on, across texts too."""
        many = len(self.hashes) - size + 1
        if many <= 0:
            return np.zeros(0, np.uint64)
        total = np.zeros(many, np.uint64)
        for k in range(size):
            total += self.hashes[k : k + many] * _STEP[k]
        return mixed(total + np.uint64(size))

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """All texts' shingles and each text's first one; a text of fewer, but not none, words is one."""
        counts = np.diff(self.first)
        some = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
        first = np.concatenate([[0], np.cumsum(some)])
        runs = self.runs(size)
        at = np.repeat(self.first[:-1] - first[:-1], some) + np.arange(first[-1])
        found = runs[np.minimum(at, max(len(runs) - 1, 0))] if len(runs) else np.zeros(first[-1], np.uint64)
        for text in np.flatnonzero((counts > 0) & (counts < size)):
            own = self.hashes[self.first[text] : self.first[text + 1]]
            found[first[text]] = mixed((own * _STEP[: len(own)]).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(own)))[0]
        return found, first


def _hashes(folded: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    size = SLICE_BYTES + 1 if len(folded) <= SLICE_BYTES else len(folded) + 1
    sums = np.zeros(len(folded) + 1, np.uint64)
    np.cumsum(_VALUE[folded] * _powers(_BASE, size)[: len(folded)], out=sums[1:])
    own = (sums[end] - sums[start]) * _powers(_BASE_INVERSE, size)[start]
    return mixed(own + (end - start).astype(np.uint64))


def words_of(texts: pa.Array) -> Words:
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, np.uint8)
    bounds = offsets - offsets[0]
    folded = _FOLD[raw]
    inside = folded > 0
    before = np.zeros(len(raw) + 1, bool)
    before[1:] = inside
    before[bounds] = False
    after = np.zeros(len(raw) + 1, bool)
    after[:-1] = inside
    after[bounds] = False
    start = np.flatnonzero(inside & ~before[:-1])
    end = np.flatnonzero(inside & ~after[1:]) + 1
    return Words(folded, start, end, np.searchsorted(start, bounds), _hashes(folded, start, end))


def slices(
    batches: Iterator[pa.RecordBatch], text: str, most_rows: int = 512, most_bytes: int | None = None
) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of bounded bytes of text."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0)
        ends = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            limit = (ends[at - 1] if at else 0) + (most_bytes or SLICE_BYTES)
            stop = min(max(int(np.searchsorted(ends, limit, "right")), at + 1), at + most_rows)
            yield batch.slice(at, stop - at)
            at = stop


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))
