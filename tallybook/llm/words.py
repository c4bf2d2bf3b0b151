"""Words of a text and 64-bit hashes of word sequences, on NumPy arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Odd multiplier of the rolling polynomial; arithmetic is modulo 2**64.
BASE = np.uint64(0x9E3779B97F4A7C15)
_CACHED_WORDS = 300_000
_PART_BYTES = 8 << 20


class _WordHashes(dict):
    """Hash of each word met so far; emptied when it is full, so memory stays bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_hashes = _WordHashes()


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hash of every word. ``bytes.split()`` yields the words ``[^\\x20\\x09-\\x0D]+``."""
    return np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))


def mixed(keys: np.ndarray) -> np.ndarray:
    """Keys with all bits stirred, so that their top bits are even."""
    keys = (keys ^ (keys >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    keys = (keys ^ (keys >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return keys ^ (keys >> np.uint64(31))


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Rabin-Karp hash of each window of ``size`` consecutive words, by start position."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(count, np.uint64)
    for k in range(size):
        total *= BASE
        total += hashes[k : k + count]
    return mixed(total + np.uint64(size))


def shingle_set(hashes: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of the ``size``-word shingles; a shorter text is one shingle."""
    return np.unique(window_hashes(hashes, min(size, len(hashes)))) if len(hashes) else hashes


def parts(
    batches: Iterator[pa.RecordBatch], limit: int = _PART_BYTES
) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of Arrow batches with about ``limit`` bytes of text, and their UTF-8 texts.

    Column ``text`` must hold strings; null counts as empty. Long texts are never cut: one
    larger than the limit makes a slice of its own.
    """
    for batch in batches:
        at = batch.schema.get_field_index("text")
        texts = batch.column(at).cast(pa.binary())
        lengths = pc.fill_null(pc.binary_length(texts), 0)
        ends = np.cumsum(lengths.to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + limit, "right")))
            piece = batch.slice(start, stop - start)
            yield piece, [x or b"" for x in texts.slice(start, stop - start).to_pylist()]
            start = stop
