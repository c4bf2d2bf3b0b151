"""Compact lists of (key, document) pairs, dealt out by key over Spark's shuffle.

A list of 64-bit keys is sorted, stored as differences, split into byte planes and
compressed: about seven bytes a pair with its document, against some thirty for a row of
its own. One row holds all pairs of one block of documents for one bucket of keys.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.words import parts

SCHEMA = "bucket int, data binary, ids binary"


def _planes(values: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T)


def pack(keys: np.ndarray, owners: np.ndarray) -> bytes:
    """Sorted 64-bit ``keys`` and the 32-bit number of each one's owner."""
    steps = np.diff(keys, prepend=np.uint64(0))
    raw = len(keys).to_bytes(8, "little") + _planes(steps).tobytes()
    raw += _planes(owners.astype(np.uint32)).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(raw)


def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    count = int(raw[:8].view(np.uint64)[0])
    split = 8 + 8 * count
    steps = np.ascontiguousarray(raw[8:split].reshape(8, count).T).view(np.uint64).ravel()
    owners = np.ascontiguousarray(raw[split:].reshape(4, count).T).view(np.uint32).ravel()
    return np.cumsum(steps, dtype=np.uint64), owners.astype(np.int64)


def dealt(
    keys: np.ndarray, owners: np.ndarray, ids: np.ndarray, buckets: int
) -> Iterator[tuple[int, bytes, bytes]]:
    """Rows of :data:`SCHEMA`: the pairs of one block by bucket, ``owners`` index ``ids``.

    A bucket is a range of keys of even width. Only ids that the bucket needs go along.
    """
    order = np.argsort(keys, kind="stable")
    keys, owners = keys[order], owners[order]
    where = bucket_of(keys, buckets)
    cuts = np.flatnonzero(np.diff(where)) + 1
    starts = np.concatenate(([0], cuts, [len(keys)])) if len(keys) else [0]
    for a, b in zip(starts[:-1], starts[1:], strict=True):
        used, local = np.unique(owners[a:b], return_inverse=True)
        yield int(where[a]), pack(keys[a:b], local), ids[used].tobytes()


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def gathered(rows, id_type=np.int64) -> tuple[np.ndarray, np.ndarray]:
    """Keys and owners' ids of several rows of :data:`SCHEMA`, sorted by key, then id."""
    keys, ids = [], []
    for data, own in rows:
        k, owner = unpack(data)
        keys.append(k)
        ids.append(np.frombuffer(own, id_type)[owner])
    if not keys:
        return np.empty(0, np.uint64), np.empty(0, id_type)
    keys, ids = np.concatenate(keys), np.concatenate(ids)
    order = np.lexsort((ids, keys))
    return keys[order], ids[order]


def runs(keys: np.ndarray) -> np.ndarray:
    """Start of each run of equal keys."""
    if not len(keys):
        return np.empty(0, np.int64)
    return np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1))


# Answers to documents: pairs (document, key) travel packed by the place a document is sent to.

LETTERS = "place int, letter binary"


def letters(keys: np.ndarray, ids: np.ndarray, places: int) -> Iterator[tuple[int, bytes]]:
    """Rows of :data:`LETTERS` with the pairs of each place."""
    known, which = np.unique(ids, return_inverse=True)
    place = np.array([zlib.crc32(b"%d" % i) % places for i in known.tolist()], np.int64)[which]
    order = np.lexsort((ids, place))
    keys, ids, place = keys[order], ids[order], place[order]
    starts = runs(place)
    for a, b in zip(starts, [*starts[1:], len(place)], strict=False):
        steps = np.diff(ids[a:b], prepend=0)
        raw = _planes(steps).tobytes() + keys[a:b].tobytes()
        yield int(place[a]), zstandard.ZstdCompressor(level=1).compress(raw)


def opened(some: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids, sorted, and keys of several letters."""
    all_ids, all_keys = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
    for letter in some:
        raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(letter), np.uint8)
        half = len(raw) // 2
        steps = np.ascontiguousarray(raw[:half].reshape(8, -1).T).view(np.int64).ravel()
        all_ids.append(np.cumsum(steps))
        all_keys.append(raw[half:].copy().view(np.uint64))
    ids, keys = np.concatenate(all_ids), np.concatenate(all_keys)
    order = np.argsort(ids, kind="stable")
    return ids[order], keys[order]


def letter_batch(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [(), ()]
    arrays = [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.binary())]
    return pa.RecordBatch.from_arrays(arrays, ["place", "letter"])


def delivered(docs: DataFrame, sent: DataFrame, places: int) -> DataFrame:
    """Documents (doc_id, text) and letters in one layout, a place's letters before its documents."""
    address = F.coalesce(F.col("doc_id").cast("string"), F.col("text"), F.lit("")).cast("binary")
    place = F.pmod(F.crc32(address), F.lit(places)).cast("int").alias("place")
    none = F.lit(None)
    rows = docs.select(place, F.lit(1).alias("kind"), "doc_id", "text", none.cast("binary").alias("letter"))
    more = sent.select("place", F.lit(0), none.cast("bigint"), none.cast("string"), "letter")
    return rows.union(more).repartition("place").sortWithinPartitions("place", "kind")


def answered(
    batches: Iterator[pa.RecordBatch],
) -> Iterator[list[tuple[int | None, bytes, np.ndarray]]]:
    """Documents of :func:`delivered` with their keys: (doc_id, text, keys), in lists."""
    now, waiting, ids, keys = None, [], None, None
    for part, texts in parts(batches):
        out = []
        columns = [part.column(c).to_pylist() for c in ("place", "doc_id", "letter")]
        for place, doc_id, letter, text in zip(*columns, texts, strict=True):
            if place != now:
                now, waiting, ids = place, [], None
            if letter is not None:
                waiting.append(letter)
                continue
            if ids is None:
                ids, keys = opened(waiting)
                waiting = []
            a, b = (0, 0) if doc_id is None else np.searchsorted(ids, [doc_id, doc_id + 1])
            out.append((doc_id, text, keys[a:b]))
        yield out
