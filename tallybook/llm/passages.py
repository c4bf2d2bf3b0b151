"""Repeated passages by Rabin-Karp hashes of every fixed-length word window.

Each task hashes all windows of its documents and deals them out by hash as compact lists; a
window that several documents of one block share leaves the block once, under the smallest id.
Spark's shuffle brings equal windows together, where the smallest id that starts one
decides. Only windows to be removed travel back to their documents, which hash their words
again, mark the words under those windows, and merge them into maximal intervals.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm import postings
from tallybook.llm.frames import partitions
from tallybook.llm.words import parts, window_hashes, word_hashes

WINDOW_WORDS = 13
#: Key buckets for each shuffle partition; more of them need less memory per bucket.
BUCKETS_PER_PARTITION = 4
_FLUSH_WINDOWS = 2_000_000


def _window_lists(size: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in parts(batches):
            keys, ids = [], []
            for doc_id, text in zip(part.column("doc_id").to_pylist(), texts, strict=True):
                found = np.unique(window_hashes(word_hashes(text.split()), size))
                keys.append(found)
                ids.append(np.full(len(found), doc_id, np.int64))
            keys, ids = np.concatenate(keys), np.concatenate(ids)
            order = np.lexsort((ids, keys))
            keys, ids = keys[order], ids[order]
            first = np.zeros(len(keys), bool)
            first[postings.runs(keys)] = True
            smallest = np.maximum.accumulate(np.where(first, np.arange(len(keys)), 0))
            known = ids > ids[smallest]  # a smaller id of this very block has the window too
            rest, owners = np.unique(ids[first], return_inverse=True)
            rows = list(postings.dealt(keys[first], owners, rest, buckets))
            # these need no other block; they pass through to their documents
            for place, letter in postings.letters(keys[known], ids[known], buckets):
                rows.append((-1 - place, letter, None))
            types = (pa.int32(), pa.binary(), pa.binary())
            columns = zip(types, zip(*rows, strict=True), strict=True) if rows else zip(types, ([],) * 3)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for t, c in columns], ["bucket", "data", "ids"])

    return run


def _flag(buckets: int):
    """Windows of documents that do not hold their smallest id; rows come sorted by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, lists, later_keys, later_ids = None, [], [], []

        def decide() -> None:
            keys, ids = postings.gathered(lists)
            lists.clear()
            starts = postings.runs(keys)
            lengths = np.diff(np.append(starts, len(keys)))
            later = ids > np.repeat(ids[starts], lengths)
            later_keys.append(keys[later])
            later_ids.append(ids[later])

        def results() -> pa.RecordBatch:
            keys, ids = np.concatenate(later_keys), np.concatenate(later_ids)
            later_keys.clear()
            later_ids.clear()
            return postings.letter_batch(list(postings.letters(keys, ids, buckets)))

        for batch in batches:
            passed = []
            for bucket, data, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bucket != held and lists:
                    decide()
                    if sum(map(len, later_keys)) > _FLUSH_WINDOWS:
                        yield results()
                held = bucket
                if bucket < 0:
                    passed.append((-1 - bucket, data))
                else:
                    lists.append((data, ids))
            yield postings.letter_batch(passed)
        if lists:
            decide()
        if later_keys:
            yield results()

    return run


def covered_intervals(hashes: np.ndarray, flagged: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Maximal word intervals, end exclusive, under windows whose hash is in ``flagged``."""
    windows = window_hashes(hashes, size)
    hit = np.isin(windows, flagged)
    change = np.zeros(len(hashes) + 1, np.int64)
    at = np.flatnonzero(hit)
    np.add.at(change, at, 1)
    np.add.at(change, at + size, -1)
    covered = np.cumsum(change)[:-1] > 0
    edges = np.flatnonzero(np.diff(covered.astype(np.int8), prepend=0, append=0))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


def _removed(size: int):
    span = pa.struct([("start", pa.int32()), ("end", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in postings.answered(batches):
            ids, counts, intervals, kept = [], [], [], []
            for doc_id, text, flagged in rows:
                words = text.split()
                found = covered_intervals(word_hashes(words), flagged, size) if len(flagged) else []
                ids.append(doc_id)
                counts.append(len(words))
                intervals.append([{"start": a, "end": b} for a, b in found])
                for a, b in reversed(found):
                    del words[a:b]
                kept.append(b" ".join(words).decode())
            arrays = [
                pa.array(ids, pa.int64()),
                pa.array(counts, pa.int64()),
                pa.array(intervals, pa.list_(span)),
                pa.array(kept, pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_words", "intervals", "kept"])

    return run


def remove_repeated_windows(
    docs: DataFrame, size: int = WINDOW_WORDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: doc_id, n_words, intervals (removed words), kept (text).

    A word goes if a window of ``size`` words over it also starts in a document of smaller id.
    Null and empty texts have no words; shorter texts than a window stay whole. Rows that
    repeat an id are one document: none removes from the other. A row with a null id removes
    nothing and keeps all. Other columns are not read.
    """
    buckets = BUCKETS_PER_PARTITION * partitions(docs.sparkSession)
    slim = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    known = slim.where("doc_id IS NOT NULL")
    lists = known.mapInArrow(_window_lists(size, buckets), postings.SCHEMA)
    dealt = lists.repartition("bucket").sortWithinPartitions("bucket")
    flagged = dealt.mapInArrow(_flag(buckets), postings.LETTERS)
    kinds = "doc_id bigint, n_words bigint, intervals array<struct<start: int, end: int>>, kept string"
    return postings.delivered(slim, flagged, buckets).mapInArrow(_removed(size), kinds)
