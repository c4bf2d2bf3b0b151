"""Exact duplicates by Grace hash partitioning and open-addressing tables.

Each input task removes its own copies with an open-addressing table of bounded size, so a
text that fills a third of the corpus leaves a task once per table. The survivors go to
buckets named by the first bits of their digest. A bucket whose distinct texts exceed the
table's limit is split on further bits, again and again, until it fits or holds one digest
only. Each bucket then goes through one table that compares complete contents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.frames import keep_documents, stored
from tallybook.llm.words import parts

#: Bytes of distinct text one table may hold.
TABLE_BYTES = 32 << 20
_SPLIT_BITS = 4
_MAX_BITS = 30

_COMBINED = "doc_id bigint, uid bigint, digest binary, text binary, rows bigint, largest bigint"
_STATS = "uid bigint, keep_id bigint, group_size bigint"


def ascii_lower(text: bytes) -> bytes:
    """UTF-8 text with A-Z, and nothing else, in lower case."""
    return text.lower()


def sha256(text: bytes) -> bytes:
    return hashlib.sha256(text).digest()


class ContentTable:
    """Open addressing with linear probing; equal means equal in every byte."""

    def __init__(self, slots: int = 1 << 10) -> None:
        self.slots = np.full(slots, -1, np.int64)
        self.texts: list[bytes] = []
        self.digests: list[bytes] = []
        self.bytes = 0

    def place(self, digest: bytes, text: bytes) -> tuple[int, bool]:
        """Number of the entry that equals ``text``, and whether it is new."""
        mask = len(self.slots) - 1
        at = int.from_bytes(digest[-8:], "little") & mask
        while (entry := int(self.slots[at])) >= 0:
            if self.digests[entry] == digest and self.texts[entry] == text:
                return entry, False
            at = (at + 1) & mask
        self.slots[at] = entry = len(self.texts)
        self.texts.append(text)
        self.digests.append(digest)
        self.bytes += len(text)
        if 2 * len(self.texts) > len(self.slots):
            self._grow()
        return entry, True

    def _grow(self) -> None:
        mask = 2 * len(self.slots) - 1
        self.slots = np.full(mask + 1, -1, np.int64)
        for entry, digest in enumerate(self.digests):
            at = int.from_bytes(digest[-8:], "little") & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = entry


def _larger(a: int | None, b: int | None) -> int | None:
    return b if a is None else a if b is None else max(a, b)


def _combine(normalise: Callable, digest_of: Callable, limit: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 36
        for part, texts in parts(batches, limit):
            table, entries, digests = ContentTable(), [], []
            for text in map(normalise, texts):
                digest = digest_of(text)
                entries.append(table.place(digest, text))
                digests.append(digest)
            ids = part.column("doc_id").to_pylist()
            rows, largest = [0] * len(table.texts), [None] * len(table.texts)
            for (entry, _), doc_id in zip(entries, ids, strict=True):
                rows[entry] += 1
                largest[entry] = _larger(largest[entry], doc_id)
            out = {
                "doc_id": pa.array(ids, pa.int64()),
                "uid": pa.array([base + e for e, _ in entries], pa.int64()),
                "digest": pa.array(digests, pa.binary()),
                "text": pa.array([table.texts[e] if new else None for e, new in entries], pa.binary()),
                "rows": pa.array([rows[e] if new else None for e, new in entries], pa.int64()),
                "largest": pa.array([largest[e] if new else None for e, new in entries], pa.int64()),
            }
            yield pa.RecordBatch.from_pydict(out)
            base += len(table.texts)

    return run


def _resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Statistics of every entry; rows come sorted by bucket, one table serves a bucket."""
    bucket, table, groups = None, ContentTable(), []

    def results() -> pa.RecordBatch:
        flat = [(uid, big, rows) for uids, rows, big in groups for uid in uids]
        columns = list(zip(*flat, strict=True)) or [(), (), ()]
        arrays = [pa.array(c, pa.int64()) for c in columns]
        return pa.RecordBatch.from_arrays(arrays, ["uid", "keep_id", "group_size"])

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("bucket", "digest", "text", "uid", "rows", "largest")]
        for into, digest, text, uid, rows, largest in zip(*columns, strict=True):
            if into != bucket:
                if groups:
                    yield results()
                bucket, table, groups = into, ContentTable(), []
            entry, new = table.place(digest, text)
            if new:
                groups.append([[uid], rows, largest])
            else:
                group = groups[entry]
                group[0].append(uid)
                group[1] += rows
                group[2] = _larger(group[2], largest)
    if groups:
        yield results()


def _prefix(bits: int):
    first = F.conv(F.substring(F.hex("digest"), 1, 8), 16, 10).cast("bigint")
    return F.shiftright(first, 32 - bits)


def _bucketed(first: DataFrame, limit: int) -> DataFrame:
    """``first`` with its bucket: the shortest digest prefix whose distinct texts fit the limit."""
    sizes = first.groupBy("digest").agg(F.max(F.length("text")).alias("bytes"))
    total = sizes.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    bits = 1
    while bits < _MAX_BITS and total > (limit // 2) << bits:
        bits += 1
    tag = lambda n: F.concat_ws(":", F.lit(n), _prefix(n))
    bucket, splits = tag(bits), []
    while bits + _SPLIT_BITS <= _MAX_BITS:
        # only prefixes that were too large at the level before are measured again
        rows = sizes.withColumn("at", tag(bits))
        for depth, large in splits:
            rows = rows.join(large, tag(depth) == F.col("large"), "left_semi")
        large = rows.groupBy("at").agg(F.sum("bytes").alias("bytes"), F.count("*").alias("texts"))
        large = large.where((F.col("bytes") > limit) & (F.col("texts") > 1))
        large = stored(large.select(F.col("at").alias("large")), "large-buckets")
        if large.isEmpty():
            break
        splits.append((bits, large))
        bits += _SPLIT_BITS
    out = first
    for depth, large in splits:
        split = large.withColumnRenamed("large", f"large{depth}")
        out = out.join(split, tag(depth) == F.col(f"large{depth}"), "left")
        bucket = F.when(F.col(f"large{depth}").isNotNull(), tag(depth + _SPLIT_BITS)).otherwise(bucket)
    return out.withColumn("bucket", bucket).select("bucket", "digest", "text", "uid", "rows", "largest")


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    normalise: Callable[[bytes], bytes] = ascii_lower,
    digest_of: Callable[[bytes], bytes] = sha256,
    table_bytes: int = TABLE_BYTES,
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, digest (binary).

    Null text counts as empty. Of equal texts the largest id stays; a null id is smaller than
    any other. Rows that repeat an id and text are kept or dropped together. Ids that all are
    null keep each other. Other columns are not read. An empty table gives no rows. Digests
    that collide do not merge different texts.
    """
    slim = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    combined = stored(
        slim.mapInArrow(_combine(normalise, digest_of, table_bytes), _COMBINED), "grace"
    )
    first = combined.where(F.col("text").isNotNull())
    dealt = _bucketed(first, table_bytes).repartition("bucket").sortWithinPartitions("bucket")
    stats = dealt.mapInArrow(_resolve, _STATS)
    members = combined.select("doc_id", F.col("uid").alias("member"), "digest")
    joined = members.join(stats, F.col("member") == F.col("uid"))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return joined.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "digest")


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs``, all columns, without those whose text another row keeps."""
    kept = exact_duplicates(docs, id_col, text_col).where("kept")
    return keep_documents(docs, kept.select(F.col("doc_id").alias(id_col)).distinct(), id_col)
