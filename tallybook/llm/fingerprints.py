"""Bottom-k sketches of word shingles: document fingerprints that merge and compare.

A sketch holds the ``k`` smallest hashes of a text's distinct shingles, ascending. It is a
uniform sample of them, and the sketch of a union is the ``k`` smallest of both sketches, so parts
of a document, or of a corpus, are sketched apart and merged in any order. Comparisons are
DataFrame functions on ``array<bigint>`` columns; only the hashing of texts runs in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tallybook.llm.frames import partitions
from tallybook.llm.words import parts, shingle_set, word_hashes

#: Hashes in a sketch; the standard error of a resemblance is at most 0.5 / sqrt(SKETCH_SIZE).
SKETCH_SIZE = 128
SHINGLE_WORDS = 5
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_OUT_BYTES = 8 << 20


def sketch(text: bytes, k: int = SKETCH_SIZE, size: int = SHINGLE_WORDS) -> np.ndarray:
    """The ``k`` smallest 63-bit shingle hashes of a UTF-8 text, ascending."""
    hashes = shingle_set(word_hashes(text.translate(_LOWER).split()), size)
    return np.unique(hashes >> np.uint64(1))[:k].astype(np.int64)


def _sketches(values: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, values)], dtype=np.int32)
    flat = np.concatenate(values) if values else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64()))


def document_sketches(
    docs: DataFrame,
    k: int = SKETCH_SIZE,
    size: int = SHINGLE_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per input row: doc_id and sketch.

    Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; a text of fewer than ``size`` words is
    one shingle, one without words (or null) has an empty sketch. Rows are independent, so repeated
    and null ids and empty tables need no rule; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in parts(batches):
            found = _sketches([sketch(t, k, size) for t in texts])
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), found], ["doc_id", "sketch"])

    slim = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return slim.mapInArrow(run, "doc_id bigint, sketch array<bigint>")


def merge_sketches(parts_of: DataFrame, keys: list[str], k: int = SKETCH_SIZE) -> DataFrame:
    """The sketch of each key's parts together: columns ``keys`` and sketch.

    Every task keeps the ``k`` smallest hashes of a key before the exchange, so a key with a third of
    all rows sends at most ``k`` rows a task. Null is a key value of its own; a key whose sketches are
    all empty or null has an empty one.
    """
    by_key = Window.partitionBy(*keys).orderBy("hash")
    hashes = parts_of.select(*keys, F.explode_outer("sketch").alias("hash"))
    # dense_rank counts equal hashes of different parts once
    ranked = hashes.withColumn("place", F.dense_rank().over(by_key)).where(F.col("place") <= k + 1)
    merged = ranked.groupBy(*keys).agg(F.array_sort(F.collect_set("hash")).alias("sketch"))
    return merged.withColumn("sketch", F.slice("sketch", 1, k))


def united(a: Column, b: Column, k: int = SKETCH_SIZE) -> Column:
    """Sketch of the union of two shingle sets."""
    return F.slice(F.array_sort(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = SKETCH_SIZE) -> Column:
    """Estimated share of common shingles among all of both; 1.0 if both sets are empty."""
    union = united(a, b, k)
    common = F.size(F.array_intersect(union, F.array_intersect(a, b)))
    return F.when(F.size(union) == 0, 1.0).otherwise(common / F.size(union))


def distinct_shingles(a: Column, k: int = SKETCH_SIZE) -> Column:
    """Estimated number of distinct shingles; exact below ``k``."""
    share = F.element_at(a, -1).cast("double") / float(2**63)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / share)


def containment(a: Column, b: Column, k: int = SKETCH_SIZE) -> Column:
    """Estimated share of the shingles of ``a`` that ``b`` has too; 1.0 if ``a`` has none."""
    common = resemblance(a, b, k) * distinct_shingles(united(a, b, k), k)
    share = F.least(F.lit(1.0), common / distinct_shingles(a, k))
    return F.when(F.size(a) == 0, 1.0).otherwise(share)


def sketch_text(a: Column) -> Column:
    """A sketch as Base64 of its big-endian 64-bit hashes."""
    digits = F.transform(a, lambda h: F.lpad(F.hex(h), 16, "0"))
    return F.translate(F.base64(F.unhex(F.array_join(digits, ""))), "\r\n", "")


def _ranges(docs: DataFrame) -> tuple[int, np.ndarray]:
    """Number of id ranges of about equal row counts, and their inner bounds (a number each)."""
    wanted = partitions(docs.sparkSession)
    if wanted == 1:
        return 1, np.empty(0, np.int64)
    steps = [i / wanted for i in range(1, wanted)]
    cut = docs.agg(F.percentile_approx("doc_id", steps, max(10_000, 20 * wanted))).first()[0]
    bounds = np.unique(np.array(cut or [], np.int64))
    return len(bounds) + 1, bounds


def _edits(k: int, size: int):
    """Rows come in their order and end with the first row of the next range (``after``)."""
    names = ["doc_id", "n_chars", "edited", "sketch", "edited_sketch", "next_sketch"]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        ids, lengths, edited, own, changed, following = zip(*rows, strict=True)
        arrays = [
            pa.array(ids, pa.int64()),
            pa.array(lengths, pa.int64()),
            pa.array(edited, pa.string()),
            *[_sketches(list(x)) for x in (own, changed, following)],
        ]
        return pa.RecordBatch.from_arrays(arrays, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, ended, out, used = None, False, [], 0
        for part, texts in parts(batches):
            ids, after = part.column("doc_id").to_pylist(), part.column("after").to_pylist()
            for doc_id, last, raw in zip(ids, after, texts, strict=True):
                if ended:
                    continue
                text, own = raw.decode(), sketch(raw, k, size)
                if held is not None:
                    before, old, old_sketch = held
                    half = len(old) // 2
                    edited = old[: len(old) - half] + text[:half]
                    changed = sketch(edited.encode(), k, size)
                    out.append((before, len(old), edited, old_sketch, changed, own))
                    used += len(edited) + 3000
                    if used > _OUT_BYTES:
                        yield batch(out)
                        out, used = [], 0
                held, ended = (doc_id, text, own), last == 1
        if out:
            yield batch(out)

    return run


def edited_sketches(
    docs: DataFrame,
    k: int = SKETCH_SIZE,
    size: int = SHINGLE_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Each text, its edited text and the next text, sketched: one row per input row.

    Columns doc_id, n_chars, edited, sketch, edited_sketch, next_sketch. The next document is the one
    of the next smaller id, after the last the first; in the edited text its beginning replaces the
    last ``floor(n_chars / 2)`` code points (all of it, if it is shorter). Documents are laid out by
    ranges of ids; each range also gets the first document of the following one, so no task sees
    more than its range, one document at a time. Null texts count as empty. Rows that share an id follow
    one another by text; rows without an id come last. A single document is its own next one; an
    empty table gives no rows. Other columns are not read.
    """
    slim = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text")
    )
    count, bounds = _ranges(slim)
    last = count - 1

    @pandas_udf("int")
    def place_of(ids: pd.Series) -> pd.Series:
        known = ids.notna().to_numpy()
        values = ids.fillna(0).to_numpy(np.int64)
        places = last - np.searchsorted(bounds, values, "left")
        return pd.Series(np.where(known, places, last).astype(np.int32))

    placed = slim.withColumn("place", place_of("doc_id"))
    # one row per range: its largest id, which is its first document
    tops = [tuple(r) for r in placed.groupBy("place").agg(F.max("doc_id")).orderBy("place").collect()]
    firsts = [(place, *tops[(i + 1) % len(tops)][1:]) for i, (place, _) in enumerate(tops)]
    firsts = docs.sparkSession.createDataFrame(firsts, "place int, top bigint")
    same = F.col("doc_id").eqNullSafe(F.col("top"))
    heads = slim.join(F.broadcast(firsts), same).groupBy("place").agg(F.min("text").alias("text"))
    rows = placed.select("place", F.lit(0).alias("after"), "doc_id", "text").union(
        heads.select("place", F.lit(1), F.lit(None).cast("bigint"), "text")
    )
    laid = rows.repartitionById(count, "place").sortWithinPartitions(
        "after", F.desc_nulls_last("doc_id"), "text"
    )
    kinds = "doc_id bigint, n_chars bigint, edited string, sketch array<bigint>"
    kinds += ", edited_sketch array<bigint>, next_sketch array<bigint>"
    return laid.mapInArrow(_edits(k, size), kinds)
