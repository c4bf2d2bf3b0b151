"""Ranked lexical search: accumulator-limited, term at a time, over blocks of documents.

One pass counts the terms of every document and stores them in blocks of documents. Document
frequencies come from those counts. Every block then meets every lot of queries (a stated query set
against all rows, in blocks) and answers each query term by term, rarest first. A document gets an
accumulator only while the bounds of the terms left could still lift a new one to the ``k``-th
partial score; later terms only update the accumulators there are, by binary search in their posting
lists. What a block drops cannot be among its ``k`` best, so the union of all blocks' best is whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallybook.llm.frames import stored
from tallybook.llm.words import parts

BEST = 10
#: Text bytes of a block of documents (one longer text makes a block of its own) and of a lot of queries.
BLOCK_BYTES = 32 << 20
LOT_BYTES = 1 << 20
_SALTS = 64
#: Bytes that end a term: all of ASCII but letters and digits. A-Z are lower-cased.
_TERMS = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 or 48 <= c <= 57 else 32
    for c in range(256)
)


def _count_terms(block_bytes: int):
    """doc_id, n, terms, counts and block of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 33
        for block, (part, texts) in enumerate(parts(batches, block_bytes), first):
            yield counted(part, texts, block)

    def counted(part: pa.RecordBatch, texts: list[bytes], block: int) -> pa.RecordBatch:
        numbers: dict[bytes, int] = {}
        lengths, sizes, terms, counts = [], [], [], []
        for text in texts:
            words = text.translate(_TERMS).split()
            ids = np.fromiter(
                (numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words)
            )
            found, times = np.unique(ids, return_counts=True)
            lengths.append(len(words))
            sizes.append(len(found))
            terms.append(found)
            counts.append(times)
        ends = pa.array(np.cumsum([0, *sizes]), pa.int32())
        known = pa.array(list(numbers), pa.binary()).cast(pa.string())
        arrays = [
            part.column("doc_id"),
            pa.array(lengths, pa.int64()),
            pa.ListArray.from_arrays(ends, known.take(pa.array(np.concatenate(terms), pa.int64()))),
            pa.ListArray.from_arrays(ends, pa.array(np.concatenate(counts), pa.int64())),
            pa.array([block] * len(texts), pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(arrays, ["doc_id", "n", "terms", "counts", "block"])

    return run


_COUNTED = "doc_id bigint, n bigint, terms array<string>, counts array<bigint>, block bigint"


def _terms_of(rows: DataFrame, id_col: str, text_col: str, block_bytes: int) -> DataFrame:
    slim = rows.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return slim.mapInArrow(_count_terms(block_bytes), _COUNTED)


def best_of_block(
    size: int, terms: list[tuple[int, np.ndarray, np.ndarray]], k: int
) -> tuple[np.ndarray, np.ndarray]:
    """Rows and scores above 0 of the ``k`` best of ``size`` documents, and of all that tie with the last.

    ``terms`` come rarest first, each as its weight, the ascending rows that hold it, and their impacts.
    """
    bounds = [weight * int(impacts.max(initial=0)) for weight, _, impacts in terms]
    left = sum(bounds)
    open_scores, rows = np.zeros(size, np.int64), None
    for (weight, at, impacts), bound in zip(terms, bounds, strict=True):
        if rows is None and left < open_scores.max(initial=0):
            kth = int(np.partition(open_scores, -k)[-k]) if size >= k else 0
            if left < kth:  # a document without accumulator can no longer come among the best
                rows = np.flatnonzero(open_scores + left >= kth)
                scores = open_scores[rows]
        left -= bound
        if rows is None:
            open_scores[at] += weight * impacts
        elif len(at):
            place = np.minimum(np.searchsorted(at, rows), len(at) - 1)
            scores += np.where(at[place] == rows, weight * impacts[place], 0)
    if rows is None:
        rows = np.flatnonzero(open_scores)
        scores = open_scores[rows]
    if len(scores) > k:
        able = scores >= np.partition(scores, -k)[-k]
        rows, scores = rows[able], scores[able]
    return rows, scores


def _answer(k: int):
    """Best documents of one block for each query of one lot."""

    def run(documents: pa.Table, queries: pa.Table) -> pa.Table:
        ids, found, scores = [], [], []
        lists = documents.column("terms").combine_chunks()
        counts = pc.list_flatten(documents.column("counts")).to_numpy()
        flat = pc.list_flatten(documents.column("terms"))
        asked = queries.column("asked").combine_chunks().flatten()
        names, numbers = np.unique(
            asked.field("terms").flatten().field("term").to_numpy(zero_copy_only=False), return_inverse=True
        )
        # the block's posting lists of the lot's terms: rows ascending within a term
        term = pc.fill_null(pc.index_in(flat, value_set=pa.array(names, pa.string())), -1).to_numpy()
        row = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy())
        used = np.flatnonzero(term >= 0)
        used = used[np.argsort(term[used], kind="stable")]
        term, row, tf = term[used], row[used], counts[used]
        m = documents.column("m").to_numpy()[row]
        impacts = (1_000_000_000 * tf) // (1_000 * tf + 8 * m)
        starts = np.searchsorted(term, np.arange(len(names) + 1))
        doc_ids = documents.column("doc_id").combine_chunks()
        weights = asked.field("terms").flatten().field("weight").to_numpy()
        at = 0
        for item, n in zip(
            asked.field("item_id"), pc.list_value_length(asked.field("terms")).to_pylist(), strict=True
        ):
            spans = [(weights[i], *starts[numbers[i] : numbers[i] + 2]) for i in range(at, at + n)]
            terms = [(w, row[a:b], impacts[a:b]) for w, a, b in spans]
            at += n
            rows, best = best_of_block(len(lists), terms, k)
            ids += [item.as_py()] * len(rows)
            found.append(doc_ids.take(pa.array(rows)))
            scores.append(best)
        columns = [
            pa.array(ids, pa.int64()),
            pa.chunked_array(found, pa.int64()).combine_chunks(),
            pa.array(np.concatenate(scores) if scores else [], pa.int64()),
        ]
        return pa.Table.from_arrays(columns, ["item_id", "doc_id", "score"])

    return run


def _lots(items: DataFrame, frequencies: DataFrame, n: int, lot_bytes: int) -> tuple[DataFrame, int]:
    """Queries in lots of about ``lot_bytes``, each with its terms and weights, rarest first."""
    weight = F.floor(1000 * F.log((2.0 * n + 2.0) / (2.0 * F.col("df") + 1.0)))
    asked = items.select(F.col("doc_id").alias("item_id"), F.explode("terms").alias("term")).distinct()
    known = asked.join(frequencies, "term").withColumn("weight", weight)
    by_item = known.groupBy("item_id").agg(
        F.array_sort(F.collect_list(F.struct("df", "term", "weight"))).alias("terms"),
        F.sum(F.length("term") + 24).alias("bytes"),
    )
    by_item = stored(by_item, "asked")
    total = by_item.agg(F.sum("bytes")).first()[0] or 0
    lots = total // lot_bytes + 1
    lot = F.pmod(F.xxhash64("item_id"), F.lit(lots)).alias("lot")
    return by_item.select(lot, F.struct("item_id", "terms").alias("query")), lots


def _top(found: DataFrame, k: int, *keys: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    k: int = BEST,
    id_col: str = "doc_id",
    item_col: str = "item_id",
    text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
    lot_bytes: int = LOT_BYTES,
) -> DataFrame:
    """The ``k`` best documents of each query: item_id, rank, doc_id, score.

    Scores are those of the contract in the README: integers but for the logarithm. Documents without
    a term (null, empty or mere punctuation) count nowhere. Each row of ``docs`` is a document, also
    those that repeat an id or have none (null ids rank behind equal scores with an id). Rows of ``items`` that share an id
    are one query with the terms of all; null is an id of its own. A query without known terms, or an
    empty table on either side, gives no rows. Other columns are not read.
    """
    counted = stored(_terms_of(docs, id_col, text_col, block_bytes).where("n > 0"), "terms")
    n, length = counted.agg(F.count("*"), F.sum("n")).first()
    frequencies = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(
        F.count("*").alias("df")
    )
    queries, lots = _lots(_terms_of(items, item_col, text_col, block_bytes), frequencies, n, lot_bytes)
    # decimals hold 90 * n * N, which may pass 64 bits
    share = F.expr(f"(CAST(90 AS DECIMAL(2,0)) * CAST(n AS DECIMAL(18,0)) * {n}BD) div {length or 1}BD")
    blocks = counted.select(
        "block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(lots - 1).cast("bigint"))).alias("lot"),
        "doc_id", "terms", "counts", (F.lit(10) + share).alias("m"),
    )
    lot_rows = queries.groupBy("lot").agg(F.collect_list("query").alias("asked"))
    salted = lot_rows.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    salt = F.pmod(F.xxhash64("block"), F.lit(_SALTS)).cast("int").alias("salt")
    dealt = blocks.select("block", "lot", salt).distinct().join(salted, ["lot", "salt"])
    dealt = dealt.select(F.col("block").alias("to_block"), F.col("lot").alias("to_lot"), "asked")
    met = blocks.groupBy("block", "lot").cogroup(dealt.groupBy("to_block", "to_lot"))
    found = met.applyInArrow(_answer(k), "item_id bigint, doc_id bigint, score bigint")
    spread = found.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(_SALTS)))
    best = _top(_top(spread, k, "item_id", "salt"), k, "item_id")
    return best.select("item_id", "rank", "doc_id", "score")
