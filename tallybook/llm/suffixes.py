"""Repeated passages by sparse suffix arrays over minimisers.

A suffix is kept where the hash of the next ``GRAM`` words is least among ``GAP`` neighbours, a choice that
depends on content alone: a passage of ``PASSAGE`` words has such a place among its first ``GAP``,
so the suffix there shares at least ``BODY = PASSAGE - GAP + 1`` words in every document that
holds the passage.

1. Bodies (the first ``BODY`` words of each suffix, as a hash) go through Spark's shuffle as compact
   lists; suffixes whose body one document alone has leave.
2. The rest are sorted by body and following words, and again by body and preceding words; in either order
   the longest match of a suffix is with the nearest one of another document. So the match extends right and left as
   far as any other document's suffix of that body agrees. Suffixes with equal surroundings are merged before the
   sort, and surroundings are grouped by their first word, which splits most of a passage that is everywhere.
3. Extended matches of a document are merged into maximal intervals; those of fewer than
   ``PASSAGE`` words are dropped, since no repeated passage of that length can lie in them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybook.llm import postings
from tallybook.llm.frames import partitions, stored
from tallybook.llm.words import parts, window_hashes, word_hashes

PASSAGE = 50
GAP = 16
GRAM = 8
BODY = PASSAGE - GAP + 1
BUCKETS_PER_PARTITION = 1
_SUFFIXES = "doc_id bigint, pos int, body bigint, ahead binary, behind binary"


def minimisers(hashes: np.ndarray) -> np.ndarray:
    """Positions whose gram is the least of some ``GAP`` grams in a row; leftmost among equals."""
    grams = window_hashes(hashes, GRAM)
    if len(grams) < GAP:
        return np.empty(0, np.int64)
    windows = np.lib.stride_tricks.sliding_window_view(grams, GAP)
    return np.unique(windows.argmin(1) + np.arange(len(windows)))


def _bodies(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, kept positions, and the body hash at each of them."""
    hashes = word_hashes(text.split())
    bodies = window_hashes(hashes, BODY)
    at = minimisers(hashes)
    at = at[at < len(bodies)]
    return hashes, at, bodies[at]


def _body_lists(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in parts(batches):
            keys, ids = [], []
            for doc_id, text in zip(part.column("doc_id").to_pylist(), texts, strict=True):
                keys.append(np.unique(_bodies(text)[2]))
                ids.append(np.full(len(keys[-1]), doc_id, np.int64))
            keys, ids = np.concatenate(keys), np.concatenate(ids)
            order = np.lexsort((ids, keys))
            keys, ids = keys[order], ids[order]
            once = np.append(True, (keys[1:] != keys[:-1]) | (ids[1:] != ids[:-1]))[: len(keys)]
            keys, ids = keys[once], ids[once]
            starts = postings.runs(keys)
            # two documents of a block are enough for the others to see that a body is shared
            rank = np.arange(len(keys)) - np.repeat(starts, np.diff(np.append(starts, len(keys))))
            rest, owners = np.unique(ids[rank < 2], return_inverse=True)
            rows = list(postings.dealt(keys[rank < 2], owners, rest, buckets))
            for place, letter in postings.letters(keys[rank >= 2], ids[rank >= 2], buckets):
                rows.append((-1 - place, letter, None))
            columns = list(zip(*rows, strict=True)) or [(), (), ()]
            types = (pa.int32(), pa.binary(), pa.binary())
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["bucket", "data", "ids"])

    return run


def _shared(buckets: int):
    """Bodies that two documents have, by document; rows come sorted by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, lists = None, []

        def decided() -> pa.RecordBatch:
            keys, ids = postings.gathered(lists)
            lists.clear()
            starts = postings.runs(keys)
            lengths = np.diff(np.append(starts, len(keys)))
            many = np.repeat(ids[starts] != ids[starts + lengths - 1], lengths)
            return postings.letter_batch(list(postings.letters(keys[many], ids[many], buckets)))

        for batch in batches:
            passed = []
            for bucket, data, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bucket != held and lists:
                    yield decided()
                held = bucket
                if bucket < 0:
                    passed.append((-1 - bucket, data))
                else:
                    lists.append((data, ids))
            yield postings.letter_batch(passed)
        if lists:
            yield decided()

    return run


def _surrounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Suffixes with a shared body, and the hashes of the ``GAP - 1`` words on either side."""
    for documents in postings.answered(batches):
        rows = []
        for doc_id, text, shared in documents:
            if not len(shared):
                continue
            hashes, at, bodies = _bodies(text)
            wanted = np.isin(bodies, shared)
            short = (hashes >> np.uint64(32)).astype("<u4")
            for pos, body in zip(at[wanted].tolist(), bodies[wanted].view(np.int64).tolist(), strict=True):
                ahead = short[pos + BODY : pos + BODY + GAP - 1].tobytes()
                behind = short[max(0, pos - GAP + 1) : pos][::-1].tobytes()
                rows.append((doc_id, pos, body, ahead, behind))
        columns = list(zip(*rows, strict=True)) or [()] * 5
        types = (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
        arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, [c.split(" ")[0] for c in _SUFFIXES.split(", ")])


def _agreeing(a: Column, b: Column) -> Column:
    """Words that two surroundings agree in, from the suffix outwards; four bytes a word."""
    words = F.sequence(F.lit(1), F.lit(GAP - 1))
    same = F.filter(words, lambda n: (F.substring(a, 1, n * 4) == F.substring(b, 1, n * 4)) & (F.length(a) >= n * 4))
    return F.when(b.isNull(), 0).otherwise(F.size(same))


def _reach(contexts: DataFrame, side: str, other: str) -> DataFrame:
    """How far each context agrees on ``side`` with one of another document.

    In sorted order the longest match is with the nearest context, on either hand, that not this document
    alone has: the one next to the run of neighbours with the same single owner.
    """
    # laid out once for both orders
    out = contexts.withColumn("_first", F.substring(side, 1, 4))
    near = []
    for k, order in enumerate(([F.asc(side), F.asc(other)], [F.desc(side), F.desc(other)])):
        way = Window.partitionBy("body", "_first").orderBy(*order)
        before = F.lag(F.struct("lo", "hi", side)).over(way)
        # a run ends where the owner changes; a context of several documents is a run of its own
        same = (F.col("_before.lo") == F.col("lo")) & (F.col("_before.hi") == F.col("hi")) & (F.col("lo") == F.col("hi"))
        begins = F.when(~F.coalesce(same, F.lit(False)), F.struct(F.col("_before")[side].alias("v")))
        upto = way.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        out = out.withColumn("_before", before)
        nearest = F.last(begins, ignorenulls=True).over(upto)["v"]
        out = out.withColumn(f"_near_{k}", _agreeing(F.col(side), nearest)).drop("_before")
        near.append(f"_near_{k}")
    whole = F.when(F.col("lo") < F.col("hi"), F.floor(F.length(side) / 4)).otherwise(0)
    return out.withColumn(f"{side}_words", F.greatest(*near, whole).cast("int")).drop("_first", *near)


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents with repeated passages: doc_id, n_words in them, intervals of words (start, end).

    Every passage of 50 words or more that two documents share lies within an interval of both. An
    interval has at least 50 words; it joins matches that overlap, each of at least 35 words that
    some other document has too. Words are as written, between white space. Documents without
    repeats, null and empty texts give no row; rows that repeat an id are one document, and one with a null
    id is left out. Other columns are not read.
    """
    buckets = BUCKETS_PER_PARTITION * partitions(docs.sparkSession)
    slim = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    slim = slim.where("doc_id IS NOT NULL")
    lists = slim.mapInArrow(_body_lists(buckets), postings.SCHEMA)
    dealt = lists.repartition("bucket").sortWithinPartitions("bucket")
    shared = dealt.mapInArrow(_shared(buckets), postings.LETTERS)
    suffixes = stored(postings.delivered(slim, shared, buckets).mapInArrow(_surrounded, _SUFFIXES), "suffixes")

    same = ["body", "ahead", "behind"]
    contexts = suffixes.groupBy(*same).agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
    reach = _reach(_reach(contexts, "ahead", "behind"), "behind", "ahead")
    place = F.xxhash64(*same)
    reach = reach.select(place.alias("at"), F.col("body").alias("of"), "ahead_words", "behind_words")
    matches = suffixes.select("doc_id", "pos", "body", place.alias("context"))
    matches = matches.join(reach, (F.col("context") == F.col("at")) & (F.col("body") == F.col("of")))
    start = F.col("pos") - F.col("behind_words")
    end = F.col("pos") + BODY + F.col("ahead_words")
    found = matches.groupBy("doc_id").agg(F.sort_array(F.collect_set(F.struct(start.alias("start"), end.alias("end")))).alias("spans"))
    intervals = F.filter(merged("spans"), lambda x: x["end"] - x["start"] >= PASSAGE)
    found = found.select("doc_id", intervals.alias("intervals")).where(F.size("intervals") > 0)
    words = F.aggregate("intervals", F.lit(0).cast("bigint"), lambda n, x: n + x["end"] - x["start"])
    return found.select("doc_id", words.alias("n_words"), "intervals")


def merged(spans: str) -> Column:
    """Sorted spans of one document, overlapping and adjoining ones joined."""
    empty = F.expr("cast(array() as array<struct<start: int, end: int>>)")

    def add(done: Column, x: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        joined = F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"))
        apart = F.concat(done, F.array(x))
        touching = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined))
        return F.when(F.size(done) == 0, apart).when(x["start"] > last["end"], apart).otherwise(touching)

    return F.aggregate(spans, empty, add)
