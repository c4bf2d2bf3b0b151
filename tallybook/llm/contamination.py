"""Benchmark decontamination by SimHash windows and multi-index Hamming blocks.

For every item, windows of its own number of words slide over each document. A window that shares
no shingle with any item has similarity zero, so only windows over a shingle of some item are
fingerprinted: a table of the items' shingles finds them in one pass. Fingerprints are cut into
blocks; if two differ in at most ``RADIUS`` bits, some block of theirs differs in at most
``RADIUS // BLOCKS`` bits. The index of a block lists, for each value, the items that close, so it
returns every item within the radius. Candidates are then compared exactly: similarity of
shingles weighted by their counts, smaller counts over larger ones.

The items are the stated query set. They are few, their number is checked, and they are broadcast;
the documents are never shuffled.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.words import mixed, parts, window_hashes, word_hashes

SHINGLE_WORDS = 5
SIMILARITY = 0.75
#: Bits of a fingerprint and the radius that the index guarantees. At similarity 0.75 about 22
#: bits of 128 differ, 4.3 their standard deviation; between unrelated texts 64 do.
BITS = 128
RADIUS = 43
BLOCKS = 11
#: Items that may be broadcast; more are processed in lots of this size.
MAX_ITEMS = 4_000
_GATE_BITS = 22
_HITS = "doc_id bigint, item_id bigint, start int, words int, similarity double"


def _spread(shingles: np.ndarray) -> np.ndarray:
    """+1 or -1 for each of the 128 bits of each shingle, as a matrix."""
    halves = np.stack([mixed(shingles), mixed(shingles ^ np.uint64(0xA0761D6478BD642F))], 1)
    bits = np.unpackbits(halves.view(np.uint8).reshape(len(shingles), 16), axis=1)
    return bits.astype(np.int16) * 2 - 1


def simhash(shingles: np.ndarray) -> np.ndarray:
    """128 bits of a multiset of shingles; a shingle weighs as often as it occurs."""
    return (_spread(shingles).sum(0) > 0).astype(np.uint8)


def _window_simhashes(shingles: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """Fingerprints of the windows of ``width`` shingles at ``starts``, from running sums."""
    low = int(starts.min())
    sums = np.zeros((int(starts.max()) + width - low + 1, BITS), np.int32)
    np.cumsum(_spread(shingles[low : low + len(sums) - 1]), 0, out=sums[1:])
    return (sums[starts - low + width] - sums[starts - low] > 0).astype(np.uint8)


def _blocks(bits: np.ndarray) -> np.ndarray:
    """Value of each block of each fingerprint."""
    pieces = np.array_split(bits, BLOCKS, axis=1)
    return np.stack([p @ (1 << np.arange(p.shape[1])) for p in pieces], 1)


class HammingIndex:
    """All fingerprints within the radius of a query, by pigeonhole over blocks."""

    def __init__(self, prints: np.ndarray) -> None:
        self.prints = prints
        self.tables = []
        for k, piece in enumerate(np.array_split(np.arange(BITS), BLOCKS)):
            every, owners = np.arange(1 << len(piece)), [[] for _ in range(1 << len(piece))]
            for item, value in enumerate(_blocks(prints)[:, k].tolist()):
                for v in np.flatnonzero(np.bitwise_count(every ^ value) <= RADIUS // BLOCKS).tolist():
                    owners[v].append(item)
            ends = np.cumsum([0, *map(len, owners)])
            self.tables.append((ends, np.array([x for own in owners for x in own], np.int32)))

    def within(self, bits: np.ndarray) -> list[np.ndarray]:
        """For each query row, the items whose fingerprints differ in at most ``RADIUS`` bits."""
        out = []
        for row, values in zip(bits, _blocks(bits).tolist(), strict=True):
            lists = [own[ends[v] : ends[v + 1]] for (ends, own), v in zip(self.tables, values, strict=True)]
            some = np.unique(np.concatenate(lists))
            out.append(some[(self.prints[some] != row).sum(1) <= RADIUS])
        return out


def weighted_similarity(a: Counter, b: Counter) -> float:
    """Sum of the smaller counts over the sum of the larger ones; zero if both are empty."""
    least = sum((a & b).values())
    most = sum(a.values()) + sum(b.values()) - least
    return least / most if most else 0.0


class Items:
    """The query set: shingles, fingerprints, and the gate over all its shingles."""

    def __init__(self, rows: list[tuple[int, bytes]], size: int) -> None:
        self.size = size
        self.items: list[tuple[int, int, Counter]] = []  # id, words, counts of shingles
        self.sizes_of: dict[int, dict[int, set[int]]] = {}  # by shingle width: words of its items
        prints = []
        for item_id, text in rows:
            hashes = word_hashes(text.lower().split())
            if not len(hashes):
                continue
            width = min(size, len(hashes))
            shingles = window_hashes(hashes, width)
            self.items.append((item_id, len(hashes), Counter(shingles.tolist())))
            prints.append(simhash(shingles))
            for shingle in shingles.tolist():
                self.sizes_of.setdefault(width, {}).setdefault(shingle, set()).add(len(hashes))
        self.index = HammingIndex(np.stack(prints)) if prints else None
        self.gates = {}
        for width, known in self.sizes_of.items():
            self.gates[width] = np.zeros(1 << _GATE_BITS, bool)
            self.gates[width][self._slot(np.fromiter(known, np.uint64, len(known)))] = True

    @staticmethod
    def _slot(shingles: np.ndarray) -> np.ndarray:
        return (shingles & np.uint64((1 << _GATE_BITS) - 1)).astype(np.int64)

    def leaks(self, text: bytes, similarity: float) -> list[tuple[int, int, int, float]]:
        """Best window per item: item_id, first word, number of words, similarity."""
        hashes = word_hashes(text.lower().split())
        best: dict[int, tuple[int, int, int, float]] = {}
        for width, gate in self.gates.items():
            shingles = window_hashes(hashes, width)
            met: dict[int, list[int]] = {}  # by words of an item: where its kind of window may lie
            for at in np.flatnonzero(gate[self._slot(shingles)]).tolist():
                for n in self.sizes_of[width].get(int(shingles[at]), ()):
                    met.setdefault(n, []).append(at)
            for n, places in met.items():
                # a text shorter than the item is one window of what it has
                span = min(n - width + 1, len(shingles))
                starts = (np.array(places)[:, None] - np.arange(span)).ravel()
                starts = np.unique(np.clip(starts, 0, len(shingles) - span))
                for group in _near(starts, 4 * span):
                    prints = _window_simhashes(shingles, group, span)
                    for start, found in zip(group.tolist(), self.index.within(prints), strict=True):
                        self._verify(shingles[start : start + span], start, n, found, similarity, best)
        return sorted(best.values())

    def _verify(self, window, start: int, n: int, found, similarity: float, best: dict) -> None:
        own = None
        for k in found.tolist():
            item_id, words, counts = self.items[k]
            if words == n:
                own = own or Counter(window.tolist())
                score = weighted_similarity(own, counts)
                if score >= similarity and (item_id not in best or score > best[item_id][3]):
                    best[item_id] = (item_id, start, len(window) + min(self.size, n) - 1, score)


def _near(starts: np.ndarray, gap: int, most: int = 4096) -> Iterator[np.ndarray]:
    """Sorted starts in groups without large gaps, so that running sums stay short."""
    cuts = np.flatnonzero(np.diff(starts) > gap) + 1
    for group in np.split(starts, cuts):
        for k in range(0, len(group), most):
            yield group[k : k + most]


def _search(items, similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Items = items.value
        for part, texts in parts(batches):
            rows = []
            for doc_id, text in zip(part.column("doc_id").to_pylist(), texts, strict=True):
                rows += [(doc_id, *hit) for hit in known.leaks(text, similarity)]
            columns = list(zip(*rows, strict=True)) or [()] * 5
            types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64())
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, [c.split(" ")[0] for c in _HITS.split(", ")])

    return run


def benchmark_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    size: int = SHINGLE_WORDS,
    similarity: float = SIMILARITY,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document and item it holds: doc_id, item_id, start, words, similarity.

    The row gives the best window. A-Z is lowered. Null and empty texts or items match nothing;
    an item with fewer words than a shingle is one shingle. Rows that repeat an id are
    reported each; a null id stays null. Other columns are not read. Of two equal items both are found.
    """
    spark = docs.sparkSession
    rows = benchmark.select(F.col("item_id").cast("bigint"), "text").where("text IS NOT NULL")
    slim = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    lots = -(-rows.count() // MAX_ITEMS) or 1
    found = []
    for lot in range(lots):
        own = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(lots)) == lot)
        items = Items([(r.item_id, r.text.encode()) for r in own.orderBy("item_id").toLocalIterator()], size)
        known = spark.sparkContext.broadcast(items)
        found.append(slim.mapInArrow(_search(known, similarity), _HITS))
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def drop_leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Rows of ``docs``, all columns, that hold no item; rows without an id are judged together."""
    found = benchmark_leaks(docs, benchmark, id_col=id_col, text_col=text_col)
    bad = found.select(F.col("doc_id").alias("id")).distinct().alias("__bad")
    same = F.col(f"__docs.{id_col}").eqNullSafe(F.col("__bad.id"))
    return docs.alias("__docs").join(bad, same, "left_anti").select("__docs.*")


