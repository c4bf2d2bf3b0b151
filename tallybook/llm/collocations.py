"""Phrase collocations by set-oriented (SETM) mining: relations, merge joins, group counts, semi-joins.

The relation of length k holds (piece, position, phrase) of every occurrence of a phrase whose parts
were all frequent, sorted, in blocks of documents of one language; positions of different pieces never
adjoin, so piece and place are one number. Joining a relation with itself at the next position
gives the occurrences of length k + 1. Each block sends a phrase once with its count, in lists by the first word;
one exchange by these heads counts phrases over all blocks. Frequent ones go back to the
blocks that hold them, where a semi-join leaves their occurrences for the next length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallybook.llm.frames import discard, stored
from tallybook.llm.words import parts

MAX_WORDS = 3
LEAST_COUNT = 10
#: A phrase goes if a longer candidate around it has at least so many hundredths of its count.
ABSORBED = 50
BEST = 2000
#: Text bytes of a block; larger blocks send a phrase less often.
BLOCK_BYTES = 24 << 20
#: The phrases of a head are dealt to one more place for so many of its occurrences.
SHARE_OF_HEAD = 50_000
_PART = 1 << 20
_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
_TABLE = bytes(
    10 if c in _ENDS else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256)
)
#: Rows of a level are of three kinds. ``packed``: a run of ``start`` occurrences of a block (positions and
#: phrase numbers). With ``block``: phrases of a block that share a head, their tails joined by tabs,
#: numbered from ``start`` on or by ``items``. Without: a head's frequent phrases with their totals.
_LEVEL = (
    "block bigint, lang string, head string, shard int, spread int, start int, tails string,"
    " items array<int>, counts array<int>, totals array<bigint>, packed binary"
)
_ARROW = pa.schema(
    [
        ("block", pa.int64()), ("lang", pa.string()), ("head", pa.string()), ("shard", pa.int32()),
        ("spread", pa.int32()), ("start", pa.int32()), ("tails", pa.string()), ("items", pa.list_(pa.int32())),
        ("counts", pa.list_(pa.int32())), ("totals", pa.list_(pa.int64())), ("packed", pa.binary()),
    ]
)
_MOST = 2**31 - 1


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


def _batch(n: int, **columns) -> pa.RecordBatch:
    arrays = []
    for field in _ARROW:
        value = columns.get(field.name)
        if value is None:
            arrays.append(pa.nulls(n, field.type))
        elif isinstance(value, pa.Array):
            arrays.append(value.cast(field.type))
        else:
            arrays.append(pa.array(value, field.type))
    return pa.RecordBatch.from_arrays(arrays, schema=_ARROW)


def _planes(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _unplaned(raw: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(raw.reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def _packed(at: np.ndarray, items: np.ndarray) -> bytes:
    steps = np.diff(at, prepend=0)
    return zstandard.ZstdCompressor(level=1).compress(_planes(steps) + _planes(items))


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    half = len(raw) // 2
    return np.cumsum(_unplaned(raw[:half])), _unplaned(raw[half:])


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Starts of the runs of rows that are equal in all columns, and the end."""
    change = np.zeros(max(0, len(columns[0]) - 1), bool)
    for column in columns:
        change |= column[1:] != column[:-1]
    return np.concatenate(([0], np.flatnonzero(change) + 1, [len(columns[0])]))


def _relation(block: int, lang: str, at: np.ndarray, items: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A block's occurrences in runs of bounded size; their heads are no words, so they deal evenly."""
    for a in range(0, len(at), _PART):
        cut = slice(a, a + _PART)
        yield _batch(
            1, block=[block], lang=[lang], head=[f"\t{block}:{a}"], shard=[0], start=[len(at[cut])],
            packed=[_packed(at[cut], items[cut])],
        )


def _lists(block, lang, heads: pa.Array, shards, spread, tails: pa.Array, counts, starts) -> Iterator[pa.RecordBatch]:
    """A block's phrases, in their numbers' order, as a row per head and shard (runs at ``starts``)."""
    for a in range(0, len(starts) - 1, _PART):
        ends = starts[a : a + _PART + 1]
        n, span = len(ends) - 1, slice(ends[0], ends[-1])
        offsets = pa.array(ends - ends[0], pa.int32())
        joined = pc.binary_join(pa.ListArray.from_arrays(offsets, tails[span].cast(pa.string())), "\t")
        yield _batch(
            n, block=[block] * n, lang=[lang] * n, head=heads.take(pa.array(ends[:-1])), shard=shards[ends[:-1]],
            spread=spread[ends[:-1]], start=ends[:-1], tails=joined,
            counts=pa.ListArray.from_arrays(offsets, pa.array(counts[span], pa.int32())),
        )


def _words(shares: int, block_bytes: int):
    """The relation of single words, in blocks of one language; words are dealt to ``shares`` places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, made = TaskContext.get(), 0
        open_blocks: dict[str, tuple[_Numbers, list[np.ndarray], list[int]]] = {}

        def close(lang: str) -> Iterator[pa.RecordBatch]:
            nonlocal made
            numbers, texts, _ = open_blocks.pop(lang)
            words = np.concatenate(texts)
            at = np.flatnonzero(words >= 2)  # a gap of one place lies between pieces
            if not len(at):
                return
            known = list(numbers)[2:]
            shards = np.fromiter((zlib.crc32(w) % shares for w in known), np.int32, len(known))
            order = np.argsort(shards, kind="stable")
            number = np.empty(len(known), np.int64)
            number[order] = np.arange(len(known))
            items = number[words[at] - 2]
            counts = np.bincount(items, minlength=len(known))
            block = (context.partitionId() << 33) | made
            made += 1
            yield from _relation(block, lang, at, items)
            tails, heads = pa.array(known, pa.binary()).take(pa.array(order)), pa.array([""] * len(known))
            spread = np.full(len(known), shares)
            yield from _lists(block, lang, heads, shards[order], spread, tails, counts, _runs(shards[order]))

        for part, texts in parts(batches):
            for lang, text in zip(part.column("lang").to_pylist(), texts, strict=True):
                if lang not in open_blocks:
                    open_blocks[lang] = _Numbers({b"": 0, b"\n": 1}), [], [0]
                numbers, seen, size = open_blocks[lang]
                split = text.translate(_TABLE).replace(b"\n", b" \n ").split(b" ")
                split.append(b"\n")
                ids = np.fromiter(map(numbers.__getitem__, split), np.int32, len(split))
                seen.append(ids[ids != 0])
                size[0] += len(text)
            while sum(size[0] for _, _, size in open_blocks.values()) >= block_bytes:
                yield from close(max(open_blocks, key=lambda x: open_blocks[x][2][0]))
        for lang in list(open_blocks):
            yield from close(lang)

    return run


def _extended(last: bool):
    """From a block's occurrences and frequent phrases, the relation one word longer."""

    def extend(table: pa.Table) -> Iterator[pa.RecordBatch]:
        table = table.combine_chunks()
        block, lang = table.column("block")[0].as_py(), table.column("lang")[0].as_py()
        is_run = pc.is_valid(table.column("packed"))
        listed, runs = table.filter(pc.invert(is_run)), table.filter(is_run)
        if not len(listed) or not len(runs):
            return
        at, items = zip(*map(_unpacked, runs.column("packed").to_pylist()), strict=True)
        at, items = np.concatenate(at), np.concatenate(items)
        order = np.argsort(at, kind="stable")
        at, items = at[order], items[order]
        numbers = pc.list_flatten(listed.column("items")).to_numpy().astype(np.int64)
        totals = pc.list_flatten(listed.column("counts")).to_numpy()
        split = pc.split_pattern(listed.column("tails").combine_chunks(), "\t")
        tails, owner = split.flatten(), pc.list_parent_indices(split)
        single = listed.column("head")[0].as_py() == ""
        # semi-join: occurrences of frequent phrases, renumbered by their place in the list
        place = np.full(max(int(items.max()), int(numbers.max())) + 1, -1, np.int64)
        place[numbers] = np.arange(len(numbers))
        items = place[items]
        at, items = at[items >= 0], items[items >= 0]
        # merge join of the sorted relation with itself at the next position
        left = np.flatnonzero(at[1:] == at[:-1] + 1)
        if not len(left):
            return
        codes, found, counts = np.unique(
            items[left] * len(numbers) + items[left + 1], return_inverse=True, return_counts=True
        )
        first, second = codes // len(numbers), codes % len(numbers)
        words = tails.to_pylist()
        lasts = [t[t.rfind(" ") + 1 :] for t in words]
        if single:
            heads, head_codes = tails, np.arange(len(tails))
            spread = 1 + totals.astype(np.int64) // SHARE_OF_HEAD
            behind = pa.array(lasts, pa.string()).take(pa.array(second))
            mixed = np.zeros(len(tails), np.int64)
        else:
            coded = listed.column("head").combine_chunks().dictionary_encode()
            heads, head_codes = coded.dictionary, coded.indices.to_numpy()[owner]
            spread = listed.column("spread").to_numpy()[owner]
            behind = pc.binary_join_element_wise(
                tails.take(pa.array(first)), pa.array(lasts, pa.string()).take(pa.array(second)), " "
            )
            mixed = np.fromiter((zlib.crc32(t.encode()) for t in words), np.int64, len(words))
        added = np.fromiter((zlib.crc32(t.encode()) for t in lasts), np.int64, len(lasts))
        spread, head = spread[first], head_codes[first].astype(np.int64)
        shards = ((mixed[first] * 31 + added[second]) % spread).astype(np.int32)
        order = np.lexsort((shards, head))
        head, shards = head[order], shards[order]
        if not last:
            number = np.empty(len(codes), np.int64)
            number[order] = np.arange(len(codes))
            yield from _relation(block, lang, at[left], number[found])
        yield from _lists(
            block, lang, heads.take(pa.array(head)), shards, spread[order], behind.take(pa.array(order)),
            counts[order], _runs(head, shards),
        )

    def run(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches(extend(table), _ARROW)

    return run


def _sums(rows: pa.Table, least: int) -> Iterator[pa.RecordBatch]:
    """Phrases of whole groups (equal head and shard, rows together) that are frequent, by block and in all."""
    starts = _group_starts(rows)
    group = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    split = pc.split_pattern(rows.column("tails").combine_chunks(), "\t")
    lengths = pc.list_value_length(split).to_numpy()
    row = np.repeat(np.arange(len(rows)), lengths)
    coded = split.flatten().dictionary_encode()
    known, codes = coded.dictionary, coded.indices.to_numpy()
    pairs = group[row] * np.int64(len(known) + 1) + codes
    found, which = np.unique(pairs, return_inverse=True)
    counts = pc.list_flatten(rows.column("counts")).to_numpy()
    totals = np.bincount(which, counts, len(found)).astype(np.int64)  # exact: below 2**53
    frequent = totals >= least

    def lists(of, n, codes, lists, **columns):
        offsets = pa.array(np.searchsorted(of, np.arange(n + 1)), pa.int32())
        tails = pc.binary_join(pa.ListArray.from_arrays(offsets, known.take(pa.array(codes))), "\t")
        made = {k: pa.ListArray.from_arrays(offsets, v) for k, v in lists.items()}
        return _batch(n, tails=tails, **columns, **made).filter(pa.array(np.diff(offsets.to_numpy()) > 0))

    kept = np.flatnonzero(frequent[which])
    within = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    numbers = rows.column("start").to_numpy()[row[kept]] + within[kept]
    # a block needs its phrases' counts only to spread their extensions
    known_counts = np.minimum(totals[which[kept]], _MOST)
    columns = {c: rows.column(c).combine_chunks() for c in ("block", "lang", "head", "shard", "spread")}
    yield lists(
        row[kept], len(rows), codes[kept],
        {"items": pa.array(numbers, pa.int32()), "counts": pa.array(known_counts, pa.int32())}, **columns,
    )
    first = {c: columns[c].take(pa.array(starts[:-1])) for c in ("lang", "head", "shard")}
    found, totals = found[frequent], totals[frequent]
    size = len(known) + 1
    yield lists(found // size, len(starts) - 1, found % size, {"totals": pa.array(totals, pa.int64())}, **first)


def _group_starts(rows: pa.Table) -> np.ndarray:
    codes = [rows.column(c).combine_chunks().dictionary_encode().indices.to_numpy() for c in ("lang", "head")]
    return _runs(*codes, rows.column("shard").to_numpy())


def _counted(least: int):
    """Group counts over rows sorted by head and shard; occurrences pass through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            batch = batch.cast(_ARROW)
            is_run = pc.is_valid(batch.column("packed"))
            yield batch.filter(is_run)
            waiting.append(batch.filter(pc.invert(is_run)))
            rows = pa.Table.from_batches(waiting, _ARROW)
            if not len(rows):
                continue
            cut = int(_group_starts(rows)[-2])  # the last group may go on in the next batch
            if cut:
                yield from _sums(rows.slice(0, cut), least)
            waiting = rows.slice(cut).combine_chunks().to_batches()
        rows = pa.Table.from_batches(waiting, _ARROW)
        if len(rows):
            yield from _sums(rows, least)

    return run


def _frequent(level: DataFrame, least: int, name: str) -> DataFrame:
    """The level with those phrases only that are counted at least ``least`` times in their language."""
    groups = ["lang", "head", "shard"]
    # a number sorts faster than the texts, which only part what it mixes up
    dealt = level.repartition(*groups).sortWithinPartitions(F.xxhash64(*groups), *groups)
    return stored(dealt.mapInArrow(_counted(least), _LEVEL), name)


def _totals(level: DataFrame, length: int) -> DataFrame:
    """lang, phrase, total and length of the frequent phrases."""
    zipped = F.explode(F.arrays_zip(F.split("tails", "\t").alias("tail"), "totals")).alias("x")
    listed = level.where("block IS NULL").select("lang", "head", zipped)
    phrase = F.when(F.col("head") == "", F.col("x.tail")).otherwise(F.concat_ws(" ", "head", "x.tail"))
    return listed.select(
        "lang", phrase.alias("phrase"), F.col("x.totals").alias("total"), F.lit(length).alias("length")
    )


def _lowest_cut(candidates: DataFrame, frequent: DataFrame) -> DataFrame:
    """l, r and score of the cut with the lowest score, the first of equal ones."""
    k = F.explode(F.sequence(F.lit(1), F.col("length") - 1))
    cuts = candidates.withColumn("k", k)
    cuts = cuts.withColumn("left", F.expr("substring_index(phrase, ' ', k)"))
    cuts = cuts.withColumn("right", F.expr("substring_index(phrase, ' ', k - length)"))
    for side, name in (("left", "l"), ("right", "r")):
        known = frequent.select("lang", F.col("phrase").alias(side), F.col("total").alias(name))
        cuts = cuts.join(known, ["lang", side])
    # up to 10**15 occurrences: the square times a million has 36 digits
    score = F.expr(
        "(1000000BD * CAST(a AS DECIMAL(15,0)) * CAST(a AS DECIMAL(15,0)))"
        " div (CAST(l AS DECIMAL(15,0)) * CAST(r AS DECIMAL(15,0)))"
    )
    least = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    return cuts.groupBy("lang", "phrase", "length", "a").agg(least).select(
        "lang", "phrase", "length", "a", "cut.l", "cut.r", "cut.score"
    )


def _absorbed(candidates: DataFrame, share: int) -> DataFrame:
    """Phrases inside a longer candidate with at least ``share`` hundredths of their count, and theirs."""
    spans = F.expr(
        "flatten(transform(sequence(2, length - 1), n -> transform(sequence(1, length - n + 1),"
        " s -> array_join(slice(split(phrase, ' '), s, n), ' '))))"
    )
    inner = candidates.where("length > 2").select("lang", F.explode(spans).alias("phrase"), "a")
    around = inner.groupBy("lang", "phrase").agg(F.max("a").alias("around"))
    met = candidates.join(around, ["lang", "phrase"])
    return met.where(100 * F.col("around") >= share * F.col("a")).select("lang", "phrase")


def collocations(
    docs: DataFrame,
    max_words: int = MAX_WORDS,
    least: int = LEAST_COUNT,
    share: int = ABSORBED,
    best: int = BEST,
    block_bytes: int = BLOCK_BYTES,
    lang_col: str = "lang",
    text_col: str = "text",
) -> DataFrame:
    """The ``best`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Every row counts, repeated ones and those without an id too. Null texts are empty, a null language is
    ``und`` (and one with rows of that name). Equal scores rank by higher count, then by phrase in byte order.
    Languages without candidates, and an empty table, give no rows. Other columns are not read.
    """
    slim = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text")
    )
    # single words have no head to deal them by; a place holds a bounded share of each block's words
    shares = max(256, 16 * slim.rdd.getNumPartitions())
    level = _frequent(slim.mapInArrow(_words(shares, block_bytes), _LEVEL), least, "words")
    words = level.where("packed IS NOT NULL").groupBy("lang").agg(F.sum("start").alias("n"))
    levels, found = [level], [_totals(level, 1)]
    for length in range(2, max_words + 1):
        blocks = level.where("block IS NOT NULL").groupBy("block")
        longer = blocks.applyInArrow(_extended(length == max_words), _LEVEL)
        level = _frequent(longer, least, f"phrases-{length}")
        levels.append(level)
        found.append(_totals(level, length))
    frequent = found[0]
    for one in found[1:]:
        frequent = frequent.union(one)
    frequent, words = stored(frequent, "frequent"), stored(words, "sizes")
    discard(*levels)
    candidates = frequent.where("length > 1").withColumnRenamed("total", "a")
    scored = _lowest_cut(candidates, frequent).join(_absorbed(candidates, share), ["lang", "phrase"], "left_anti")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    top = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    return top.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
