"""Jaccard self-join of shingle sets: size-aware, with a heavy and a light way.

1. Screen. A document of n shingles that has a partner shares most of its shingles. The first
   n // 2 + 1 of each set, in hash order, go through Spark's shuffle as compact lists; sets with
   too few shared shingles there are linked with nothing and leave. What a partner does not
   publish is allowed for, see ``_least_shared``. Equal sets count once.
2. Order. The sets that stay are stored. A sketch of fixed size counts all their shingles, and each set
   is ordered by (count, hash): rare shingles first. Any fixed order is right; this one keeps a
   passage that a third of all documents share out of the prefixes.
3. Candidates. Light (small) sets publish every two-element subset of their prefix; heavy sets scan the
   inverted lists of single elements, in which light sets near the boundary take part too. The
   boundary is the one of least cost, from subset counts and list lengths of all sets.
4. Verification. Lists form families around their smallest member. Members are compared exactly with it;
   those without a link are compared with all others of the family in blocks, inside tasks. No
   pairs are emitted but links, at most one for each document and group of linked ones in a block.
5. Components come from alternating stars.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.llm import postings
from tallybook.llm.frames import keep_documents, partitions, stored
from tallybook.llm.links import components
from tallybook.llm.words import mixed, parts, shingle_set, word_hashes

SHINGLE_WORDS = 5
#: Two sets link when 100 * common >= SIMILARITY * union.
SIMILARITY = 75
BUCKETS_PER_PARTITION = 4
#: Counters of the sketch that orders shingles (4 bytes each); broadcast, whatever the input.
SKETCH_COUNTERS = 1 << 20
#: Members of a family that are compared in one block.
BLOCK_MEMBERS = 256
_BOUNDARIES = (0, 4, 8, 12, 16, 24, 32, 48, 64, 96)
_SLICES = 16
_SUBSET_SALT = np.uint64(0xD6E8FEB86659FD93)


def needed(n: np.ndarray | int, percent: int = SIMILARITY):
    """Common elements that a set of ``n`` needs with any partner."""
    return -(-percent * n // 100)


def _linked(common: np.ndarray, a: int | np.ndarray, b: int | np.ndarray, percent: int) -> np.ndarray:
    return (common > 0) & (100 * common >= percent * (a + b - common))


def _screened(n: int, percent: int) -> int:
    """Size of the part of a set that the screen reads: over half of it, or its prefix if larger."""
    return max(n - needed(n, percent) + 1, n // 2 + 1) if n else 0


def _least_shared(n: Column, percent: int) -> Column:
    """Screened elements that a set of ``n`` shares at least with what any partner has published.

    A pair with c common elements publishes c less the larger unread part of the two in common, and
    c is at least ``needed`` of the larger set. That is least for a partner of the same size or of one
    more: from any size to the second next, ``needed`` grows by one at least and the unread part by one.
    """

    def left(size: Column) -> Column:
        return F.ceil(size * percent / 100) - F.ceil(size / 2) + 1

    return F.greatest(F.least(left(n), left(n + 1)), F.lit(1))


# 1. Screen

_SCREEN = "bucket int, data binary, ids binary, doc_id bigint, n bigint, name binary, short bigint, shared bigint"
_ARROW = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}


def _rows(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    fields = [c.split(" ") for c in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    arrays = [pa.array(c, _ARROW[t]) for c, (_, t) in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, [n for n, _ in fields])


def _name(found: np.ndarray) -> tuple[bytes, int]:
    """128-bit name of a set, and 64 bits of it."""
    name = xxhash.xxh3_128_digest(found.tobytes())
    return name, int.from_bytes(name[:8], "little", signed=True)


def _sets_and_lists(size: int, percent: int, buckets: int):
    """Rows of one set each (bucket below 0) and compact lists of screened shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in parts(batches):
            rows, keys, held = [], [], {}
            for doc_id, text in zip(part.column("doc_id").to_pylist(), texts, strict=True):
                found = shingle_set(word_hashes(text.lower().split()), size)
                name, short = _name(found)
                rows.append((-1 - name[0] % buckets, None, None, doc_id, len(found), name, short, None))
                if len(found) and doc_id is not None and short not in held:
                    held[short] = len(held)
                    keys.append(found[: _screened(len(found), percent)])
            if held:
                owners = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
                names = np.array(list(held), np.int64)
                for bucket, data, own in postings.dealt(np.concatenate(keys), owners, names, buckets):
                    rows.append((bucket, data, own, *[None] * 5))
            yield _rows(_SCREEN, rows)

    return run


def _count_shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per set, how many of its screened shingles another set has; set rows pass through.

    Rows come sorted by bucket. Of one task's totals a bounded number is held.
    """
    held, lists, totals = None, [], {}

    def decide() -> None:
        keys, names = postings.gathered(lists, np.int64)
        lists.clear()
        once = np.append(True, (keys[1:] != keys[:-1]) | (names[1:] != names[:-1]))
        keys, names = keys[once], names[once]
        lengths = np.diff(np.append(postings.runs(keys), len(keys)))
        shared, counts = np.unique(names[np.repeat(lengths, lengths) > 1], return_counts=True)
        for name, count in zip(shared.tolist(), counts.tolist(), strict=True):
            totals[name] = totals.get(name, 0) + count

    def results() -> pa.RecordBatch:
        rows = [(*[None] * 6, name, count) for name, count in totals.items()]
        totals.clear()
        return _rows(_SCREEN, rows)

    for batch in batches:
        sets = batch.filter(batch.column("name").is_valid())
        if sets.num_rows:
            yield sets
        some = batch.filter(batch.column("data").is_valid())
        for bucket, data, ids in zip(*(c.to_pylist() for c in some.columns[:3]), strict=True):
            if bucket != held and lists:
                decide()
                if len(totals) > 500_000:
                    yield results()
            held = bucket
            lists.append((data, ids))
    if lists:
        decide()
    yield results()


def _stored_sets(size: int):
    """Sorted shingles of the sets that stay, as bytes; a row whose set has another name is none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in parts(batches):
            rows = []
            wanted = zip(part.column("rid").to_pylist(), part.column("name").to_pylist(), texts, strict=True)
            for rid, name, text in wanted:
                found = shingle_set(word_hashes(text.lower().split()), size)
                if _name(found)[0] == name:
                    rows.append((rid, len(found), found.tobytes()))
            yield _rows(_SETS, rows)

    return run


_SETS = "rid bigint, n bigint, keys binary"


# 2. Order


def _counters(keys: np.ndarray) -> np.ndarray:
    return (keys & np.uint64(SKETCH_COUNTERS - 1)).astype(np.int64)


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(SKETCH_COUNTERS, np.int64)
    for batch in batches:
        for data in batch.column("keys").to_pylist():
            np.add.at(total, _counters(np.frombuffer(data, np.uint64)), 1)
    for k, piece in enumerate(np.split(total, _SLICES)):
        data = zstandard.ZstdCompressor(level=1).compress(piece.tobytes())
        yield _rows(_SLICE, [(k, data)])


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            piece = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.int64)
            totals[k] = totals[k] + piece if k in totals else piece
    yield _rows(_SLICE, [(k, np.minimum(x, 2**31 - 1).astype(np.int32).tobytes()) for k, x in totals.items()])


_SLICE = "slice int, data binary"


def _sketch(sets: DataFrame) -> np.ndarray:
    """Counts of all shingles in a table of fixed size: 4 MB, however many sets there are."""
    slices = sets.select("keys").mapInArrow(_sketched, _SLICE).repartition(_SLICES, "slice")
    total = np.zeros(SKETCH_COUNTERS, np.int32).reshape(_SLICES, -1)
    for k, data in slices.mapInArrow(_summed, _SLICE).collect():
        total[k] = np.frombuffer(data, np.int32)
    return total.ravel()


# 3. Candidates


def _prefix(keys: np.ndarray, sketch: np.ndarray, length: int) -> np.ndarray:
    """The first elements of a set, rare ones first; ties go by hash, so all sets agree."""
    return keys[np.lexsort((keys, sketch[_counters(keys)]))[:length]]


def _costs(sketch, percent: int):
    """Rows of subsets and of list scans, as if each boundary were chosen."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(_BOUNDARIES))
        for batch in batches:
            for n, data in zip(batch.column("n").to_pylist(), batch.column("keys").to_pylist(), strict=True):
                p = n - needed(n, percent) + 1
                first = _prefix(np.frombuffer(data, np.uint64), sketch.value, p)
                scanned = float(sketch.value[_counters(first)].sum())
                for k, b in enumerate(_BOUNDARIES):
                    if 2 <= n <= b:
                        total[k] += p * (p + 1) / 2
                    if n > b or n >= needed(b + 1, percent):
                        total[k] += scanned
        rows = [(k, int(x)) for k, x in enumerate(total)]
        yield _rows("boundary int, cost bigint", rows)

    return run


def _entries(sketch, percent: int, boundary: int):
    """Keys under which a set meets its candidates: subsets and single elements."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rids, keys = [], []
            for rid, n, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                p = n - needed(n, percent) + 1
                first = _prefix(np.frombuffer(data, np.uint64), sketch.value, min(n, p + 1))
                if 2 <= n <= boundary:
                    two = np.array(list(combinations(first, 2)), np.uint64)
                    keys.append(mixed(two[:, 0] * _SUBSET_SALT + two[:, 1]))
                    rids.append(np.full(len(two), rid, np.int64))
                if n > boundary or n < 2 or n >= needed(boundary + 1, percent):
                    keys.append(first[:p])
                    rids.append(np.full(len(keys[-1]), rid, np.int64))
            if keys:
                arrays = [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(rids))]
                yield pa.RecordBatch.from_arrays(arrays, ["meet", "rid"])

    return run


# 4. Verification


def _against_first(percent: int):
    """Members of a family part against its first member, which comes first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, head = None, None
        for batch in batches:
            rows = []
            for hub, part, rid, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                keys = np.frombuffer(data, np.uint64)
                if (hub, part) != now:
                    now, head = (hub, part), keys
                if rid != hub:
                    common = len(keys) + len(head) - len(np.union1d(keys, head))
                    linked = _linked(np.int64(common), len(keys), len(head), percent)
                    rows.append((hub, rid, int(linked)))
            yield _rows("hub bigint, rid bigint, linked int", rows)

    return run


class _Groups:
    """Union-find over the documents of one block."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        while (above := self.up.get(x, x)) != x:
            self.up[x] = x = self.up.get(above, above)
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


def _in_blocks(percent: int):
    """Links between the unlinked members of a block (they come first) and its other members."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, index = None, None
        for batch in batches:
            links = []
            for hub, lot, part, side, linked, rid, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                keys = np.frombuffer(data, np.uint64)
                if (hub, lot, part) != now:
                    now, index, groups = (hub, lot, part), None, _Groups()
                    rids, sets = [], []
                if side == 0:
                    rids.append(rid)
                    sets.append(keys)
                    index = None
                    continue
                if not sets:
                    continue
                if index is None:
                    sizes = np.array([len(x) for x in sets])
                    owners = np.repeat(np.arange(len(sets)), sizes)
                    flat = np.concatenate(sets)
                    order = np.argsort(flat, kind="stable")
                    index, owners = flat[order], owners[order]
                low = np.searchsorted(index, keys, "left")
                count = np.searchsorted(index, keys, "right") - low
                at = np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())
                common = np.bincount(owners[at], minlength=len(sets))
                for k in np.flatnonzero(_linked(common, sizes, len(keys), percent)).tolist():
                    if rids[k] != rid and groups.join(rids[k], hub if linked else rid):
                        links.append((rids[k], rid))
            yield _rows("u bigint, v bigint", links)

    return run


def _family_links(entries: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) that connect all linked sets which meet under some entry."""
    hubs = entries.groupBy(F.col("meet").alias("at")).agg(F.min("rid").alias("hub"), F.count("*").alias("members"))
    met = entries.join(hubs.where("members > 1"), F.col("meet") == F.col("at"))
    families = stored(met.where("rid != hub").select("hub", "rid").distinct(), "families")
    keys = sets.select(F.col("rid").alias("set_rid"), "keys")

    # hot families are dealt over several tasks, each with the first member's set
    counts = families.groupBy("hub").agg(F.count("*").alias("members"))
    width = F.ceil(F.col("members") / (8 * BLOCK_MEMBERS)).cast("int")
    counts = counts.select(F.col("hub").alias("of"), width.alias("width"))
    own = F.pmod(F.xxhash64("rid"), F.col("width")).cast("int")
    members = families.join(counts, F.col("hub") == F.col("of")).select("hub", own.alias("part"), "rid")
    spread = F.explode(F.sequence(F.lit(0), F.col("width") - 1))
    heads = counts.select(F.col("of").alias("hub"), spread.alias("part"), F.col("of").alias("rid"))
    rows = members.union(heads).join(keys, F.col("rid") == F.col("set_rid"))
    rows = rows.select("hub", "part", "rid", "keys").repartition("hub", "part")
    rows = rows.sortWithinPartitions("hub", "part", F.col("rid") != F.col("hub"))
    compared = rows.mapInArrow(_against_first(percent), "hub bigint, rid bigint, linked int")
    compared = stored(compared, "compared")
    links = compared.where("linked = 1").select(F.col("hub").alias("u"), F.col("rid").alias("v"))

    # what the first member did not link meets the rest of its family, block by block
    sizes = compared.groupBy(F.col("hub").alias("of")).agg(
        F.ceil(F.sum(1 - F.col("linked")) / BLOCK_MEMBERS).cast("int").alias("lots"),
        F.ceil(F.count("*") / BLOCK_MEMBERS).cast("int").alias("parts"),
        F.count("*").alias("members"),
    )
    sizes = sizes.where("lots > 0 AND members > 1")
    rest = compared.join(sizes, F.col("hub") == F.col("of"))
    place = F.xxhash64("rid", F.lit("block"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    lot, part = (F.pmod(place, F.col(n)).cast("int") for n in ("lots", "parts"))
    left = rest.where("linked = 0").withColumn("lot", lot).withColumn("part", every("parts"))
    right = rest.withColumn("part", part).withColumn("lot", every("lots"))
    block = ["hub", "lot", "part"]
    both = left.select(*block, F.lit(0).alias("side"), "linked", "rid").union(
        right.select(*block, F.lit(1).alias("side"), "linked", "rid")
    )
    rows = both.join(keys, F.col("rid") == F.col("set_rid")).drop("set_rid")
    rows = rows.repartition(*block).sortWithinPartitions(*block, "side", "rid")
    return links.union(rows.mapInArrow(_in_blocks(percent), "u bigint, v bigint"))


def similar_documents(
    docs: DataFrame,
    size: int = SHINGLE_WORDS,
    percent: int = SIMILARITY,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (smallest id reachable by links).

    Shingles are ``size`` words in a row, A-Z lowered; a text with fewer words is one shingle. Null
    and empty texts have no shingles and no links. A row with a null id links with nothing and has
    no component. Rows that repeat an id are one document. Other columns are not read.
    """
    if not 50 < percent <= 100:
        raise ValueError("the join needs a similarity above 50 per cent")
    spark = docs.sparkSession
    slim = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    buckets = BUCKETS_PER_PARTITION * partitions(spark)
    lists = slim.mapInArrow(_sets_and_lists(size, percent, buckets), _SCREEN)
    dealt = lists.repartition("bucket").sortWithinPartitions("bucket")
    screen = stored(dealt.mapInArrow(_count_shared, _SCREEN), "screen")
    all_sets = screen.where("name IS NOT NULL").select("doc_id", "n", "name", "short")

    some = all_sets.where("n > 0 AND doc_id IS NOT NULL")
    firsts = some.groupBy("name").agg(F.min("doc_id").alias("rid"), F.min("n").alias("n"), F.min("short").alias("short"))
    shared = screen.where("shared IS NOT NULL").groupBy(F.col("short").alias("of")).agg(F.sum("shared").alias("shared"))
    stay = firsts.join(shared, F.col("short") == F.col("of"))
    stay = stay.where(F.col("shared") >= _least_shared(F.col("n"), percent))
    again = slim.join(stay.select("rid", "name"), F.col("doc_id") == F.col("rid"))
    sets = stored(again.select("rid", "name", "text").mapInArrow(_stored_sets(size), _SETS), "sets")

    sketch = spark.sparkContext.broadcast(_sketch(sets))
    costs = sets.mapInArrow(_costs(sketch, percent), "boundary int, cost bigint")
    cost = {r["boundary"]: r["cost"] for r in costs.groupBy("boundary").agg(F.sum("cost").alias("cost")).collect()}
    boundary = _BOUNDARIES[min(cost, key=lambda k: (cost[k], k))] if cost else 0
    entries = sets.mapInArrow(_entries(sketch, percent, boundary), "meet bigint, rid bigint")
    found = components(_family_links(entries, sets, percent))

    named = firsts.select(F.col("name").alias("of_name"), "rid")
    out = all_sets.join(named, (F.col("name") == F.col("of_name")) & F.col("doc_id").isNotNull(), "left")
    out = out.join(found, F.col("rid") == F.col("node"), "left")
    component = F.coalesce("component", "rid", "doc_id").alias("component_id")
    return out.select("doc_id", F.col("n").alias("n_shingles"), component)


def drop_similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs``, all columns, of one document a component; rows without an id stay."""
    found = similar_documents(docs, id_col=id_col, text_col=text_col)
    kept = found.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    return keep_documents(docs, kept.select(F.col("doc_id").alias(id_col)).distinct(), id_col)
