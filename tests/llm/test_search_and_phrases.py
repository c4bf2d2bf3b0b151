"""Fingerprints, ranked search and collocations against brute force, with nulls, ties and repeats."""

import hashlib
import math
import random
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import brute
from compare import connect
from test_llm_operators import frame, items_of, odd_rows, prose  # noqa: F401

from tallybook.llm import collocations, fingerprints, ranked
from tallybook.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprint_query_equals_brute_force(spark):
    documents = connect(SF_DIR).execute("SELECT doc_id, text FROM documents").fetchall()
    rows = {r.doc_id: r for r in QUERIES["op11_document_fingerprints"](spark, SF_DIR).collect()}
    assert len(rows) == len(documents)
    by_text, errors = {}, []
    for doc_id, text, edited, after in brute.edits(documents):
        row = rows[doc_id]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert by_text.setdefault(text, row.fingerprint) == row.fingerprint
        sets = [brute.shingles(x) for x in (text, edited, after)]
        for got, other in ((row.near_edited, sets[1]), (row.near_next, sets[2])):
            true = jaccard(sets[0], other)
            if len(sets[0] | other) <= fingerprints.SKETCH_SIZE:
                assert got == true
            errors.append(got - true)
            assert abs(got - true) < 5 * 0.5 / math.sqrt(fingerprints.SKETCH_SIZE)
    assert abs(np.mean(errors)) < 0.01


@pytest.mark.parametrize("ranges", ["1", "4", "40"])
def test_edits_do_not_depend_on_ranges(spark, odd_rows, ranges):  # noqa: F811
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    try:
        found = fingerprints.edited_sketches(frame(spark, odd_rows).repartition(3)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    expected = [(d, len(t), e) for d, t, e, _ in brute.edits(odd_rows)]
    assert sorted(map(str, [(r.doc_id, r.n_chars, r.edited) for r in found])) == sorted(map(str, expected))


def test_single_document_follows_itself(spark):
    row = fingerprints.edited_sketches(frame(spark, [(7, "abcde")])).first()
    assert (row.edited, row.next_sketch) == ("abcab", row.sketch)



def test_sketches_merge_and_estimate(spark):
    rnd = random.Random(3)
    a, b = prose(rnd, 6000, 10**6), prose(rnd, 3000, 10**6)
    words_a = a.split()
    # parts overlap by four words, so that no shingle is lost at a cut
    cut = [" ".join(words_a[max(0, i - 4) : i + 500]) for i in range(0, 6000, 500)]
    rows = [(1, x) for x in cut] + [(2, f"{a} {b}"), (3, b), (4, ""), (5, None), (None, "x y")]
    parts = fingerprints.document_sketches(frame(spark, rows).repartition(5))
    merged = fingerprints.merge_sketches(parts, ["doc_id"])
    by_id = {r.doc_id: r.sketch for r in merged.collect()}
    assert by_id[1] == fingerprints.sketch(a.encode()).tolist()
    assert by_id[4] == by_id[5] == [] and len(by_id[None]) == 1
    pair = spark.createDataFrame([(by_id[1], by_id[2], [])], "a array<bigint>, b array<bigint>, e array<bigint>")
    A, B, E = F.col("a"), F.col("b"), F.col("e")
    got = pair.select(
        fingerprints.distinct_shingles(B).alias("n"), fingerprints.resemblance(A, B).alias("j"),
        fingerprints.containment(A, B).alias("c"), fingerprints.containment(B, A).alias("d"),
        fingerprints.resemblance(A, E).alias("none"), fingerprints.resemblance(E, E).alias("same"),
    ).first()
    assert abs(got.n / 8996 - 1) < 0.35 and abs(got.j - 2 / 3) < 0.2
    assert got.c > 0.7 and abs(got.d - 2 / 3) < 0.25
    assert (got.none, got.same) == (0.0, 1.0)


def test_hot_key_merges_before_the_exchange(spark):
    parts = spark.range(10_000).select(F.lit(1).alias("k"), F.array("id").alias("sketch"))
    merged = fingerprints.merge_sketches(parts, ["k"], 16)
    assert merged.first().sketch == list(range(16))
    assert "WindowGroupLimit" in merged._jdf.queryExecution().executedPlan().toString()


def test_ranked_equals_brute_force_on_odd_rows(spark, odd_rows):  # noqa: F811
    items = [(1, "Two words é w7 w7"), (2, None), (3, ""), (4, "no-such-term"), (None, "one"), (5, "w1 w2 w3"), (5, "w4")]
    asked = spark.createDataFrame(items, "item_id bigint, text string")
    found = ranked.ranked_search(frame(spark, odd_rows).repartition(3), asked).collect()
    expected = brute.ranked(odd_rows, items)
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, expected))


@pytest.mark.parametrize("sizes", [(400, 200), (3000, 10**6)])
def test_ranked_over_many_blocks_and_lots(spark, sizes):
    """Ties, skewed terms and very different lengths; blocks and lots of a few rows each."""
    rnd = random.Random(sizes[0])
    vocabulary = [f"t{int(rnd.paretovariate(0.7))}" for _ in range(3000)]
    rows = [(d, " ".join(rnd.choices(vocabulary, k=rnd.choice([1, 2, 5, 30, 200])))) for d in range(400)]
    rows += [(1000 + d, rows[d][1]) for d in range(0, 400, 3)]
    items = [(i, " ".join(rnd.choices(vocabulary, k=rnd.choice([1, 3, 12])))) for i in range(25)]
    asked = spark.createDataFrame(items, "item_id bigint, text string")
    sized = {"block_bytes": sizes[0], "lot_bytes": sizes[1]}
    found = [tuple(r) for r in ranked.ranked_search(frame(spark, rows).repartition(4), asked, **sized).collect()]
    assert sorted(found) == sorted(brute.ranked(rows, items))


def test_accumulators_stop_and_stay_exact():
    rnd = np.random.default_rng(1)
    for _ in range(200):
        size, k = int(rnd.integers(1, 60)), int(rnd.integers(1, 6))
        terms = []
        for _ in range(int(rnd.integers(0, 8))):
            at = np.flatnonzero(rnd.random(size) < rnd.choice([0.05, 0.4, 0.9]))
            terms.append((int(rnd.integers(0, 50)), at, rnd.integers(1, 9, len(at))))
        terms.sort(key=lambda t: len(t[1]))
        full = np.zeros(size, np.int64)
        for weight, at, impacts in terms:
            full[at] += weight * impacts
        rows, scores = ranked.best_of_block(size, terms, k)
        assert (full[rows] == scores).all() and (scores > 0).all()
        kth = np.sort(full)[-k] if size >= k else 0
        assert set(np.flatnonzero((full > 0) & (full >= kth))) == set(rows.tolist())


def corpus(rnd, n):
    common = [f"c{k}" for k in range(12)]
    fixed = ["new york city", "New york", "in spite of", "é ß\tü", "a b a b a b"]
    rows = []
    for _ in range(n):
        parts = [rnd.choice(fixed) if rnd.random() < 0.3 else " ".join(rnd.choices(common, k=rnd.randrange(1, 6))) for _ in range(8)]
        ends = [rnd.choice([" ", ", ", ".", "\n", ";", "\t", "!?", "\x0b", " "]) for _ in parts]
        rows.append((rnd.choice(["en", "de", None, "und"]), "".join(p + e for p, e in zip(parts, ends, strict=True))))
    return rows + [("en", None), ("fr", ""), (None, "..."), ("es", "solo"), ("en", "the the " * 3000)]


@pytest.mark.parametrize("options", [{}, {"least": 2, "share": 90}, {"max_words": 4, "least": 3}, {"best": 7}, {"max_words": 2}])
def test_collocations_equal_brute_force(spark, options):
    rows = corpus(random.Random(8), 150)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    found = [tuple(r) for r in collocations.collocations(docs, block_bytes=3000, **options).collect()]
    assert sorted(found) == sorted(brute.collocations(rows, **options))


def _level(rows):
    """Phrase lists of blocks as Arrow rows: (block, head, shard, tails with counts)."""
    out = []
    for block, head, shard, phrases in rows:
        columns = {"block": [block], "lang": ["en"], "head": [head], "shard": [shard], "start": [0]}
        columns |= {"spread": [2], "tails": ["\t".join(t for t, _ in phrases)], "counts": [[n for _, n in phrases]]}
        out.append(collocations._batch(1, **columns))
    return out


def test_groups_across_batches_are_counted_once():
    rows = [(b, h, s, [(f"t{(b + k) % 5}", 2) for k in range(3)]) for h in "abc" for s in (0, 1) for b in range(7)]
    whole = pa.Table.from_batches(_level(rows)).combine_chunks().to_batches()
    results = []
    for batches in (whole, _level(rows)):
        got = pa.Table.from_batches(list(collocations._counted(9)(iter(batches)))).to_pylist()
        results.append(sorted(map(str, got)))
    assert results[0] == results[1]
    totals = [r for r in got if r["block"] is None]
    expected = Counter()
    for _, h, s, phrases in rows:
        for t, n in phrases:
            expected[h, s, t] += n
    assert {(r["head"], r["shard"], t): n for r in totals for t, n in zip(r["tails"].split("\t"), r["totals"], strict=True)} == {
        k: n for k, n in expected.items() if n >= 9
    }


def test_long_relations_are_cut_and_join_again(monkeypatch):
    monkeypatch.setattr(collocations, "_PART", 7)
    at = np.cumsum(np.random.default_rng(2).integers(1, 3, 40))
    items = np.arange(40) % 3
    runs = list(collocations._relation(5, "en", at, items))
    assert len(runs) == 6
    listed = collocations._batch(
        1, block=[5], lang=["en"], head=[""], shard=[0], tails=["x\ty\tz"], spread=[1], items=[[0, 1, 2]], counts=[[50, 60, 70]]
    )
    longer = collocations._extended(True)(pa.Table.from_batches([*runs, listed])).to_pylist()
    got = {(r["head"], t): n for r in longer for t, n in zip(r["tails"].split("\t"), r["counts"], strict=True)}
    names = "xyz"
    assert got == Counter((names[i % 3], names[(i + 1) % 3]) for i in range(39) if at[i + 1] == at[i] + 1)


def test_scores_stay_exact_beyond_64_bits(spark):
    a, l, r = 3_000_000_000_007, 3_000_000_000_011, 4_999_999_999_999
    phrases = [("en", "x y", 2, a)]
    candidates = spark.createDataFrame(phrases, "lang string, phrase string, length int, a bigint")
    known = spark.createDataFrame([("en", "x", l), ("en", "y", r)], "lang string, phrase string, total bigint")
    assert collocations._lowest_cut(candidates, known).first().score == 1_000_000 * a * a // (l * r)
