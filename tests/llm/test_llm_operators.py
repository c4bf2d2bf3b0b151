"""Operators on hand-made frames: nulls, empty and long texts, ties, repeats, clashing columns."""

import random
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import brute

import corpus_pipeline
from tallybook.llm import collocations, contamination, exact, fingerprints, licences, packing, passages
from tallybook.llm import personal, postings, quality, ranked, setjoin, sharding, suffixes
from tallybook.llm.links import components
from tallybook.llm.queries import tokenizer_path
from tallybook.llm.words import mixed

CLASHING = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, uid string, keep_id int, "
    "kept string, rid string, n string, name string, hub int, score string, measures string, "
    "bucket string, component_id int, ids string, hash string, __kept_id string, row string, line string, "
    "block string, lot string, terms string, m string, place string, after string, sketch string, phrase string, "
    "item string, item_id string, top string, rank string, total string, deal string"
)


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def clashing(spark, rows):
    extra = len(CLASHING.split(",")) - 5
    return spark.createDataFrame([(d, t, "en", "s", 1, *[None] * extra) for d, t in rows], CLASHING)


def prose(rnd, n, vocabulary=400):
    return " ".join(f"w{rnd.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="module")
def odd_rows():
    rnd = random.Random(5)
    passage = prose(rnd, 70, 10_000)
    long = prose(rnd, 60_000, 50_000)
    base = prose(rnd, 120, 10_000).split()
    near = [" ".join(["x" + str(k) if j == 7 * k else w for j, w in enumerate(base)]) for k in range(6)]
    return [
        (1, None), (2, ""), (3, " \t\n"), (4, "One"), (5, "one"), (6, "Two words"), (7, "two WORDS"),
        (8, f"{prose(rnd, 30)} {passage} {prose(rnd, 20)}"), (9, f"{passage} {prose(rnd, 40)}"),
        (10, long), (11, long.upper()), (None, passage), (None, "One"), (None, None), (12, "é É ß"), (12, "é É ß"),
        (13, "É é SS"), (14, "a " * 500), (15, "a " * 500 + "b"), *[(20 + k, t) for k, t in enumerate(near)],
        (30, "a|b <|endoftext|> C"), (31, "mail me@x.org, +1 (743) 555-3824 or 4111 1111 1111 1111; 10.0.0.1"),
    ]


OPERATORS = {
    "exact": lambda d: exact.exact_duplicates(d),
    "passages": lambda d: passages.remove_repeated_windows(d),
    "suffixes": lambda d: suffixes.repeated_passages(d),
    "setjoin": lambda d: setjoin.similar_documents(d),
    "sharding": lambda d: sharding.extendible_shards(d, 1000),
    "personal": lambda d: personal.personal_spans(d),
    "licences": lambda d: licences.licence_notices(d),
    "pieces": lambda d: packing.pack_pieces(packing.token_pieces(d, tokenizer_path())),
    "quality": lambda d: quality.classify_quality(d, labels_of(d)),
    "leaks": lambda d: contamination.benchmark_leaks(d, items_of(d)),
    "sketches": lambda d: fingerprints.document_sketches(d),
    "edits": lambda d: fingerprints.edited_sketches(d),
    "ranked": lambda d: ranked.ranked_search(d, items_of(d)),
    "collocations": lambda d: collocations.collocations(d.withColumn("lang", F.lit("en")), least=2),
}


def labels_of(docs):
    return docs.sparkSession.createDataFrame(
        [(4, 1, 0), (6, 1, 0), (9, 1, 0), (14, 0, 0), (None, 1, 0), (15, None, 0)], "doc_id bigint, quality int, toxic int"
    )


def items_of(docs):
    rows = [(1, "two words"), (2, None), (3, ""), (None, "one"), (5, "é é ß")]
    return docs.sparkSession.createDataFrame(rows, "item_id bigint, text string")


@pytest.mark.parametrize("name", list(OPERATORS))
def test_no_rows_in_no_rows_out(spark, name):
    assert OPERATORS[name](frame(spark, [])).collect() == []


@pytest.mark.parametrize("name", list(OPERATORS))
def test_clashing_columns_change_nothing(spark, name, odd_rows):
    def rows(docs):
        return sorted(map(str, OPERATORS[name](docs.repartition(1)).drop("sequence_id").collect()))

    assert rows(clashing(spark, odd_rows)) == rows(frame(spark, odd_rows))


def test_exact_equals_brute_force(spark, odd_rows):
    rows = exact.exact_duplicates(frame(spark, odd_rows).repartition(3)).collect()
    found = sorted(map(str, [(r.doc_id, r.keep_id, r.group_size, r.kept, r.digest.hex()) for r in rows]))
    assert found == sorted(map(str, brute.exact(odd_rows)))


@pytest.mark.parametrize("limit", [1, 300, 1 << 20])
def test_exact_with_equal_digests_and_small_tables(spark, limit):
    rows = [(k, f"text {k % 17}") for k in range(120)]
    same = lambda text: (b"%d" % (len(text) % 2)) * 32
    found = exact.exact_duplicates(frame(spark, rows).repartition(4), digest_of=same, table_bytes=limit)
    expected = sorted(x[:4] for x in brute.exact(rows))
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in found.collect()) == expected


def test_exact_splits_large_buckets(spark):
    rows = [(k, f"{k % 300} " * 20) for k in range(900)]
    one_side = lambda text: b"\x00" + exact.sha256(text)[1:]
    found = exact.exact_duplicates(frame(spark, rows).repartition(4), digest_of=one_side, table_bytes=500)
    expected = sorted(x[:4] for x in brute.exact(rows))
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in found.collect()) == expected


def test_content_table_grows():
    table = exact.ContentTable(4)
    texts = [b"%d" % (k % 50) for k in range(200)]
    places = [table.place(b"same digest", t)[0] for t in texts]
    assert places == [k % 50 for k in range(200)]


def test_windows_equal_brute_force(spark, odd_rows):
    found = passages.remove_repeated_windows(frame(spark, odd_rows).repartition(3)).collect()
    rows = [(r.doc_id, r.n_words, sum(x.end - x.start for x in r.intervals), r.kept) for r in found]
    assert sorted(map(str, rows)) == sorted(map(str, brute.removed(odd_rows)))


def test_suffixes_find_the_passage(spark, odd_rows):
    rows = {r.doc_id: r for r in suffixes.repeated_passages(frame(spark, odd_rows).repartition(3)).collect()}
    known = [(d, t) for d, t in odd_rows if d is not None]
    long = brute.repeated(known, 50)
    assert {d for d, x in long.items() if x} <= set(rows)
    assert rows[8].n_words == rows[9].n_words == 70
    assert 10 not in rows and 4 not in rows


@pytest.mark.parametrize("seed", range(3))
def test_suffixes_match_other_documents_only(spark, seed):
    """Passages that a document repeats itself, with and without what surrounds them."""
    rnd = random.Random(seed)
    passages = [prose(rnd, rnd.choice([36, 52, 60, 90]), 10**6) for _ in range(6)]
    rows = [(d, " ".join(prose(rnd, rnd.randrange(1, 40), 10**6) + " " + rnd.choice(passages) for _ in range(3))) for d in range(12)]
    edge = [prose(rnd, 20, 10**6) for _ in range(2)]
    rows += [(20, f"{edge[0]} {passages[2]} {edge[1]} {prose(rnd, 9, 10**6)} {edge[0]} {passages[2]} {edge[1]}"), (21, passages[2])]
    found = {r.doc_id: r.intervals for r in suffixes.repeated_passages(frame(spark, rows).repartition(3)).collect()}
    long, body = brute.repeated(rows, 50), brute.repeated(rows, 35)
    for doc_id, _ in rows:
        covered = {k for x in found.get(doc_id, []) for k in range(x.start, x.end)}
        assert long[doc_id] <= covered <= body[doc_id]


def test_components_equal_brute_force(spark, odd_rows):
    rows = [(d, t) for d, t in odd_rows if d != 12]
    found = setjoin.similar_documents(frame(spark, rows).repartition(3)).collect()
    expected = brute.components(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found if r.doc_id is not None} == expected
    assert all(r.component_id is None for r in found if r.doc_id is None)
    assert len(found) == len(rows)


@pytest.mark.parametrize("block", [4, 256])
def test_components_of_near_copies(spark, monkeypatch, block):
    """Chains, hot lines, sets of all sizes around the boundary; small blocks split families."""
    monkeypatch.setattr(setjoin, "BLOCK_MEMBERS", block)
    rnd = random.Random(block)
    line = prose(rnd, 40, 10_000)
    rows = []
    for group in range(30):
        base = prose(rnd, rnd.choice([1, 3, 5, 6, 8, 9, 14, 20, 33, 60, 150]), 5_000).split()
        for _ in range(12):
            words = list(base)
            for _ in range(rnd.randint(0, max(1, len(base) // 40))):
                words[rnd.randrange(len(words))] = f"n{rnd.randrange(9)}"
            base = words if group % 2 else base
            tail = f" {line}" if rnd.random() < 0.4 else ""
            rows.append((len(rows), " ".join(words) + tail))
    found = setjoin.similar_documents(frame(spark, rows).repartition(5)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute.components(rows)


@pytest.mark.parametrize("percent", [75, 60])
def test_components_of_texts_within_texts(spark, percent):
    """Pairs alone with their shingles: a short text, and the same with a word before or behind it."""
    rnd = random.Random(percent)
    rows = []
    for group in range(300):
        words = [f"g{group}w{k}{rnd.random()}" for k in range(rnd.choice([6, 7, 7, 7, 8, 9, 11]))]
        for text in (words, [f"g{group}", *words] if group % 2 else [*words, f"g{group}"]):
            rows.append((len(rows), " ".join(text)))
    found = setjoin.similar_documents(frame(spark, rows).repartition(3), percent=percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute.components(rows, percent)


def test_screen_allows_for_what_partners_leave_out(spark):
    """Least overlap of published parts, over all sizes of a linked pair, against the screen's demand."""
    sizes = range(1, 121)
    for percent in (51, 55, 60, 67, 75, 80, 90, 100):
        demand = spark.range(1, 121).select(setjoin._least_shared(F.col("id"), percent).alias("x")).collect()
        demand = {n: r.x for n, r in zip(sizes, demand, strict=True)}
        unread = {n: n - setjoin._screened(n, percent) for n in sizes}
        for n in sizes:
            for m in range(n, min(120, 100 * n // percent) + 1):
                common = -(-percent * (n + m) // (100 + percent))
                assert common - max(unread[n], unread[m]) >= max(demand[n], demand[m]) >= 1, (percent, n, m)


def test_join_refuses_low_similarity(spark):
    with pytest.raises(ValueError):
        setjoin.similar_documents(frame(spark, []), percent=50)


def test_star_components(spark):
    rnd = random.Random(2)
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)]
    edges += [(rnd.randrange(200, 300), rnd.randrange(200, 300)) for _ in range(60)] + [(None, 3), (5, 5)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert all(found[k] == 0 for k in range(1, 41)) and all(found[k] == 100 for k in range(101, 160))
    root = {k: k for k in range(200, 300)}
    for _ in range(100):
        for a, b in edges[99:159]:
            root[a] = root[b] = min(root[a], root[b])
    assert all(found.get(k, k) == root[k] for k in root)


def test_postings_round_trip():
    rnd = np.random.default_rng(1)
    keys = mixed(rnd.integers(0, 1 << 60, 5000).astype(np.uint64))
    owners = rnd.integers(0, 70, 5000)
    ids = rnd.integers(-(1 << 60), 1 << 60, 70)
    rows = list(postings.dealt(keys, owners, ids, 13))
    assert [r[0] for r in rows] == sorted({r[0] for r in rows})
    got = [postings.gathered([r[1:]]) for r in rows]
    pairs = {(k, i) for a, b in got for k, i in zip(a.tolist(), b.tolist(), strict=True)}
    assert pairs == set(zip(keys.tolist(), ids[owners].tolist(), strict=True))
    assert list(postings.dealt(keys[:0], owners[:0], ids, 13)) == []


def test_personal_base_kinds_equal_patterns():
    rnd = random.Random(1)
    alphabet = "0123456789.. @+--a()é1299"
    for _ in range(20_000):
        text = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40)))
        found = [s for s in personal.find_personal(text) if s[0] in brute.PATTERNS]
        assert found == brute.base_spans(text), text


def test_personal_added_kinds():
    text = 'see https://a.b/c?d=1, token = "f0ddae3b09ae", tokens: none; PASSWORD: abc'
    found = [(k, text[a:b]) for k, a, b in personal.find_personal(text)]
    assert found == [("url", "https://a.b/c?d=1"), ("account", "f0ddae3b09ae")]


def test_masking(spark):
    rows = personal.mask_personal(frame(spark, [(1, "to me@x.org now"), (2, None)])).collect()
    assert [r.text for r in rows] == ["to [email] now", None]


def test_encoder_equals_tokenizer():
    rnd = random.Random(3)
    encoder = packing.WordEncoder(tokenizer_path())
    alphabet = "abAB's't|.,!é́ÉßİΣσ 12²½  \t\n\x1c\x85_-…«中K'll<|>"
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 30))) for _ in range(3000)]
    texts += ["a<|endoftext|>b c", "<|ENDOFTEXT|> x", "| a || b |", "x" * 5000]
    for text, ids in zip(texts, encoder.ids([t.encode() for t in texts]), strict=True):
        expected = encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == expected, text


def test_full_bins_close_fullest_first():
    bins = packing.OpenBins(10, 2)
    assert [bins.place(n) for n in (6, 7, 8, 3, 3, 2)] == [(0, 0), (1, 0), (2, 0), (0, 6), (3, 0), (2, 8)]
    rnd = random.Random(4)
    bins, filled = packing.OpenBins(100, 5), {}
    for _ in range(5000):
        n = rnd.randint(1, 100)
        bin_, offset = bins.place(n)
        assert filled.get(bin_, 0) == offset and offset + n <= 100
        filled[bin_] = offset + n
        assert bins.open <= 5


def test_assembled_sequences(spark):
    rows = [(1, "one two three"), (2, None), (3, "four " * 30)]
    pieces = packing.token_pieces(frame(spark, rows), tokenizer_path(), 16)
    packed = packing.pack_pieces(pieces, 16)
    whole = {r.sequence_id: r for r in packing.assemble(packed).collect()}
    for r in packed.collect():
        ids = whole[r.sequence_id].ids
        assert ids[4 * r.offset : 4 * (r.offset + r.length)] == r.ids
        assert len(ids) == 4 * whole[r.sequence_id].length <= 64


def test_shards_of_repeated_rows(spark):
    rows = [(7, "x" * 100)] * 50 + [(8, "y" * 5000), (None, None), (None, "z")]
    found = sharding.extendible_shards(frame(spark, rows), 1000).collect()
    assert len(found) == len(rows)
    shards = {}
    for r in found:
        shards.setdefault((r.bits, r.prefix, r.page), []).append(r.bytes)
    assert all(sum(x) <= 1000 or len(x) == 1 for x in shards.values())


def test_written_shards(spark, tmp_path):
    docs = frame(spark, [(k, "x" * k) for k in range(100)])
    sharding.write_shards(docs, str(tmp_path / "shards"), 1000)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.count() == 100
    assert back.groupBy("shard").agg(F.sum(F.length("text")).alias("n")).where("n > 1000").count() == 0


def test_shards_of_documents_with_a_shard_column(spark, tmp_path):
    docs = frame(spark, [(k, "x" * k) for k in range(60)]).withColumn("Shard", F.col("doc_id") % 2)
    column = sharding.write_shards(docs, str(tmp_path / "shards"), 500)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert column == "shard_" and back.columns == ["doc_id", "text", "Shard", "shard_"]
    assert back.where("Shard = doc_id % 2").count() == 60
    assert back.groupBy(column).agg(F.sum(F.length("text")).alias("n")).where("n > 500").count() == 0


def test_licence_bounds(spark):
    rows = [
        (1, "x\nLicensed under CC BY-NC 4.0.\ny"), (2, "licensed UNDER the mit license"), (3, None), (4, ""),
        (5, "Released under the MIT License. " * 300), (9, "Released * * * * * * under the" + " *" * 400 + " MIT License"), (6, "All rights reserved. ©"), (7, "all"), (8, "Licensed under CC BY 3.0"),
    ]
    found = licences.licence_notices(frame(spark, rows)).collect()
    assert {(r.doc_id, r.line, r.licence, round(r.dice, 9)) for r in found} == brute.dice_matches(
        rows, licences.TEMPLATES, licences.DICE
    )


def test_licence_plan_is_native(spark, capsys):
    docs = spark.sql("SELECT id AS doc_id, concat('line', id) AS text FROM range(9)")
    licences.licence_notices(docs).explain("formatted")
    plan = capsys.readouterr().out
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "NestedLoop", "Cartesian"))


def test_leaks_equal_brute_force(spark):
    rnd = random.Random(9)
    items = [(k, prose(rnd, rnd.choice([1, 3, 6, 14, 30, 59]), 3000)) for k in range(40)]
    rows = []
    for k in range(150):
        words = items[k % 40][1].split()
        for _ in range(rnd.randint(0, 1 + len(words) // 15)):
            words[rnd.randrange(len(words))] = "CHANGED"
        rows.append((k, f"{prose(rnd, rnd.randint(0, 80))} {' '.join(words).upper()} {prose(rnd, 9)}"))
    found = contamination.benchmark_leaks(frame(spark, rows), spark.createDataFrame(items, "item_id bigint, text string"))
    assert {(r.doc_id, r.item_id) for r in found.collect()} == brute.leaks(rows, items)


def test_hamming_index_returns_all_within_radius():
    rnd = np.random.default_rng(6)
    prints = rnd.integers(0, 2, (60, contamination.BITS)).astype(np.uint8)
    index = contamination.HammingIndex(prints)
    queries = prints[rnd.integers(0, 60, 200)].copy()
    for q in queries:
        q[rnd.choice(contamination.BITS, rnd.integers(0, 70), replace=False)] ^= 1
    for q, found in zip(queries, index.within(queries), strict=True):
        assert found.tolist() == np.flatnonzero((prints != q).sum(1) <= contamination.RADIUS).tolist()


def test_quality_learns_from_positives_and_unlabelled():
    rnd = np.random.default_rng(8)
    good, bad = rnd.normal(0, 1, (2000, 4)), rnd.normal(0, 1, (300, 4)) + [3, 0, 0, 0]
    model = quality.fit_nnpu(good[:1000].astype(np.float32), np.concatenate([good[1000:], bad[:150]]).astype(np.float32), 0.87)
    assert model.scores(good[:500]).mean() > 0.8 > 0.4 > model.scores(bad[150:]).mean()


def test_quality_without_positives(spark):
    docs = frame(spark, [(1, "a"), (2, None)])
    empty = spark.createDataFrame([], "doc_id bigint, quality int")
    assert [r.score for r in quality.classify_quality(docs, empty).collect()] == [0.5, 0.5]


def test_stages_on_odd_rows(spark, tmp_path, odd_rows):
    docs = clashing(spark, odd_rows)
    labels_of(docs).write.parquet(str(tmp_path / "labels.parquet"))
    items_of(docs).write.parquet(str(tmp_path / "benchmark.parquet"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        columns = docs.columns
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == columns
    assert docs.count() > 0
    none = clashing(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        none = stage(spark, none, str(tmp_path))
        assert none.count() == 0
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0


def test_prior_from_positives_and_unlabelled():
    rng = np.random.default_rng(4)
    for share in (0.6, 0.85, 0.97):
        def rows(n, good):
            return np.column_stack([rng.normal(0 if good else 4, 1, n) for _ in range(3)]).astype(np.float32)

        n = 6000
        unlabelled = np.concatenate([rows(int(n * share), True), rows(n - int(n * share), False)])
        rng.shuffle(unlabelled)
        edges = np.quantile(unlabelled, np.linspace(0, 1, 25)[1:-1], axis=0).T.astype(np.float32)
        assert abs(quality.estimate_prior(rows(3000, True), unlabelled, edges) - share) < 0.04


def test_sample_is_bounded_whatever_the_ids(spark):
    """A third of the rows without an id, a third with the same one, half of these alike in all."""
    rows = spark.sql(
        "SELECT if(id % 3 = 0, null, if(id % 3 = 1, 7, id)) AS doc_id,"
        " array(cast(if(id % 2 = 0, 1, id) AS float)) AS measures FROM range(30000)"
    )
    taken = quality._sample(rows, 30_000, 1000)
    assert 300 < len(taken) <= 2000
    again = quality._sample(rows.repartition(7), 30_000, 1000)
    assert len(taken) == 2000 or sorted(taken[:, 0]) == sorted(again[:, 0])
