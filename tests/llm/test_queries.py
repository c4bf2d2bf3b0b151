"""The registered queries over the small driver tables, against SQL or brute force."""

import sys
import zlib
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import brute
from compare import connect, differences

import corpus_pipeline
from tallybook.llm import licences
from tallybook.llm.queries import ORACLE_SQL, QUERIES, tokenizer_path

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.fixture(scope="module")
def documents(con):
    return con.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()


@pytest.fixture(scope="module")
def benchmark(con):
    return con.execute("SELECT item_id, text FROM benchmark ORDER BY item_id").fetchall()


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_query_equals_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF_DIR), con, ORACLE_SQL[name]) == []


def check_packing(rows, documents, size=4096):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    assert set(by_doc) == {d for d, _ in documents}
    for doc_id, text in documents:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        pieces = sorted(by_doc[doc_id], key=lambda r: r.piece)
        assert [(p.piece, p.start) for p in pieces] == [(k, k * size) for k in range(len(pieces))]
        assert sum(p.length for p in pieces) == len(ids)
        for p in pieces:
            cut = np.array(ids[p.start : p.start + p.length], "<u4").tobytes()
            assert p.ids_crc32 == zlib.crc32(cut)
            assert p.length == size or p.piece == len(pieces) - 1
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    total = sum(r.length for r in rows)
    assert len(sequences) <= -(-total // size) * 1.03 + 2


def test_packing(spark, documents):
    check_packing(QUERIES["op1_best_fit_packing"](spark, SF_DIR).collect(), documents)


def test_quality_on_held_out_rows(spark, con, documents):
    rows = {r.doc_id: r for r in QUERIES["op2_quality_classifier"](spark, SF_DIR).collect()}
    assert set(rows) == {d for d, _ in documents}
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in rows.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows.values())
    labels = con.execute("SELECT doc_id, quality FROM labels").fetchall()
    good = [rows[d].score for d, q in labels if q == 1]
    bad = [rows[d].score for d, q in labels if q == 0]
    assert np.mean([[g > b for b in bad] for g in good]) > 0.95


def test_quality_reads_no_negative_labels(spark):
    """Trusted positives alone give the same scores, and held-out junk is still rejected."""
    from tallybook.llm.quality import classify_quality

    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    scored = [
        {r.doc_id: r for r in classify_quality(docs, x).collect()} for x in (labels, labels.where("quality = 1"))
    ]
    assert {d: r.score for d, r in scored[0].items()} == {d: r.score for d, r in scored[1].items()}
    held = [(scored[1][r.doc_id], r.quality) for r in labels.collect() if scored[1][r.doc_id].held_out]
    junk, good = ([r.predicted for r, q in held if q == x] for x in (0, 1))
    assert len(junk) >= 10 and sum(junk) <= 2
    assert sum(good) >= 0.98 * len(good)


def test_personal_data(spark, documents):
    import hashlib

    rows = {r.doc_id: r for r in QUERIES["op4_personal_data"](spark, SF_DIR).collect()}
    for doc_id, text in documents:
        base = brute.base_spans(text)
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        row = rows[doc_id]
        assert row.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        for kind in brute.PATTERNS:
            assert row[f"n_{kind}"] == sum(k == kind for k, _, _ in base)
        assert set(filter(None, joined.split(","))) <= set(row.spans.split(","))


def test_suffix_passages(spark, documents):
    rows = {r.doc_id: r for r in QUERIES["op3_suffix_dedup"](spark, SF_DIR).collect()}
    long, body = brute.repeated(documents, 50), brute.repeated(documents, 35)
    for doc_id, _ in documents:
        spans = rows[doc_id].spans.split(",") if doc_id in rows else []
        covered = set()
        for span in spans:
            a, b = map(int, span.split(":"))
            assert b - a >= 50
            covered.update(range(a, b))
        assert long[doc_id] <= covered
        assert covered <= body[doc_id]


def test_shards_fit(spark, documents):
    from tallybook.llm.sharding import extendible_shards

    frame = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for limit in (5_000, 60_000, 1 << 30):
        rows = extendible_shards(frame, limit).collect()
        assert sorted(r.doc_id for r in rows) == [d for d, _ in documents]
        shards = {}
        for r in rows:
            shards.setdefault((r.bits, r.prefix, r.page), []).append(r.bytes)
        assert all(sum(x) <= limit or len(x) == 1 for x in shards.values())
        leaves = {(bits, prefix) for bits, prefix, _ in shards}
        for bits, prefix in leaves:  # no bucket lies within another
            assert not any((k, prefix >> (bits - k)) in leaves for k in range(bits))


def test_leaks(spark, documents, benchmark):
    rows = QUERIES["op9_decontamination"](spark, SF_DIR).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == brute.leaks(documents, benchmark)


def test_licences(spark, documents):
    rows = QUERIES["op10_licence_scan"](spark, SF_DIR).collect()
    found = {(r.doc_id, r.line, r.licence, round(r.dice, 9)) for r in rows}
    assert len(rows) == len(found) > 0
    assert found == brute.dice_matches(documents, licences.TEMPLATES, licences.DICE)


def test_pipeline_stages(spark, documents, benchmark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "exact", "similar", "decontaminated", "packed"]

    def pairs(frame):
        assert frame.columns == columns
        return [(r.doc_id, r.text) for r in frame.select("doc_id", "text").orderBy("doc_id").collect()]

    scored = QUERIES["op2_quality_classifier"](spark, SF_DIR).where("predicted = 1")
    out = stages["quality"](spark, docs, SF_DIR)
    left = pairs(out)
    assert [d for d, _ in left] == sorted(r.doc_id for r in scored.collect())
    out = stages["exact"](spark, out, SF_DIR)
    kept = sorted(r[0] for r in brute.exact(left) if r[3])
    left = pairs(out)
    assert [d for d, _ in left] == kept
    out = stages["similar"](spark, out, SF_DIR)
    kept = sorted(d for d, (_, c) in brute.components(left).items() if c == d)
    left = pairs(out)
    assert [d for d, _ in left] == kept
    out = stages["decontaminated"](spark, out, SF_DIR)
    bad = {d for d, _ in brute.leaks(left, benchmark)}
    assert bad
    left = [(d, t) for d, t in left if d not in bad]
    assert pairs(out) == left
    check_packing(stages["packed"](spark, out, SF_DIR).collect(), left)
    check_packing(corpus_pipeline.run(spark, SF_DIR).collect(), left)
