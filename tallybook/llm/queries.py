"""The thin queries over the driver tables and the SQL they must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.llm.collocations import collocations
from tallybook.llm.contamination import benchmark_leaks
from tallybook.llm.exact import exact_duplicates
from tallybook.llm.fingerprints import edited_sketches, resemblance, sketch_text
from tallybook.llm.frames import read_table
from tallybook.llm.licences import licence_notices
from tallybook.llm.packing import pack_pieces, token_pieces
from tallybook.llm.passages import remove_repeated_windows
from tallybook.llm.personal import BASE_KINDS, personal_spans
from tallybook.llm.quality import classify_quality
from tallybook.llm.ranked import ranked_search
from tallybook.llm.setjoin import similar_documents
from tallybook.llm.sharding import extendible_shards
from tallybook.llm.suffixes import repeated_passages


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = token_pieces(read_table(spark, sf_dir, "documents"), tokenizer_path())
    digests = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return pack_pieces(digests)


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = (read_table(spark, sf_dir, t) for t in ("documents", "labels"))
    return classify_quality(documents, labels)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_passages(read_table(spark, sf_dir, "documents"))
    spans = F.transform("intervals", lambda x: F.concat_ws(":", x["start"], x["end"]))
    return found.select("doc_id", "n_words", F.array_join(spans, ",").alias("spans"))


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_spans(read_table(spark, sf_dir, "documents"))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")

    def count(kind: str):
        hits = F.filter("spans", lambda s: s.kind == kind)
        return F.size(hits).cast("bigint").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s.kind.isin(*BASE_KINDS))
    return found.select(
        "doc_id",
        *[count(kind) for kind in BASE_KINDS],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined("spans").alias("spans"),
    )


def op5_extendible_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extendible_shards(read_table(spark, sf_dir, "documents"))
    return found.withColumn("shard_id", F.concat_ws("-", "bits", "prefix", "page"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_duplicates(read_table(spark, sf_dir, "documents"))
    return found.withColumn("text_sha256", F.lower(F.hex("digest"))).drop("digest")


OP6_SQL = """
WITH t AS (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
    FROM documents
), g AS (
    SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
FROM t JOIN g USING (norm)
"""

def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeated_windows(read_table(spark, sf_dir, "documents"))
    removed = F.aggregate("intervals", F.lit(0).cast("bigint"), lambda n, x: n + x.end - x.start)
    return found.select(
        "doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256")
    )


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP7_SQL = f"""
WITH w AS (
    SELECT doc_id, {_WORDS} AS ws FROM documents
), win AS (
    SELECT doc_id, i, array_to_string(ws[i : i + 12], ' ') AS seq
    FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w WHERE len(ws) >= 13)
), least AS (
    SELECT seq, min(doc_id) AS least_id FROM win GROUP BY seq
), covered AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS pos
    FROM win JOIN least USING (seq) WHERE least_id < doc_id
), word AS (
    SELECT doc_id, unnest(range(1, len(ws) + 1)) AS pos, unnest(ws) AS word FROM w
), kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS text, count(*) AS n
    FROM word ANTI JOIN covered USING (doc_id, pos) GROUP BY doc_id
)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""


def op8_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(read_table(spark, sf_dir, "documents"))


OP8_SQL = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS ws
    FROM documents
), sets AS (
    SELECT DISTINCT doc_id, array_to_string(ws[i : i + 4], ' ') AS shingle
    FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM w WHERE len(ws) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id
), linked AS (
    SELECT a.doc_id AS u, b.doc_id AS v
    FROM (SELECT x.doc_id AS u, y.doc_id AS v, count(*) AS common
          FROM sets x JOIN sets y ON x.shingle = y.shingle AND x.doc_id != y.doc_id GROUP BY 1, 2) p
    JOIN sizes a ON a.doc_id = p.u JOIN sizes b ON b.doc_id = p.v
    WHERE 100 * common >= 75 * (a.n + b.n - common)
), reach AS (
    SELECT doc_id AS node, doc_id AS other FROM w
    UNION
    SELECT node, v FROM reach JOIN linked ON other = u
)
SELECT w.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least_id AS component_id
FROM w LEFT JOIN sizes USING (doc_id)
JOIN (SELECT node AS doc_id, min(other) AS least_id FROM reach GROUP BY node) USING (doc_id)
"""

def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = (read_table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    return benchmark_leaks(documents, benchmark)


def op10_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licence_notices(read_table(spark, sf_dir, "documents"))


def op11_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = edited_sketches(read_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        sketch_text(F.col("sketch")).alias("fingerprint"),
        sketch_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = (read_table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    return ranked_search(documents, benchmark)


_TERMS = (
    r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    r" '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)

OP12_SQL = f"""
WITH d AS (
    SELECT doc_id, {_TERMS} AS ts FROM documents
), s AS (
    SELECT count(*) AS nn, sum(len(ts))::BIGINT AS ll FROM d WHERE len(ts) > 0
), p AS (
    SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(ts) AS term FROM d) GROUP BY doc_id, term
), w AS (
    SELECT term, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
    FROM (SELECT term, count(*) AS df FROM p GROUP BY term), s
), m AS (
    SELECT doc_id, 10 + (90 * len(ts)::HUGEINT * nn) // ll AS m FROM d, s WHERE len(ts) > 0
), q AS (
    SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark
), scored AS (
    SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
    FROM q JOIN w USING (term) JOIN p USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank
    FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collocations(read_table(spark, sf_dir, "documents"))
    return found.withColumn("rank", F.col("rank").cast("bigint"))


OP13_SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), w AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces
), occurrences AS (
    SELECT lang, length, array_to_string(ws[i : i + length - 1], ' ') AS phrase
    FROM (SELECT lang, ws, length, unnest(range(1, len(ws) - length + 2)) AS i
          FROM w, (SELECT unnest([1, 2, 3]) AS length) WHERE len(ws) >= length)
), f AS (
    SELECT lang, length, phrase, count(*) AS total FROM occurrences GROUP BY lang, length, phrase
), sizes AS (
    SELECT lang, sum(total)::BIGINT AS n FROM f WHERE length = 1 GROUP BY lang
), candidates AS (
    SELECT lang, length, phrase, total AS a, string_split(phrase, ' ') AS ws FROM f WHERE length > 1 AND total >= 10
), cuts AS (
    SELECT lang, phrase, a, k, array_to_string(ws[1 : k], ' ') AS left_part, array_to_string(ws[k + 1 :], ' ') AS right_part
    FROM (SELECT *, unnest(range(1, length)) AS k FROM candidates)
), scores AS (
    SELECT c.lang, c.phrase, a, k, x.total AS l, y.total AS r,
           ((1000000::HUGEINT * a * a) // (x.total::HUGEINT * y.total))::BIGINT AS score
    FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = left_part JOIN f y ON y.lang = c.lang AND y.phrase = right_part
), lowest AS (
    SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), absorbed AS (
    SELECT DISTINCT s.lang, s.phrase FROM candidates s
    JOIN (SELECT lang, a, array_to_string(ws[i : i + 1], ' ') AS phrase
          FROM (SELECT *, unnest([1, 2]) AS i FROM candidates WHERE length = 3)) b
      ON b.lang = s.lang AND b.phrase = s.phrase WHERE 100 * b.a >= 50 * s.a
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
    FROM lowest ANTI JOIN absorbed USING (lang, phrase)
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_personal_data": op4_personal_data,
    "op5_extendible_shards": op5_extendible_shards,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_shingle_join": op8_shingle_join,
    "op9_decontamination": op9_decontamination,
    "op10_licence_scan": op10_licence_scan,
    "op11_document_fingerprints": op11_document_fingerprints,
    "op12_ranked_search": op12_ranked_search,
    "op13_collocations": op13_collocations,
}

#: SQL that must give the same rows; the rest is tested against brute force or on held-out rows.
ORACLE_SQL: dict[str, str] = {
    "op6_exact_dedup": OP6_SQL,
    "op7_substring_dedup": OP7_SQL,
    "op8_shingle_join": OP8_SQL,
    "op12_ranked_search": OP12_SQL,
    "op13_collocations": OP13_SQL,
}
