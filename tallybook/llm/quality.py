"""Quality classifier learned from trusted positives and unlabelled web text.

Non-negative positive-unlabelled learning (Kiryo et al., 2017): with class prior p, positives P
and unlabelled rows U, minimise

    p * loss(P, +1) + max(0, loss(U, -1) - p * loss(P, -1))

The second term estimates the risk on the unseen negatives; below zero it says that the model
overfits, so the step then goes up instead of down. The prior comes from P and U alone: a first model
is fitted to one half of the sample, and on the other the share of U above a score, divided by that
of P, is an upper bound of the prior for every score; the best of them counts. Negative labels are never
read. The model is additive: each text measure is cut into bins at its quantiles over all rows, and each
bin has a weight. Measures are taken over the whole text, once, and stored; the fit sees a bounded
sample of them, scoring sees all.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.llm.frames import keep_documents, stored
from tallybook.llm.words import parts, window_hashes, word_hashes

#: Rows, about, that the fit takes of the positives; of the unlabelled rows it takes twice as many, since
#: the rare negatives are among them.
SAMPLE_ROWS = 8_000
#: A document with a lower score is rejected.
THRESHOLD = 0.3
_BINS = 24
_UPPER, _LOWER, _DIGIT = slice(65, 91), slice(97, 123), slice(48, 58)


def text_measures(text: bytes) -> list[float]:
    """Measures of one whole UTF-8 text; zeros where it is empty."""
    n = max(1, len(text))
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    words = text.split()
    m = max(1, len(words))
    tally = Counter(words)
    top = tally.most_common(3)
    lines = [x for x in text.split(b"\n") if x.strip()]
    hashes = word_hashes(words)
    triples, eights = window_hashes(hashes, 3), window_hashes(hashes, 8)
    letters = counts[_UPPER].sum() + counts[_LOWER].sum() + counts[128:].sum()
    marks = counts[33:48].sum() + counts[58:65].sum() + counts[91:97].sum() + counts[123:127].sum()
    shares = counts[counts > 0] / n
    return [
        np.log1p(len(text)),
        np.log1p(len(words)),
        len(text) / m,
        len(tally) / m,
        (top[0][1] if top else 0) / m,
        sum(c for _, c in top) / m,
        float(np.mean(hashes[1:] == hashes[:-1])) if len(words) > 1 else 0.0,
        len(np.unique(triples)) / max(1, len(triples)),
        len(np.unique(eights)) / max(1, len(eights)),
        len(set(lines)) / max(1, len(lines)),
        np.log1p(len(lines)),
        len(words) / max(1, len(lines)),
        letters / n,
        counts[_UPPER].sum() / max(1, letters),
        counts[128:].sum() / n,
        counts[_DIGIT].sum() / n,
        marks / n,
        (counts[44] + counts[46]) / n,
        counts[33] / n,
        counts[124] / n,
        (marks - counts[44] - counts[46] - counts[33] - counts[124]) / n,
        counts[:32].sum() / n,
        float(-(shares * np.log(shares)).sum()),
        len(zlib.compress(text, 1)) / n if text else 0.0,
    ]


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, texts in parts(batches):
        rows = np.array([text_measures(t) for t in texts], np.float32)
        values = pa.array(rows.ravel(), pa.float32())
        ends = pa.array(np.arange(len(texts) + 1, dtype=np.int32) * rows.shape[1])
        column = pa.ListArray.from_arrays(ends, values)
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), column], ["doc_id", "measures"])


def document_measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and measures of every row; null text counts as empty."""
    slim = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return slim.mapInArrow(_measure, "doc_id bigint, measures array<float>")


@dataclass
class AdditiveModel:
    edges: np.ndarray  # measures x inner bin edges
    weights: np.ndarray  # measures x bins
    bias: float

    def bins(self, rows: np.ndarray) -> np.ndarray:
        columns = [np.searchsorted(e, rows[:, k], "right") for k, e in enumerate(self.edges)]
        return np.stack(columns, 1)

    def scores(self, rows: np.ndarray) -> np.ndarray:
        bins = self.bins(np.nan_to_num(rows))
        total = self.bias + self.weights[np.arange(bins.shape[1]), bins].sum(1)
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def fit_nnpu(
    positive: np.ndarray,
    unlabelled: np.ndarray,
    prior: float,
    edges: np.ndarray | None = None,
    steps: int = 1000,
    rate: float = 0.1,
    decay: float = 1e-4,
) -> AdditiveModel:
    """Full-batch Adam on the non-negative risk with the sigmoid loss; steps shrink to nothing.

    The loss is bounded, so the estimated risk on negatives has little noise. ``edges`` has the inner
    bin edges of each measure; without it they are quantiles of the rows given.
    """
    if edges is None:
        marks = np.linspace(0, 1, _BINS + 1)[1:-1]
        edges = np.quantile(np.concatenate([positive, unlabelled]), marks, axis=0).T.astype(np.float32)
    count, bins_each = positive.shape[1], edges.shape[1] + 1
    model = AdditiveModel(edges, np.zeros((count, bins_each)), 0.0)
    width = count * bins_each
    offset = np.arange(count) * bins_each
    bins = [model.bins(np.nan_to_num(x)) + offset for x in (positive, unlabelled)]
    w = np.zeros(width + 1)
    w[-1] = np.log(prior / (1 - prior))
    first, second = np.zeros_like(w), np.zeros_like(w)

    def gradient(which: int, slope: np.ndarray) -> np.ndarray:
        rows = bins[which]
        g = np.bincount(rows.ravel(), np.repeat(slope, rows.shape[1]), width) / len(rows)
        return np.append(g, slope.mean())

    for step in range(1, steps + 1):
        f_p, f_u = (w[:-1][b].sum(1) + w[-1] for b in bins)
        s_p, s_u = 1 / (1 + np.exp(-f_p)), 1 / (1 + np.exp(-f_u))
        d_p, d_u = s_p * (1 - s_p), s_u * (1 - s_u)
        negative = s_u.mean() - prior * s_p.mean()
        rest = gradient(1, d_u) - prior * gradient(0, d_p)
        g = rest - prior * gradient(0, d_p) if negative >= 0 else -rest
        g[:-1] += decay * w[:-1]
        first = 0.9 * first + 0.1 * g
        second = 0.999 * second + 0.001 * g * g
        w -= rate * (1 - (step - 1) / steps) * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    model.weights, model.bias = w[:-1].reshape(-1, bins_each), float(w[-1])
    return model


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, edges: np.ndarray) -> float:
    """Share of positives among unlabelled rows, from these two samples alone.

    For any score, P(score or more | U) >= prior * P(score or more | P), with equality where no negative
    lies above. A model fitted to every other row ranks the rest, and the lowest upper confidence bound
    (one standard error) of the ratio gives the estimate, as in best-bin estimation (Garg et al.,
    2021). Only scores that nine in ten positives reach count, so trusted positives need not be like the
    others in all else. A second model, fitted with that estimate, ranks better. Both halves take their turn.
    """
    found = []
    for fold in (0, 1):
        prior = 0.5
        held = [x[1 - fold :: 2] if len(x) > 1 else x for x in (positive, unlabelled)]
        for _ in range(2):
            model = fit_nnpu(positive[fold::2], unlabelled[fold::2], prior, edges, steps=250)
            ranks = [np.sort(model.scores(x)) for x in held]
            cuts = np.unique(ranks[0])
            p, u = (1 - np.searchsorted(r, cuts, "left") / len(r) for r in ranks)
            wide = (p >= 0.9) & (u > 0)
            if not wide.any():
                return 0.5
            p, u = p[wide], u[wide]
            ratio = u / p
            error = ratio * np.sqrt((1 - p) / (p * len(ranks[0])) + (1 - u) / (u * len(ranks[1])))
            prior = float(np.clip(ratio[np.argmin(ratio + error)], 0.01, 0.99))
        found.append(prior)
    return float(np.mean(found))


def _sample(rows: DataFrame, count: int, wanted: int) -> np.ndarray:
    """About ``wanted`` rows of ``count``, by a hash of id and measures; the same on every run.

    Rows alike in both share their fate, and no more than twice ``wanted`` reach the driver.
    """
    share = min(1.0, wanted / max(1, count))
    place = F.pmod(F.xxhash64("doc_id", "measures", F.lit("sample")), F.lit(1 << 30))
    picked = rows.where(place < int(share * (1 << 30))).select(place.alias("place"), "measures")
    found = picked.limit(2 * wanted).toPandas().sort_values("place", kind="stable")
    return np.array([np.asarray(x, np.float32) for x in found["measures"]], np.float32)


def _edges(measures: DataFrame, positives: int) -> np.ndarray:
    """Inner bin edges: quantiles of each measure over all rows, a few hundred numbers in all.

    Fewer bins than ``_BINS`` if there are too few positives to weigh so many.
    """
    width = len(text_measures(b""))
    bins = min(_BINS, max(4, math.isqrt(positives)))
    marks = [i / bins for i in range(1, bins)]
    columns = [F.percentile_approx(F.col("measures")[k], marks, 1000) for k in range(width)]
    return np.array([list(r) for r in measures.agg(*columns).first()], np.float32)


def train_quality(
    measures: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, prior: float | None = None
) -> AdditiveModel | None:
    """Model from measures of training rows and labels (doc_id, quality).

    Trusted positives are the rows labelled 1; unlabelled are all training rows, whatever their
    label. Other labels are not read. The prior, if not given, is estimated from these two. None without
    any positive.
    """
    trusted = labels.where("quality = 1").select(F.col("doc_id").alias("label_id")).distinct()
    known = measures.join(trusted, F.col("doc_id") == F.col("label_id"), "left_semi")
    total, trusted_rows = measures.count(), known.count()
    if not trusted_rows:
        return None
    positive = _sample(known, trusted_rows, sample_rows)
    unlabelled = _sample(measures, total, 2 * sample_rows)
    if not len(positive) or not len(unlabelled):
        return None
    edges = _edges(measures, trusted_rows)
    share = estimate_prior(positive, unlabelled, edges) if prior is None else min(max(prior, 0.01), 0.99)
    return fit_nnpu(positive, unlabelled, share, edges)


def score_quality(measures: DataFrame, model: AdditiveModel | None) -> DataFrame:
    """doc_id and score of every row; 0.5 without a model."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array(batch.column("measures").to_pylist(), np.float32)
            scores = model.scores(rows) if len(rows) else np.empty(0)
            arrays = [batch.column("doc_id"), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "score"])

    if model is None:
        return measures.select("doc_id", F.lit(0.5).alias("score"))
    return measures.mapInArrow(run, "doc_id bigint, score double")


def held_out(id_col: Column) -> Column:
    """Whether crc32 of the id as text leaves no rest by five; false for a null id."""
    rest = F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(5))
    return F.coalesce(rest == 0, F.lit(False))


def classify_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted.

    Held-out rows are neither positives nor unlabelled. Null text counts as empty and is
    scored; a null id is never held out and has no label. An id that repeats is scored row by row. Only
    the id and the text are read. Without a positive label every score is 0.5.
    """
    measures = stored(document_measures(docs, id_col, text_col), "measures")
    model = train_quality(measures.where(~held_out(F.col("doc_id"))), labels, sample_rows)
    scored = score_quality(measures, model)
    predicted = F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted)


def keep_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows of ``docs``, all columns, that the classifier does not reject."""
    kept = classify_quality(docs, labels, id_col).where("predicted = 1")
    return keep_documents(docs, kept.select(F.col("doc_id").alias(id_col)).distinct(), id_col)
