"""Toxicity: linear classifier on character n-grams scaled by naive Bayes log-count ratios (operator 2).

A text's features are the distinct character n-grams of its lower-case form, white
space runs as one space, hashed to buckets. Each feature is scaled by
r = log(share of toxic texts with it / share of other texts with it), and a logistic
regression on the scaled features gives the score. Model and ratios are fitted on a
bounded sample of labelled rows; scoring reads every whole text in one map pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import keep

#: Lengths of n-grams, bits of a bucket number, rows of each class that the model is fitted on.
ORDERS, BITS, SAMPLE_ROWS = (4, 6, 8), 20, 1200
#: Bytes of features (four each) that the driver fits on at most, half of them of each class.
SAMPLE_BYTES = 32 << 20
#: Texts of the sample that a feature must occur in, and how far its log-count ratio must be from zero (a factor of two).
LEAST, TELLING = 5, 0.69
ROUNDS, PENALTY, SMOOTHING = 40, 1e-3, 1.0
THRESHOLD = 0.7
#: Features that the fit handles at a time.
BLOCK = 1_000_000
#: Characters that are hashed at a time; longer texts are read in overlapping pieces.
PIECE = 1 << 20


def _ngrams(codes: np.ndarray) -> np.ndarray:
    """Bucket of every n-gram of the code points, repeats included."""
    found, h = [], codes.astype(np.uint64)
    for order in range(2, max(ORDERS) + 1):
        if len(codes) < order:
            break
        h = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + codes[order - 1:]
        if order in ORDERS:
            found.append(((h ^ np.uint64(order)) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - BITS))
    return np.concatenate(found).astype(np.int64) if found else np.zeros(0, np.int64)


def features(text: str | None, place: np.ndarray) -> np.ndarray:
    """Distinct buckets of the whole text; ``place`` is scratch of 2^BITS entries with any content."""
    codes = np.frombuffer(f" {' '.join((text or '').lower().split())} ".encode("utf-32-le"), "<u4").astype(np.uint64)
    out = np.zeros(0, np.int64)
    for at in range(0, len(codes), PIECE):
        found = np.concatenate([out, _ngrams(codes[at:at + PIECE + max(ORDERS) - 1])])
        order = np.arange(len(found))
        place[found] = order  # the last of equal buckets stays
        out = found[place[found] == order]
    return out


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float

    def score(self, found: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.bias + self.weights[found].sum(), -30, 30))))


def fit(rows: list[np.ndarray], toxic: np.ndarray) -> Model:
    """Model of the features of each row and its label; see ``fit_rows``."""
    return fit_rows(np.concatenate([np.zeros(0, np.int32), *rows]).astype(np.int32), np.array([len(r) for r in rows], np.int64), toxic)


def _by_feature(ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of each feature one after another, the features, and where the rows of each begin.

    (feature, row) is sorted as one number in place, and all else is done some at a time: the
    driver holds twelve bytes a feature beside ``ids`` at most.
    """
    n = len(lengths)
    keys, counts = np.repeat(np.arange(n), lengths), np.zeros(1 << BITS, np.int64)
    rows = np.empty(len(ids), np.min_scalar_type(n))
    for at in range(0, len(ids), BLOCK):
        counts += np.bincount(ids[at:at + BLOCK], minlength=len(counts))
        keys[at:at + BLOCK] += ids[at:at + BLOCK].astype(np.int64) * n
    keys.sort()
    for at in range(0, len(ids), BLOCK):
        rows[at:at + BLOCK] = keys[at:at + BLOCK] % n
    known = np.flatnonzero(counts)
    return rows, known, np.cumsum(counts[known]) - counts[known]


def fit_rows(ids: np.ndarray, lengths: np.ndarray, toxic: np.ndarray) -> Model:
    """Ratios and accelerated gradient descent of the penalised logistic loss; ``ids`` are the rows' features one after another.

    With rows of one class only, or none, the score is that class's share (0.0 for no rows) everywhere.
    """
    size, n, toxic = 1 << BITS, len(lengths), np.asarray(toxic, float)
    if not n or toxic.min() == toxic.max():
        return Model(np.zeros(size), 30.0 if n and toxic[0] else -30.0)
    by_feature, known, firsts = _by_feature(ids, lengths)
    some = np.flatnonzero(lengths)
    starts = (np.cumsum(lengths) - lengths)[some]

    def summed(values: np.ndarray, at: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Sums of values[at] over the stretches that begin at ``first``, some at a time."""
        cut = np.unique(np.append(np.searchsorted(first, np.arange(0, len(at), BLOCK)), len(first)))
        ends = np.append(first, len(at))
        return np.concatenate([np.zeros(0), *(
            np.add.reduceat(values[at[ends[x]:ends[y]]], first[x:y] - ends[x]) for x, y in zip(cut, cut[1:]))])

    def spread(values: np.ndarray) -> np.ndarray:
        """Sum of a value of each row at its features."""
        out = np.zeros(size)
        out[known] = summed(values, by_feature, firsts)
        return out

    def gathered(values: np.ndarray) -> np.ndarray:
        """Sum of the values at each row's features."""
        out = np.zeros(n)
        out[some] = summed(values, ids, starts)
        return out

    ratio = log_ratio(spread(toxic), spread(1 - toxic), toxic.sum(), (1 - toxic).sum())
    weight = np.where(toxic > 0, 0.5 / toxic.mean(), 0.5 / (1 - toxic.mean())) / n  # both classes count alike
    # steps are as long as the largest row allows
    step = 4.0 / max(1.0, np.percentile(gathered(ratio ** 2), 95)) * n ** 0.5
    w, bias, ahead_w, ahead_bias = np.zeros(size), 0.0, np.zeros(size), 0.0
    for k in range(ROUNDS):
        margin = gathered(ahead_w * ratio) + ahead_bias
        error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - toxic) * weight
        new_w = ahead_w - step * (PENALTY * ahead_w / n + ratio * spread(error))
        new_bias = ahead_bias - step * error.sum()
        pull = k / (k + 3)
        ahead_w, ahead_bias = new_w + pull * (new_w - w), new_bias + pull * (new_bias - bias)
        w, bias = new_w, new_bias
    return Model(w * ratio, float(bias))


def held_out(id_col: str = "doc_id"):
    """Rows that a model must not learn from: crc32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _sampled():
    """(toxic, text) -> (toxic, features): distinct buckets of each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.zeros(1 << BITS, np.int64)
        for batch in batches:
            for i in range(batch.num_rows):  # a text at a time: long ones have many features
                found = features(batch.column("text")[i].as_py(), place).astype("<i4").tobytes()
                yield pa.RecordBatch.from_arrays([batch.column("toxic").slice(i, 1), pa.array([found], pa.binary())], ["toxic", "features"])

    return run


def _bucket_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros((2, 1 << BITS), np.int32)
    for batch in batches:
        for y, row in zip(batch.column("toxic").to_pylist(), batch.column("features")):
            counts[y, np.frombuffer(row.as_buffer(), "<i4")] += 1
    some = np.flatnonzero(counts.any(axis=0))
    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (some.astype(np.int32), *counts[:, some])], ["bucket", "n0", "n1"])


def log_ratio(toxic: np.ndarray, other: np.ndarray, n_toxic: float, n_other: float) -> np.ndarray:
    """Logarithm of the share of toxic texts with a feature over that of other texts, smoothed."""
    return np.log((toxic + SMOOTHING) / (n_toxic + 2 * SMOOTHING)) - np.log((other + SMOOTHING) / (n_other + 2 * SMOOTHING))


def _only(known: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [np.frombuffer(x.as_buffer(), "<i4") for x in batch.column("features")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.array([x[known[x]].tobytes() for x in rows], pa.binary())], ["toxic", "features"])

    return run


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, sample_bytes: int = SAMPLE_BYTES) -> Model:
    """Model from the labelled documents that are not held out.

    Of each class the ``sample_rows`` ids of the smallest hash are used, whole texts (of a
    repeated id the smallest), as far as their features fit into ``sample_bytes``.
    Features of fewer than ``LEAST`` of these texts are left out, and those of nearly equal
    shares in both classes, whose scale is near zero. Labels other than 0 and 1, null ids and repeated
    ids with both labels are left aside.
    """
    clear = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where("doc_id IS NOT NULL AND toxic IN (0, 1)").where(~held_out())
        .groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most")).where("toxic = most")
    )
    chosen = [
        clear.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows).select("doc_id", "toxic")
        for y in (0, 1)
    ]
    # at most 2 x sample_rows ids: a proven bound
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(
        F.broadcast(chosen[0].union(chosen[1])), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    sample = keep(texts.select("toxic", "text").mapInArrow(_sampled(), "toxic int, features binary"), "sample")
    shared = sample.mapInArrow(_bucket_counts, "bucket int, n0 int, n1 int").groupBy("bucket").agg(
        F.sum("n0").cast("int").alias("n0"), F.sum("n1").cast("int").alias("n1")).where(F.col("n0") + F.col("n1") >= LEAST).toArrow()
    texts_of = dict(sample.groupBy("toxic").count().collect())
    bucket, n0, n1 = (shared.column(c).to_numpy() for c in ("bucket", "n0", "n1"))  # at most 2^BITS
    known = np.zeros(1 << BITS, bool)
    known[bucket[np.abs(log_ratio(n1, n0, texts_of.get(1, 0), texts_of.get(0, 0))) >= TELLING]] = True
    del shared, bucket, n0, n1
    told = keep(sample.mapInArrow(_only(known), "toxic int, features binary").withColumn("draw", F.xxhash64("features")), "shared-features")
    # a row for each text of the sample
    so_far = Window.partitionBy("toxic").orderBy("draw").rowsBetween(Window.unboundedPreceding, 0)
    within = told.select("toxic", "draw", F.octet_length("features").alias("size")).withColumn("bytes", F.sum("size").over(so_far)).where(
        F.col("bytes") <= sample_bytes // 2).groupBy("toxic").agg(F.max("draw").alias("last"))
    rows = told.join(F.broadcast(within), "toxic").where(F.col("draw") <= F.col("last")).select("toxic", "features").toArrow()
    found = [np.frombuffer(x.as_buffer(), "<i4") for x in rows.column("features")]
    lengths, toxic = np.array([len(x) for x in found], np.int64), rows.column("toxic").to_numpy()
    ids = np.concatenate([np.zeros(0, np.int32), *found])
    del found, rows
    return fit_rows(ids, lengths, toxic)


def scored(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the score (0 to 1) of each whole text in ``out``; null and empty texts score as a text without words.

    All columns are kept; one called ``out`` is replaced.
    """
    names = [c for c in docs.columns if c != out]
    weights, bias = model.weights.astype(np.float32), model.bias

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, own = np.zeros(1 << BITS, np.int64), Model(weights, bias)
        for batch in batches:
            scores = [own.score(features(t.as_py(), place)) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(scores, pa.float64())], ["row", "score"])

    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(text_col).cast("string").alias("text"))
    done = packed.mapInArrow(run, f"row {packed.schema['row'].dataType.simpleString()}, score double")
    return done.select("row.*", F.col("score").alias(out))
