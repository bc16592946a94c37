"""Language identification with averaged hashed subword embeddings (operator 9).

A text is the average of the embeddings of its subwords: the 2- to 4-grams of
letters of its words, marked at word ends and hashed to buckets. A linear softmax on
the average gives the language. Embeddings and softmax are trained together by
stochastic gradient descent in numpy on a bounded sample; the probabilities are
calibrated by a temperature, and answers below a calibrated score are rejected.
For scoring, embedding and softmax are multiplied once into a table of logits a
bucket, so a text costs one lookup a subword.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .toxicity import held_out

UNKNOWN = "und"
ORDERS, BITS, DIMENSIONS = (2, 3, 4), 16, 16
#: Documents of each language that the model is fitted on; share of them kept for calibration.
SAMPLE_ROWS, CALIBRATION = 300, 0.2
#: Subwords of a training example, examples of a step, passes, learning rate.
EXAMPLE, BATCH, EPOCHS, RATE = 200, 64, 3, 20.0
#: Share of right answers wanted among the accepted ones.
PRECISION = 0.99
PIECE = 1 << 20


class Letters:
    """Which code points are letters, looked up once each."""

    def __init__(self):
        self.known = np.full(0x110000, -1, np.int8)

    def __call__(self, codes: np.ndarray) -> np.ndarray:
        new = np.unique(codes[self.known[codes] < 0])
        self.known[new] = [chr(c).isalpha() for c in new.tolist()]
        return self.known[codes] == 1


def subwords(text: str | None, letters: Letters) -> Iterator[np.ndarray]:
    """Buckets of all subwords of the whole text, in portions of bounded size; nothing for a text without letters."""
    codes = np.frombuffer(f" {text or ''} ".lower().encode("utf-32-le"), "<u4")
    for at in range(0, len(codes) - 1, PIECE):
        piece = codes[at:at + PIECE + max(ORDERS) - 1]
        letter = letters(piece)
        if not letter.any():
            continue
        # everything between words is the same mark, and no subword reaches across it
        h, inner = np.where(letter, piece, 0).astype(np.uint64), None
        base = h
        for order in range(2, max(ORDERS) + 1):
            h = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + base[order - 1:]
            n = len(h)
            inner = letter[:n] | letter[1:] if order == 2 else _all_between(letter, order, n)
            if order in ORDERS:
                yield ((((h ^ np.uint64(order)) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - BITS))[inner]).astype(np.int32)


def _all_between(letter: np.ndarray, order: int, n: int) -> np.ndarray:
    out = letter[1:1 + n]
    for k in range(2, order - 1):
        out = out & letter[k:k + n]
    return out


@dataclass(frozen=True)
class Model:
    languages: list[str]
    table: np.ndarray  # logits a bucket
    bias: np.ndarray
    temperature: float
    accept: float  # scores below are rejected

    def probabilities(self, text: str | None, letters: Letters) -> np.ndarray | None:
        total, n = np.zeros(len(self.languages)), 0
        for found in subwords(text, letters):
            total += self.table[found].sum(axis=0, dtype=np.float64)
            n += len(found)
        return _softmax((total / n + self.bias) / self.temperature) if n and self.languages else None


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(rows: list[np.ndarray], labels: list[str], seed: int = 5) -> Model:
    """Train on texts given as subword buckets; rows without subwords are left aside."""
    used = [i for i, r in enumerate(rows) if len(r)]
    languages = sorted({labels[i] for i in used})
    if not languages:
        return Model([], np.zeros((1 << BITS, 0), np.float32), np.zeros(0), 1.0, 1.0)
    rng = np.random.default_rng(seed)
    rng.shuffle(used)
    n_test = int(len(used) * CALIBRATION)
    test, train = used[:n_test], used[n_test:]
    number = {name: k for k, name in enumerate(languages)}
    examples = [(part, number[labels[i]]) for i in train for part in np.split(rows[i], range(EXAMPLE, len(rows[i]), EXAMPLE))]
    share = np.bincount([y for _, y in examples], minlength=len(languages)) / len(examples)
    weight = 1 / np.maximum(share, 1e-9) / len(languages)  # languages with more text do not count more
    embedding = rng.normal(0, 0.1, (1 << BITS, DIMENSIONS))
    linear, bias = rng.normal(0, 0.1, (DIMENSIONS, len(languages))), np.zeros(len(languages))
    steps, done = EPOCHS * -(-len(examples) // BATCH), 0
    for _ in range(EPOCHS):
        for part in np.array_split(rng.permutation(len(examples)), -(-len(examples) // BATCH)):
            rate, done = RATE * (1 - done / steps), done + 1
            ids = np.concatenate([examples[k][0] for k in part])
            sizes = np.array([len(examples[k][0]) for k in part])
            y = np.array([examples[k][1] for k in part])
            starts = np.cumsum(sizes) - sizes
            hidden = np.add.reduceat(embedding[ids], starts, axis=0) / sizes[:, None]
            error = _softmax(hidden @ linear + bias)
            error[np.arange(len(part)), y] -= 1
            error *= (weight[y] / len(part))[:, None]
            back = (error @ linear.T) / sizes[:, None]
            linear -= 0.05 * rate * (hidden.T @ error)
            bias -= 0.05 * rate * error.sum(axis=0)
            np.add.at(embedding, ids, -rate * np.repeat(back, sizes, axis=0))
    table = (embedding @ linear).astype(np.float32)
    return _calibrated(Model(languages, table, bias, 1.0, 0.0), [rows[i] for i in test], [number[labels[i]] for i in test])


def _calibrated(model: Model, rows: list[np.ndarray], y: list[int]) -> Model:
    """Temperature of the least log loss on unseen texts, and the lowest score that keeps the wanted precision."""
    if not rows:
        return model
    logits = np.array([model.table[r].mean(axis=0) for r in rows]) + model.bias
    y = np.array(y)

    def loss(t: float) -> float:
        return -np.log(np.maximum(_softmax(logits / t)[np.arange(len(y)), y], 1e-12)).mean()

    temperature = float(min(np.geomspace(0.05, 20, 60), key=loss))
    p = _softmax(logits / temperature)
    score, right = p.max(axis=1), p.argmax(axis=1) == y
    order = np.argsort(-score, kind="stable")
    precise = np.flatnonzero(np.cumsum(right[order]) / np.arange(1, len(y) + 1) >= PRECISION)
    accept = float(score[order][precise[-1]]) if len(precise) else 1.0
    return Model(model.languages, model.table, model.bias, temperature, accept)


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Model from documents with a language that are not held out, ``sample_rows`` of each by the smallest hash of the id.

    Null texts and null ids are left aside. The sample is bounded by the number of
    languages; its window keeps no more than ``sample_rows`` a language and task before the shuffle.
    """
    known = docs.where("doc_id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL").where(~held_out()).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"))
    by_hash = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = known.withColumn("n", F.row_number().over(by_hash)).where(F.col("n") <= sample_rows).select("doc_id").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = Letters()
        for batch in batches:
            rows = [b"".join(x.tobytes() for x in subwords(t.as_py(), letters)) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], ["lang", "subwords"])

    sample = docs.where("lang IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
        F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id").select("lang", "text")
    rows = sample.mapInArrow(run, "lang string, subwords binary").toArrow()
    return fit([np.frombuffer(x, np.int32) for x in rows.column("subwords").to_pylist()], rows.column("lang").to_pylist())


def identified(docs: DataFrame, model: Model) -> DataFrame:
    """(row, lang_pred, score, accepted), one per row of ``docs``; ``row`` holds the columns other than the text.

    A null text, one without letters, or a model without languages gives ``und`` with
    score 0, not accepted. Any other text gets the likeliest learned language, its
    calibrated probability, and whether that reaches the rejection threshold.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = Letters()
        for batch in batches:
            names, scores = [], []
            for text in batch.column("text"):
                p = model.probabilities(text.as_py(), letters)
                names.append(UNKNOWN if p is None else model.languages[int(p.argmax())])
                scores.append(0.0 if p is None else float(p.max()))
            accepted = [s >= model.accept and s > 0 for s in scores]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(accepted, pa.bool_())],
                ["row", "lang_pred", "score", "accepted"])

    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row"), F.col("text").cast("string").alias("text"))
    return packed.mapInArrow(
        run, f"row {packed.schema['row'].dataType.simpleString()}, lang_pred string, score double, accepted boolean")
