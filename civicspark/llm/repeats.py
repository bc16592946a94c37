"""Windows that occur before, for documents of any kind of symbol (bytes, words).

``decided`` and ``open`` runs come from one pass over the texts and one shuffle by
minimizer (see ``runs``). Rows are combined inside a task before the shuffle: of
the runs of one minimizer a task passes on a single row per span, or one marker
where it has seen several spans, so a line shared by a third of all documents
sends a row per task and not one per document.

A document is a row of the input, known by its id (null: the smallest) and a hash
of its text; rows that repeat an id are documents none of which comes first.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import keep
from .runs import runs

#: Symbols that a task hashes at a time (some twenty arrays of 8 bytes each), and runs that it combines at a time.
PIECE, COMBINED = 100_000, 400_000
PROBE, OPEN, DECIDED = 0, 1, 2
FIRST_ID = -(1 << 63)

RUNS = "kind int, key long, span long, doc long, tag int, start long, windows int"
_RUN_TYPES = [("kind", pa.int32()), ("key", pa.int64()), ("span", pa.int64()), ("doc", pa.int64()),
              ("tag", pa.int32()), ("start", pa.int64()), ("windows", pa.int32())]

Symbols = Callable[[str], np.ndarray]


def identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """(doc, tag, text), with all other columns in the struct ``row`` if they are to be carried.

    The smallest number stands for a null id, the empty text for a null one.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    found = [F.coalesce(F.col(id_col).cast("long"), F.lit(FIRST_ID)).alias("doc"), F.hash(text).alias("tag"), text.alias("text")]
    if carry:
        found.append(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("row"))
    return docs.select(*found)


def pieces(texts, symbols_of: Symbols, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Symbols of many texts in portions of bounded size: (symbols, lengths, text numbers, offsets).

    Long texts are cut into pieces that overlap by ``width`` - 1, so each window
    lies in exactly one piece.
    """
    held: list[np.ndarray] = []
    where: list[tuple[int, int]] = []
    size = 0

    def flush():
        return (np.concatenate(held), np.array([len(x) for x in held]),
                np.array([w[0] for w in where]), np.array([w[1] for w in where]))

    for i, text in enumerate(texts):
        symbols = symbols_of(text)
        for offset in range(0, len(symbols) - width + 1, PIECE):
            piece = symbols[offset:offset + PIECE + width - 1]
            held.append(piece)
            where.append((i, offset))
            size += len(piece)
            if size >= PIECE:
                yield flush()
                held, where, size = [], [], 0
    if held:
        yield flush()


def _batch(columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns.pop(name).astype(kind.to_pandas_dtype(), copy=False), kind) for name, kind in _RUN_TYPES],
        schema=pa.schema(_RUN_TYPES))


def combine(rows: dict[str, np.ndarray], within: bool) -> dict[str, np.ndarray]:
    """What a task can decide of its own rows (key, span, doc, tag, start, windows); gives them a ``kind``.

    ``rows`` is emptied: a column is dropped as soon as the next one is made of it.
    """
    order = np.lexsort((rows["start"], rows["tag"], rows["doc"], rows["span"], rows["key"]))
    rows = {k: rows.pop(k)[order] for k in list(rows)}
    del order
    key, span, doc, tag = rows["key"], rows["span"], rows["doc"], rows["tag"]
    new_key = np.ones(len(key), bool)
    new_key[1:] = key[1:] != key[:-1]
    new_span = new_key.copy()
    new_span[1:] |= span[1:] != span[:-1]
    done = doc > doc[np.flatnonzero(new_span)][np.cumsum(new_span) - 1]
    if within:
        new_doc = new_span.copy()
        new_doc[1:] |= (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1])
        done |= rows["start"] > rows["start"][np.flatnonzero(new_doc)][np.cumsum(new_doc) - 1]
    group = np.cumsum(new_key) - 1
    mixed = (np.bincount(group, weights=new_span) > 1)[group]
    kind = np.where(done, DECIDED, np.where(mixed, OPEN, PROBE))
    marks = np.flatnonzero(new_key & mixed)
    del key, span, doc, tag, group, mixed, new_key, new_span, done
    out = {k: np.concatenate([v := rows.pop(k), v[marks]]) for k in list(rows)}
    out["kind"] = np.concatenate([kind, np.full(len(marks), PROBE)])
    out["windows"][len(kind):] = 0
    # decided and open rows need no company: deal them evenly
    settled = out["kind"] != PROBE
    out["key"][settled] = (out["span"] ^ (out["doc"] * 0x9E3779B97F4A7C1 + out["start"]))[settled]
    return out


class Held:
    """Runs of a task, handed out combined in portions of bounded size."""

    def __init__(self, within: bool):
        self.within, self.rows, self.size = within, [], 0

    def add(self, found: dict[str, np.ndarray], doc, tag, text, offset) -> Iterator[pa.RecordBatch]:
        at = found["doc"]
        if len(at):
            self.rows.append({"key": found["minimizer"], "span": found["span"], "doc": doc[text[at]], "tag": tag[text[at]],
                              "start": found["start"] + offset[at], "windows": found["windows"]})
            self.size += len(at)
        if self.size >= COMBINED:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.size:
            rows, self.rows, self.size = self.rows, [], 0
            yield _batch(combine({k: np.concatenate([r.pop(k) for r in rows]) for k in list(rows[0])}, self.within))


def find_runs(docs: DataFrame, symbols_of: Symbols, width: int, gram: int, within: bool) -> DataFrame:
    """Runs of all documents (doc, tag, text) after the combination inside each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Held(within)
        for batch in batches:
            doc, tag = (batch.column(c).to_numpy() for c in ("doc", "tag"))
            texts = (t.as_py() for t in batch.column("text"))
            for symbols, lengths, text, offset in pieces(texts, symbols_of, width):
                yield from held.add(runs(symbols, lengths, width, gram), doc, tag, text, offset)
        yield from held.flush()

    return docs.mapInArrow(run, RUNS)


def decide(rows: DataFrame, within: bool) -> DataFrame:
    """Decided and open rows among all: one shuffle by the key, the rest is dropped."""
    in_span = Window.partitionBy("kind", "key", "span").orderBy("doc", "tag", "start")
    in_key = Window.partitionBy("kind", "key")
    in_doc = Window.partitionBy("kind", "key", "span", "doc", "tag").orderBy("start")
    done = (F.col("kind") == DECIDED) | (F.col("doc") > F.first("doc").over(in_span))
    if within:
        done |= F.col("start") > F.first("start").over(in_doc)
    return (
        rows.withColumn("done", done)
        .withColumn("mixed", (F.min("span").over(in_key) != F.max("span").over(in_key)) | (F.min("windows").over(in_key) == 0))
        .withColumn("kind", F.when(F.col("done"), DECIDED).when(F.col("mixed") | (F.col("kind") == OPEN), OPEN))
        .where("kind IS NOT NULL AND windows > 0")
        .select("kind", "doc", "tag", "start", "windows")
    )


def with_stretches(docs: DataFrame, rows: DataFrame, how: str) -> DataFrame:
    """Documents with the (start, windows) of their rows as arrays ``starts`` and ``counts``, bounded by the text."""
    lists = rows.groupBy("doc", "tag").agg(F.collect_list(F.struct("start", "windows")).alias("at"))
    return docs.join(lists, ["doc", "tag"], how).select(
        *docs.columns, F.col("at.start").alias("starts"), F.col("at.windows").alias("counts"))


def stretches(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and counts of row ``i``, sorted by start; empty where the row has none."""
    starts, counts = batch.column("starts")[i].values, batch.column("counts")[i].values
    if starts is None:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts, counts = starts.to_numpy(), counts.to_numpy().astype(np.int64)
    order = np.argsort(starts, kind="stable")
    return starts[order], counts[order]


def refine(docs: DataFrame, open_runs: DataFrame, symbols_of: Symbols, width: int, gram: int, within: bool) -> DataFrame:
    """The windows of the open runs as runs of a longer gram, combined inside each task.

    The texts are read once more, joined by document. With ``gram`` = ``width`` every
    window is a run of its own, and none stays open.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Held(within)
        for batch in batches:
            doc, tag = (batch.column(c).to_numpy() for c in ("doc", "tag"))
            texts = (t.as_py() for t in batch.column("text"))
            for symbols, lengths, text, offset in pieces(texts, symbols_of, width):
                wanted = np.zeros(len(symbols) + 1, np.int32)
                base = np.cumsum(lengths) - lengths
                for t, o, n, b in zip(text, offset, lengths, base):
                    starts, counts = stretches(batch, t)
                    np.add.at(wanted, b + np.clip(starts - o, 0, n), 1)
                    np.add.at(wanted, b + np.clip(starts + counts - o, 0, n), -1)
                found = runs(symbols, lengths, width, gram, np.cumsum(wanted)[:-1] > 0)
                yield from held.add(found, doc, tag, text, offset)
        yield from held.flush()

    return with_stretches(docs, open_runs, "inner").mapInArrow(run, RUNS)


def repeated_windows(docs: DataFrame, symbols_of: Symbols, width: int, grams: tuple[int, ...], within: bool) -> DataFrame:
    """Windows that occur before, as rows (doc, tag, start, windows) of runs.

    ``grams`` grow up to ``width``. At each length runs that are alone with their gram
    leave, whole repeats are decided, and what is open goes on to the next length.
    """
    found = keep(decide(find_runs(docs, symbols_of, width, grams[0], within), within), f"runs-{grams[0]}")
    out = found.where(F.col("kind") == DECIDED)
    for gram in grams[1:]:
        found = keep(decide(refine(docs, found.where(F.col("kind") == OPEN), symbols_of, width, gram, within), within), f"runs-{gram}")
        out = out.union(found.where(F.col("kind") == DECIDED))
    return out.drop("kind")
