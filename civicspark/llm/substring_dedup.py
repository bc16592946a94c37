"""Removal of long repeated word sequences on a compacted de Bruijn graph (operator 6).

Edges are the windows of 13 words, nodes their first and last 12 words, and every
edge knows its source coordinate (document, word). Edges are never stored one by
one: consecutive edges of a document whose smallest 4-gram is the same one form a
path (the runs of ``runs``), bucketed by that 4-gram. In a bucket with one distinct
path the graph does not branch, and the path is decided as a whole; where paths of
a bucket differ the graph branches, and they are cut into their edges, which are
compared one by one. Repeated edges of a document are then compacted back: an edge
and its successor belong to one stretch.

Two edges are the same if two independent 64-bit hashes of their words agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from .repeats import identified, repeated_windows, stretches, with_stretches
from .runs import union_lengths

WORDS, GRAM = 13, 4


def word_symbols(text: str) -> np.ndarray:
    found = text.encode().split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))


def compacted(paths: DataFrame) -> DataFrame:
    """Paths (doc, tag, start, windows) of which no two of a document touch: a path and its successor become one."""
    along = Window.partitionBy("doc", "tag").orderBy("start")
    end = F.col("start") + F.col("windows")
    reach = F.max(end).over(along.rowsBetween(Window.unboundedPreceding, -1))
    return (
        paths.withColumn("opens", F.coalesce(F.col("start") > reach, F.lit(True)).cast("int"))
        .withColumn("path", F.sum("opens").over(along.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("doc", "tag", "path").agg(F.min("start").alias("start"), (F.max(end) - F.min("start")).cast("int").alias("windows"))
        .select("doc", "tag", "start", "windows")
    )


def repeated(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """Paths (doc, tag, start, windows) whose edges also start in a document with a smaller id."""
    return compacted(repeated_windows(docs, word_symbols, words, (min(GRAM, words), words), False))


def _cut(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, removed, kept = [], [], []
            for i, text in enumerate(batch.column("text")):
                found = text.as_py().encode().split()
                starts, counts = stretches(batch, i)
                starts, ends = union_lengths(starts, starts + counts + words - 1)
                total.append(len(found))
                removed.append(int((ends - starts).sum()))
                for a, b in zip(starts.tolist()[::-1], ends.tolist()[::-1]):
                    del found[a:b]
                kept.append(b" ".join(found))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string())], ["row", "n_words", "n_removed", "kept"])

    return run


def deduplicate(docs: DataFrame, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, n_words, n_removed, kept), one per row of ``docs``.

    Words are what ASCII white space separates, unchanged. Every word covered by a
    window of ``words`` words that also starts in a document with a smaller id is
    removed; ``kept`` joins the others by one space, ``row`` holds the other columns of
    the input whatever their names. Null and empty texts have no words, texts shorter
    than a window lose none. A null id is the smallest; rows that repeat an id do not
    remove words of each other.
    """
    carried = identified(docs, id_col, text_col, carry=True)
    joined = with_stretches(carried, repeated(identified(docs, id_col, text_col), words), "left")
    row = carried.schema["row"].dataType.simpleString()
    return joined.select("row", "text", "starts", "counts").mapInArrow(
        _cut(words), f"row {row}, n_words long, n_removed long, kept string")
