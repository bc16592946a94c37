"""Removal of long repeated byte strings by prefix doubling (operator 4).

The question is which suffixes share their first ``LENGTH`` bytes with an earlier
one. Prefix doubling ranks suffixes by prefixes of growing length: the rank of a
prefix of 2h bytes is that of the pair (rank of h bytes here, rank of h bytes at the
offset h). Ranks are names, hashes of such pairs, as only equality counts. Spark brings
equal ranks together, suffixes that have become unique leave, and the rest goes on
to the next length until it passes the threshold.

Ranking each byte of the corpus at each length would shuffle many times its size. So
a length h ranks sampled positions only: of every 100 bytes the smallest name of h
bytes (the minimizer). Suffixes with 100 equal bytes have the same one at the same
distance, so what is unique at the sampled position is unique at all. Neighbouring
suffixes with one sampled position are a run, and a run that equals an earlier one as
a whole is decided without looking inside (``runs``, ``repeats``). What is open at 24
bytes, at the ends of repeated passages, goes on to 48, 96 and 100, where every
position is its own sample. The result is that of ranking every byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .repeats import identified, repeated_windows, stretches, with_stretches
from .runs import mix, union_lengths

LENGTH = 100
#: Lengths that are ranked, up to the threshold.
GRAMS = (24, 48, 96, 100)

BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64))


def byte_symbols(text: str) -> np.ndarray:
    return BYTE_CODES[np.frombuffer(text.encode(), np.uint8)]


def repeated(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Suffixes whose first ``length`` bytes start earlier as well, as rows (doc, tag, start, windows) of runs."""
    grams = tuple(g for g in GRAMS if g < length)
    return repeated_windows(docs, byte_symbols, length, (*grams, length), True)


def _cut(length: int, as_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, spans, kept = [], [], [], []
            for i, text in enumerate(batch.column("text")):
                data = text.as_py().encode()
                starts, counts = stretches(batch, i)
                starts, ends = union_lengths(starts, starts + counts + length - 1)
                edges = np.concatenate([[0], np.stack([starts, ends], axis=1).ravel(), [len(data)]]).astype(int).tolist()
                sizes.append(len(data))
                removed.append(int((ends - starts).sum()))
                spans.append(len(starts))
                left = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
                kept.append(left.decode("utf-8", "ignore") if as_text else left)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(spans, pa.int64()), pa.array(kept, pa.string() if as_text else pa.binary())],
                ["row", "n_bytes", "n_removed", "n_spans", "kept"])

    return run


def deduplicate(
    docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", as_text: bool = False,
) -> DataFrame:
    """(row, n_bytes, n_removed, n_spans, kept), one per row of ``docs``.

    Every byte covered by a string of ``length`` bytes that also starts earlier
    (smaller id, or same document at a smaller offset) is removed; ``kept`` holds the
    other bytes (BINARY, as a cut may fall inside a character; with ``as_text`` a STRING
    without the bytes of such characters), n_spans counts maximal removed stretches,
    ``row`` has the other columns of the input whatever their names.
    Null and empty texts have no bytes. A null id comes first. Rows that repeat an id
    with the same text have the same result, with different texts neither is earlier.
    """
    carried = identified(docs, id_col, text_col, carry=True)
    joined = with_stretches(carried, repeated(identified(docs, id_col, text_col), length), "left")
    row = carried.schema["row"].dataType.simpleString()
    return joined.select("row", "text", "starts", "counts").mapInArrow(
        _cut(length, as_text), f"row {row}, n_bytes long, n_removed long, n_spans long, kept {'string' if as_text else 'binary'}")
