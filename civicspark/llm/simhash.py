"""SimHash near-duplicates by a segment-popcount embedding (operator 5).

A fingerprint's 32 segments of two bits are mapped to their bit counts; the sum
of absolute differences of two count vectors (Manhattan distance) never exceeds
the Hamming distance of the fingerprints. Counts are kept in unary (0 -> 00,
1 -> 01, 2 -> 11), so that the Manhattan distance is the number of differing bits.
The range join uses a grid: with radius r the segments are dealt to r + 3 bands,
two vectors within r agree in at least three whole bands, and the cells are the
counts of every three bands. Pairs of a cell are filtered by the Manhattan
distance and verified by the exact Hamming distance; no pair is lost.

Equal fingerprints are merged first. Cells of few fingerprints are joined in the
JVM; larger cells are cut into chunks whose block pairs return spanning links
instead of pairs, so that neither a task nor the output grows with the square
of a group.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .blocks import block_pairs, labels
from .common import keep
from .components import components

RADIUS = 3
SHINGLE = 3
SEED = 42
#: Cells up to this many distinct fingerprints are self-joined; larger ones go through block pairs. Same links.
SMALL_CELL = 64


def shingle_hashes(text: str | None, words: int, seed: int = SEED) -> np.ndarray:
    """XXH64 of every run of ``words`` words of the text with A-Z lower-cased, repeats included.

    A text of fewer words has one run, the whole sequence; no words, none.
    """
    found = (text or "").encode().lower().split()
    if not found:
        return np.empty(0, np.uint64)
    joined, k = b" ".join(found), min(words, len(found))
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    return np.fromiter(
        (digest(joined[s:e], seed) for s, e in zip(starts[:len(found) - k + 1].tolist(), ends[k - 1:].tolist())),
        np.uint64, len(found) - k + 1)


def majority(hashes: np.ndarray) -> np.ndarray:
    """How many more hashes have each of the 64 bits set than not (bit 0 first)."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return 2 * bits.sum(axis=0, dtype=np.int64) - len(hashes)


def fingerprint(hashes: np.ndarray) -> int:
    """Signed 64-bit value whose bits are set in over half the hashes; zero for none."""
    if not len(hashes):
        return 0
    return int(np.packbits(majority(hashes) > 0, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, words: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, fingerprint), one per row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(shingle_hashes(t.as_py(), words)) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.int64())], ["doc_id", "fingerprint"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, "doc_id long, fingerprint long")


def unary_counts(fp):
    """Bit counts of the 32 two-bit segments, in unary: a segment holds as many low bits as it has set bits."""
    even = F.lit(0x5555555555555555)
    low, high = fp.bitwiseAND(even), F.shiftrightunsigned(fp, 1).bitwiseAND(even)
    return low.bitwiseOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def cell_masks(radius: int) -> list[int]:
    """Bits of every three of radius + 3 bands of segments."""
    bands = [sum(3 << (2 * s) for s in part.tolist()) for part in np.array_split(np.arange(32), radius + 3)]
    return [_signed(a | b | c) for a, b, c in combinations(bands, 3)]


def _block_links(radius: int):
    def run(found: pa.Table) -> pa.Table:
        fp = found.column("fp").to_numpy().astype(np.uint64)
        fp = np.unique(fp)
        near = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= radius
        first = labels(near)
        linked = np.flatnonzero(first != np.arange(len(fp)))
        return pa.table({"a": fp[linked].astype(np.int64), "b": fp[first[linked]].astype(np.int64)},
                        schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    return run


def links(prints: DataFrame, radius: int = RADIUS, small: int = SMALL_CELL) -> DataFrame:
    """Links (a, b) that connect all distinct values of ``fp`` within ``radius`` bits of each other.

    Linked values are connected by the returned pairs, directly or through others
    within the radius; no returned pair lies beyond the radius's closure.
    """
    if not 0 <= radius <= 29:
        raise ValueError("a radius above 29 leaves fewer than three bands")
    masks = F.array(*[F.lit(m) for m in cell_masks(radius)])
    cells = (
        prints.select("fp", unary_counts(F.col("fp")).alias("counts"))
        .select("fp", "counts", F.posexplode(masks).alias("bands", "mask"))
        .select("bands", F.col("counts").bitwiseAND(F.col("mask")).alias("cell"), "fp", "counts")
    )
    sizes = cells.groupBy("bands", "cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = keep(cells.join(sizes, ["bands", "cell"]), "cells")
    left = members.where(F.col("n") <= small).drop("n")
    right = left.select(
        "bands", "cell", F.col("fp").alias("other"), F.col("counts").alias("other_counts"))
    few = left.join(right, ["bands", "cell"]).where(
        (F.col("fp") > F.col("other"))
        & (F.bit_count(F.col("counts").bitwiseXOR(F.col("other_counts"))) <= radius)
        & (F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= radius)
    ).select(F.col("fp").alias("a"), F.col("other").alias("b"))
    many = (
        block_pairs(members.where(F.col("n") > small), ["bands", "cell"], "n", "fp")
        .select("bands", "cell", "_i", "_j", "fp")
        .groupBy("bands", "cell", "_i", "_j").applyInArrow(_block_links(radius), "a long, b long")
    )
    return few.union(many)


def near_duplicates(
    docs: DataFrame, words: int = SHINGLE, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Rows (doc_id, fingerprint BIGINT, component_id), one per row of ``docs``.

    Fingerprints within ``radius`` differing bits are linked; component_id is the
    smallest doc_id reachable. Null and empty texts have the fingerprint zero and are
    linked like any other. Equal texts share fingerprint and component; a repeated
    doc_id gives one row each time. A null doc_id has a component but never names one;
    a component of null ids only is null. Other columns are ignored.
    """
    found = keep(fingerprints(docs, words, id_col, text_col), "fingerprints")
    distinct = keep(found.groupBy(F.col("fingerprint").alias("fp")).agg(F.min("doc_id").alias("first")), "distinct")
    roots = components(links(distinct, radius))
    rooted = distinct.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    names = rooted.join(named, "root").select(F.col("fp").alias("fingerprint"), "component_id")
    return found.join(names, "fingerprint", "left").select("doc_id", "fingerprint", "component_id")
