"""Pairs within groups of any size, in tasks of bounded size and without emitting pairs."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

#: Rows of a chunk: a task compares two chunks, at most SIDE x SIDE pairs.
SIDE = 1024


def block_pairs(df: DataFrame, keys: list[str], rows: str, spread: str, side: int = SIDE) -> DataFrame:
    """Deal the rows of each group to the block pairs (``_i`` <= ``_j``) of its chunks.

    ``rows`` holds the size of the row's group, ``spread`` a column whose hash
    deals rows to chunks. Every two rows of a group meet in exactly one block pair
    if their chunks differ, and in (c, c) if both are in chunk c. A group of n rows
    is copied n / side times: the price of bounded tasks for hot groups.
    """
    chunks = F.ceil(F.col(rows) / F.lit(side)).cast("int")
    return (
        df.withColumn("_chunk", F.pmod(F.xxhash64(spread), chunks).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), chunks - 1)))
        .withColumn("_i", F.least("_chunk", "_other")).withColumn("_j", F.greatest("_chunk", "_other"))
        .drop("_other")
    )


def labels(near: np.ndarray) -> np.ndarray:
    """Smallest row index reachable from each row of a symmetric boolean matrix.

    Grows one component at a time, row by row: each row is looked at once.
    """
    n = len(near)
    out = np.full(n, -1, dtype=np.int64)
    for start in range(n):
        if out[start] >= 0:
            continue
        out[start], front = start, near[start] & (out < 0)
        while front.any():
            out[front] = start
            front = near[front].any(axis=0) & (out < 0)
    return out
