"""Ordered duplicate removal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.envelopes import ORIGIN


def keep_first(
    df: DataFrame, keys: Sequence[str | Column], order: Sequence[str | Column] = ORIGIN, valid: Column | None = None
) -> DataFrame:
    """First (valid) row per key in the given order; ``dropDuplicates`` would
    keep an arbitrary one. The rank filter is applied before the shuffle as
    well, so every task sends at most one row per key, however hot the key is.

    Validity ranks rows instead of filtering them first: a filter would be
    pushed below the projection and evaluate costly cleaning rules twice."""
    first = list(order)
    if valid is not None:
        df = df.withColumn("_valid", F.coalesce(valid, F.lit(False)))
        first.insert(0, F.desc("_valid"))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*first))
    ranked = df.withColumn("_rank", rank)
    if valid is None:
        return ranked.where(F.col("_rank") == 1).drop("_rank")
    return ranked.where((F.col("_rank") == 1) & F.col("_valid")).drop("_rank", "_valid")
