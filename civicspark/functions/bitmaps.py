"""Exact distinct counts that merge: bitmaps of integer ids by bucket.

A bucket holds a fixed number of neighbouring ids as bits, so ids of a dense dimension take a bit
each. Bitmaps of parts (days, key ranges, files) are combined by OR without the rows
they were made of.

A ``bitmaps`` bucket takes 4 KB however few of its ids occur. Where keys are many and each
holds few of the ids, ``words`` keeps the same bits in words of 64 ids instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def bitmaps(df: DataFrame, keys: Sequence[str], ident: str, bits: str = "bits") -> DataFrame:
    """(keys, balde, bits): the ids of each key as bitmaps; null ids are left out."""
    known = df.where(F.col(ident).isNotNull())
    return known.groupBy(*keys, F.bitmap_bucket_number(ident).alias("balde")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(ident)).alias(bits))


def merged(parts: DataFrame, keys: Sequence[str], bits: str = "bits") -> DataFrame:
    """Bitmaps of fewer keys, from those of more."""
    return parts.groupBy(*keys, "balde").agg(F.bitmap_or_agg(bits).alias(bits))


def distinct_count(parts: DataFrame, keys: Sequence[str], out: str, bits: str = "bits") -> DataFrame:
    """(keys, out): distinct ids of each key."""
    return merged(parts, keys, bits).groupBy(*keys).agg(F.sum(F.bitmap_count(bits)).alias(out))


def words(df: DataFrame, keys: Sequence[str], ident: str, bits: str = "bits") -> DataFrame:
    """(keys, balde, bits): the ids of each key as bitmaps of 64 neighbouring ids, one BIGINT each; null ids are left out."""
    of = F.col(ident).cast("bigint")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), of.bitwiseAND(F.lit(63).cast("bigint")).cast("int"))
    return df.where(F.col(ident).isNotNull()).groupBy(*keys, F.shiftright(of, 6).alias("balde")).agg(F.bit_or(bit).alias(bits))


def distinct_in_words(parts: DataFrame, keys: Sequence[str], out: str, bits: str = "bits") -> DataFrame:
    """(keys, out): distinct ids of each key, from ``words``."""
    return parts.groupBy(*keys, "balde").agg(F.bit_or(bits).alias(bits)).groupBy(*keys).agg(F.sum(F.bit_count(bits)).alias(out))
