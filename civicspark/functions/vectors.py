"""Dense vectors as ARRAY columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def cosine(a: Column, b: Column, norm_a: Column | None = None, norm_b: Column | None = None) -> Column:
    """Cosine in double precision; 0.0 when either vector has no length."""
    scale = (norm(a) if norm_a is None else norm_a) * (norm(b) if norm_b is None else norm_b)
    return F.when(scale == 0, F.lit(0.0)).otherwise(dot(a, b) / scale)


def parse_vector(col: Column) -> Column:
    """'[0.1,0.2]' -> ARRAY<FLOAT>; NULL when any element does not parse."""
    items = F.split(F.regexp_replace(col, r"^[\[\]]+|[\[\]]+$", ""), ",")
    values = F.transform(items, lambda x: F.trim(x).try_cast("float"))
    return F.when(~F.exists(values, lambda x: x.isNull()), values)


def format_vector(col: Column) -> Column:
    """ARRAY -> '[0.10000000,...]' with eight decimals."""
    items = F.transform(col, lambda x: F.format_string("%.8f", x.cast("double")))
    return F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))
