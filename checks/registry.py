"""Query registry: name -> Spark callable and, where SQL can say it, oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DecimalType

from . import standins

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def edge(df: DataFrame) -> DataFrame:
    """Decimals as DOUBLE for the comparison with the oracle."""
    casts = {f.name: F.col(f.name).cast("double") for f in df.schema.fields if isinstance(f.dataType, DecimalType)}
    return df.withColumns(casts) if casts else df


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name`` with its oracle text."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = lambda spark, sf_dir: edge(fn(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = standins.with_ctes(sql)
        return fn

    return register


def view(name: str, fn, sql: str, **params):
    """Register a function of the star tables."""
    query(name, sql)(lambda spark, sf_dir: fn(standins.tables(spark, sf_dir), **params))
