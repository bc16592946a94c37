"""Incremental loads and live aggregates over a growing raw folder.

All jobs use ``availableNow``: they take what has landed since the last run,
with progress kept in a checkpoint below the shared folder, and stop.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import load, transforms
from ..session import shared_folder
from ..sources import envelopes as env
from ..sources.datasets import DATASETS
from ..sources.store import StarStore, atomic

# Epoch day 0 is a Thursday: weeks start four days later, on a Monday.
WEEK_START = "4 days"


def stream_records(
    spark: SparkSession, raw_dir: str, dataset: str, *, max_files: int | None = 1000, multi_line: bool | None = None
) -> DataFrame:
    """Streaming records of a listing dataset, same columns as the batch read."""
    ds = DATASETS[dataset]
    docs = env.read_envelopes(
        spark, raw_dir, ds.entity, f"ARRAY<STRUCT<{ds.record}>>",
        multi_line=multi_line, streaming=True, max_files=max_files,
    )
    return env.records(docs.where(env.is_listing(F.col("_snapshot"))))


def checkpoint_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/streams/{name}"


def run_batches(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Process everything that is available, one micro-batch at a time."""
    query = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(
        availableNow=True
    ).start()
    query.awaitTermination()
    return query


def load_increment(
    store: StarStore, raw_dir: str, checkpoint: str, now, *, max_files: int | None = 1000, multi_line: bool | None = None,
    after: Callable[[StarStore], None] | None = None,
) -> None:
    """Incremental load of propositions: each micro-batch is one idempotent
    upsert, so a replayed batch changes nothing. ``after`` refreshes whatever
    depends on the table (key figures, quality)."""
    stream = stream_records(store.spark, raw_dir, "proposicoes", max_files=max_files, multi_line=multi_line)

    def apply(batch: DataFrame, _: int) -> None:
        atomic(store, lambda one: load.apply_batch(one, "fato_proposicoes", transforms.proposicoes(batch), now))
        if after:
            after(store)

    run_batches(stream, apply, checkpoint)


def day_counts(stream: DataFrame, instant: str, *keys: str) -> DataFrame:
    """Tumbling daily counts."""
    bucket = F.window(instant, "1 day")
    return stream.groupBy(bucket, *keys).agg(F.count(F.lit(1)).alias("qtd")).select(
        F.to_date("window.start").alias("dia"), *keys, "qtd"
    )


def week_counts(stream: DataFrame, instant: str, *keys: str) -> DataFrame:
    """Tumbling weekly counts, weeks named by their Monday."""
    bucket = F.window(instant, "7 days", "7 days", WEEK_START)
    return stream.groupBy(bucket, *keys).agg(F.count(F.lit(1)).alias("qtd")).select(
        F.to_date("window.start").alias("semana"), *keys, "qtd"
    )


def added_counts(
    stream: DataFrame, count: Callable[[DataFrame], DataFrame], value: str, checkpoint: str, out: str
) -> DataFrame:
    """Counts of a growing stream without any state: each micro-batch is counted on
    its own and written under its id, and the parts are added when they are read.

    A row may be arbitrarily late and still counts; a replayed batch overwrites its
    own part. ``count`` gives the keys and the additive column ``value``."""
    spark = stream.sparkSession
    shape = count(spark.createDataFrame([], stream.schema))
    run_batches(stream, lambda batch, n: count(batch).write.mode("overwrite").parquet(f"{out}/b={n}"), checkpoint)
    parts = spark.read.schema(shape.schema).option("recursiveFileLookup", "true").parquet(out)
    keys = [c for c in shape.columns if c != value]
    return parts.groupBy(*keys).agg(F.sum(value).alias(value)).select(*shape.columns)


def deduplicated(stream: DataFrame, keys: list[str], instant: str, delay: str) -> DataFrame:
    """Bounded-state duplicate removal: copies arriving within ``delay``."""
    return stream.withWatermark(instant, delay).dropDuplicatesWithinWatermark(keys)


def final_counts(stream: DataFrame, keys: list[str], checkpoint: str, out: str) -> DataFrame:
    """Run an update-mode aggregate to the end of the available data and
    return the last value per key. Every micro-batch is written under its id,
    so a replay overwrites its own output only."""

    def save(batch: DataFrame, number: int) -> None:
        batch.withColumn("_batch", F.lit(number).cast("bigint")).write.mode("overwrite").parquet(f"{out}/b={number}")

    query = stream.writeStream.outputMode("update").foreachBatch(save).option(
        "checkpointLocation", checkpoint
    ).trigger(availableNow=True).start()
    query.awaitTermination()
    spark = stream.sparkSession
    saved = spark.read.schema(f"{_ddl(stream)}, _batch BIGINT").option("recursiveFileLookup", "true").parquet(out)
    values = [c for c in stream.columns if c not in keys]
    last = saved.groupBy(*keys).agg(*[F.max_by(c, "_batch").alias(c) for c in values])
    return last.select(*stream.columns)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in df.dtypes)
