"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from civicspark.session import scratch_path

#: Rows that one (key, bucket) group of ``gapless`` numbers at 10^11 rows: about 10^11 / BUCKETS / keys.
BUCKETS = 4096
#: Bytes of an Arrow batch that a Python task takes; a row of more is a batch of its own.
BATCH_BYTES = 2 * 1024 * 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage: write to the shared folder and reread.

    Replaces ``checkpoint()``: the written table is columnar, pruned on reading,
    and survives the loss of any executor. While it is written, the shuffle
    files of the job are released as soon as the job has ended.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, label)
    release(spark)
    small_batches(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark remove shuffle files at the end of each query (its own setting, off by default)."""
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches between Spark and Python by their bytes: by rows alone (10,000) a batch of whole
    texts takes tens of MB, outside the heap of each executor's JVM and again in each Python worker, which keeps them."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def gapless(df: DataFrame, keys: list[str], out: str, buckets: int = BUCKETS) -> DataFrame:
    """Number the rows of each key 0, 1, 2, ... in ``out`` without bringing a key's rows together.

    Equal rows are counted before they are shuffled, rows are dealt to buckets
    by a hash of the whole row, buckets get their first number from a running
    sum over (key, bucket) counts, and only the rows of one bucket are ordered.
    ``df`` is read twice: pass a written table. The order of numbers is that of
    a hash; equal rows are interchangeable, so the result is deterministic.
    """
    columns = df.columns
    counted = (
        df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_bucket", F.pmod(F.xxhash64(*columns), F.lit(buckets)))
    )
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = (
        df.groupBy(*keys, F.pmod(F.xxhash64(*columns), F.lit(buckets)).alias("_bucket"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
        .select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_bucket").alias("_b"), "_first")
    )
    others = [c for c in columns if c not in keys]
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*others).rowsBetween(Window.unboundedPreceding, -1)
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    placed = (
        counted.withColumn("_before", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
        .join(first, [*same, F.col("_bucket") == F.col("_b")])
        .withColumn("_start", F.col("_first") + F.col("_before"))
    )
    return placed.select(*columns, F.explode(F.sequence("_start", F.col("_start") + F.col("_n") - 1)).alias(out))
