"""Cost log of the model jobs: header line plus five fields per run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.cost import MONTHLY_CAP, chat_cost, embed_cost

SCHEMA = "data DATE, operacao STRING, tokens BIGINT, custo_usd DECIMAL(12,6), modelo STRING"


def read(spark: SparkSession, path: str) -> DataFrame:
    """The header is skipped, not trusted: older logs name eight columns."""
    return spark.read.schema(SCHEMA).option("header", "true").option("enforceSchema", "true").csv(path)


def append(rows: DataFrame, path: str) -> None:
    rows.select("data", "operacao", "tokens", "custo_usd", "modelo").write.mode("append").option(
        "header", "true"
    ).csv(path)


def _entry(df: DataFrame, day, operation: str, tokens, price, model: str) -> DataFrame:
    return df.select(
        F.lit(day).cast("date").alias("data"), F.lit(operation).alias("operacao"), tokens.alias("tokens"),
        price.cast("decimal(12,6)").alias("custo_usd"), F.lit(model).alias("modelo"),
    )


def embed_entry(results: DataFrame, day, model: str) -> DataFrame:
    """Log row of one embedding run: all tokens and their price."""
    total = results.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("t"))
    return _entry(total, day, "embed_pending", F.col("t"), embed_cost(F.col("t")), model)


def summary_entry(results: DataFrame, day, model: str) -> DataFrame:
    """Log row of one summary run: tokens read and written."""
    total = results.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tokens_in", "tokens_out")])
    used, made = F.col("tokens_in"), F.col("tokens_out")
    return _entry(total, day, "summarize_pending", used + made, chat_cost(used, made), model)


def roll_up(log: DataFrame, grain: str = "month") -> DataFrame:
    """Tokens and dollars per operation and day or month; months also tell
    whether all operations together stay within the cap."""
    period = F.trunc("data", "month") if grain == "month" else F.col("data")
    by_operation = log.groupBy(period.alias("periodo"), "operacao").agg(
        F.count(F.lit(1)).alias("execucoes"),
        F.sum("tokens").alias("tokens"),
        F.sum("custo_usd").alias("custo_usd"),
    )
    if grain != "month":
        return by_operation
    totals = by_operation.groupBy("periodo").agg(F.sum("custo_usd").alias("_month_total"))
    return by_operation.join(totals, "periodo").select(
        *by_operation.columns, (F.col("_month_total") <= F.lit(MONTHLY_CAP)).alias("dentro_do_teto")
    )
