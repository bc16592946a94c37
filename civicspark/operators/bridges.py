"""Set-based bridge jobs: authorship and roll-call votes.

Every job handles all pending items in one plan. A broken item becomes an
error row and leaves the rest of the batch alone.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import uri
from ..sources import envelopes as env
from ..sources.datasets import DATASETS
from . import transforms
from .dedup import keep_first
from .upsert import error_rows

# Log texts, and the batch limits of a daily run for callers that want one.
NO_AUTHORS = "API nao retornou autores para a proposicao"
ORPHAN_DEPUTY = "Deputado autor sem correspondencia em dim_deputados (prop {})"
UNREADABLE = "Documento bruto ilegivel"
NOT_LANDED = "Documento bruto ausente"
AUTHORS_LIMIT = 500
VOTES_LIMIT = 100


def pending_authorship(proposicoes: DataFrame, limit: int | None = None, proposicao_id: int | None = None) -> DataFrame:
    """Propositions still to be read, newest id first; one id reprocesses it."""
    if proposicao_id is not None:
        return proposicoes.sparkSession.range(1).select(F.lit(proposicao_id).cast("int").alias("proposicao_id"))
    pending = proposicoes.where(~F.col("autores_carregados")).select("proposicao_id")
    return pending if limit is None else pending.orderBy(F.desc("proposicao_id")).limit(limit)


def pending_votes(votacoes: DataFrame, limit: int | None = None, votacao_id: str | None = None) -> DataFrame:
    """Votes without roll call, most recent first (id breaks ties)."""
    if votacao_id is not None:
        return votacoes.sparkSession.range(1).select(F.lit(votacao_id).alias("votacao_id"))
    pending = votacoes.where(~F.col("votos_carregados"))
    if limit is not None:
        pending = pending.orderBy(F.col("data").desc_nulls_first(), F.col("votacao_id")).limit(limit)
    return pending.select("votacao_id")


def fetched_items(spark: SparkSession, raw_dir: str, dataset: str, *, multi_line: bool | None = None) -> tuple[DataFrame, DataFrame]:
    """(fetched, records) of a per-item dataset. ``fetched`` has one row per
    item: its newest snapshot and whether that document was unreadable (the
    item id then comes from the file name)."""
    ds = DATASETS[dataset]
    key = uri.owner_key(F.col("_endpoint"))
    from_name = F.nullif(F.regexp_extract("_snapshot", r"_(.+)\.json$", 1), F.lit(""))
    owner = F.coalesce(key, from_name)
    if ds.owner_is_number:
        owner = owner.try_cast("int")
    docs = env.read_envelopes(spark, raw_dir, ds.entity, f"ARRAY<STRUCT<{ds.record}>>", multi_line=multi_line)
    keyed = docs.withColumn(ds.owner, owner).where(F.col(ds.owner).isNotNull())
    fetched = keyed.groupBy(ds.owner).agg(
        F.max("_snapshot").alias("_snapshot"),
        F.max_by(F.col("_corrupt").isNotNull(), F.col("_snapshot")).alias("_unreadable"),
    )
    rows = keyed.select(
        ds.owner, "_snapshot", "_part", F.posexplode("dados").alias("_pos", "_record")
    ).select(ds.owner, "_snapshot", "_part", "_pos", "_record.*")
    return fetched, rows


# Keeps an intermediate result that several outputs share; a load stores it.
Keep = Callable[[DataFrame, str], DataFrame]


def _as_is(df: DataFrame, label: str) -> DataFrame:
    return df


def _counters(parts: list[DataFrame], names: list[str]) -> DataFrame:
    """One row out of one-row frames that each know some of the counters."""
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return merged.agg(*[F.coalesce(F.max(n), F.lit(0)).cast("bigint").alias(n) for n in names])


def _count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def orphan_authors(authors: DataFrame, deputados: DataFrame) -> DataFrame:
    """Author rows that name a deputy missing from the dimension."""
    named = authors.where(F.col("deputado_id").isNotNull())
    return named.join(deputados.select("deputado_id"), "deputado_id", "left_anti")


def _work(targets: DataFrame, fetched: DataFrame, records: DataFrame, key: str):
    """Split the targets into readable, unreadable and absent items and take
    the records of the readable ones."""
    items = targets.join(fetched, key, "left")
    readable = items.where(F.col("_snapshot").isNotNull() & ~F.col("_unreadable")).select(key, "_snapshot")
    broken = items.where(F.col("_snapshot").isNull() | F.col("_unreadable"))
    return readable, broken, records.join(readable, [key, "_snapshot"], "left_semi")


def _broken_text() -> Column:
    return F.when(F.col("_snapshot").isNull(), F.lit(NOT_LANDED)).otherwise(F.lit(UNREADABLE))


def authorship(
    targets: DataFrame, fetched: DataFrame, records: DataFrame, deputados: DataFrame, now: Column, keep: Keep = _as_is
) -> dict[str, DataFrame]:
    """Authorship job: bridge rows, flags per proposition, errors, counters."""
    readable, broken, mine = _work(targets, fetched, records, "proposicao_id")
    with_origin = keep(transforms.autores(mine, keep_origin=True), "authors")
    authors = with_origin.drop(*env.ORIGIN)
    elected = transforms.main_authors(with_origin)
    flags = readable.select("proposicao_id").join(elected, "proposicao_id", "left").withColumn(
        "qtd_autores", F.coalesce("qtd_autores", F.lit(0))
    )
    without = flags.where(F.col("qtd_autores") == 0)
    orphans = orphan_authors(authors, deputados)
    prop = F.col("proposicao_id")
    orphan_text = F.replace(F.lit(ORPHAN_DEPUTY), F.lit("{}"), prop.cast("string"))
    errors = reduce(DataFrame.unionByName, [
        error_rows(without, "autores", "proposicao", prop, F.lit(NO_AUTHORS), now),
        error_rows(orphans, "autores", "autor", F.col("deputado_id"), orphan_text, now),
        error_rows(broken, "autores", "proposicao", prop, _broken_text(), now),
    ])
    per_item = flags.agg(
        F.count(F.lit(1)).alias("processadas"),
        F.count_if(F.col("qtd_autores") > 0).alias("com_autores"),
        F.count_if(F.col("qtd_autores") == 0).alias("sem_autores"),
        F.sum("qtd_autores").alias("autores_inseridos"),
    )
    counters = _counters(
        [_count(targets, "alvos"), per_item, _count(orphans, "autores_orfaos"), _count(broken, "erros")],
        ["alvos", "processadas", "com_autores", "sem_autores", "autores_inseridos", "autores_orfaos", "erros"],
    )
    return {"ponte": authors, "flags": flags, "errors": errors, "counters": counters}


def roll_call(
    targets: DataFrame, fetched: DataFrame, records: DataFrame, details: DataFrame, now: Column, keep: Keep = _as_is
) -> dict[str, DataFrame]:
    """Roll-call job: links, single votes, flags, errors, counters. A vote
    without single votes is symbolic: loaded, not an error.

    ``details`` holds one detail record per vote (``votacao_id`` plus the
    fields of the detail dataset, ``_corrupt`` when unreadable)."""
    readable, broken, mine = _work(targets, fetched, records, "votacao_id")
    detail = details.join(targets, "votacao_id", "left_semi")
    bad_detail = F.col("_corrupt").isNotNull() if "_corrupt" in details.columns else F.lit(False)
    links = keep(transforms.vote_links(detail.where(~bad_detail)), "links")
    votes = keep(transforms.votos(mine), "votes")
    per_vote = votes.groupBy("votacao_id").agg(F.count(F.lit(1)).cast("int").alias("qtd_votos"))
    flags = readable.select("votacao_id").join(per_vote, "votacao_id", "left").withColumn(
        "qtd_votos", F.coalesce("qtd_votos", F.lit(0))
    )
    vote = F.col("votacao_id")
    errors = reduce(DataFrame.unionByName, [
        error_rows(detail.where(bad_detail), "vinculo_votacao", "votacao", vote, F.lit(UNREADABLE), now),
        error_rows(broken, "votos", "votacao", vote, _broken_text(), now),
    ])
    per_item = flags.agg(
        F.count(F.lit(1)).alias("processadas"),
        F.count_if(F.col("qtd_votos") > 0).alias("com_votos"),
        F.count_if(F.col("qtd_votos") == 0).alias("sem_votos"),
        F.sum("qtd_votos").alias("votos_inseridos"),
    )
    counters = _counters(
        [_count(targets, "alvos"), per_item, _count(links.where(F.col("proposicao_id").isNotNull()), "vinculadas"),
         _count(broken, "erros")],
        ["alvos", "processadas", "com_votos", "sem_votos", "votos_inseridos", "vinculadas", "erros"],
    )
    return {"links": links, "votos": votes, "flags": flags, "errors": errors, "counters": counters}


def newest_details(spark: SparkSession, raw_dir: str, *, multi_line: bool | None = None) -> DataFrame:
    """Newest detail document per vote."""
    ds = DATASETS["votacoes_detalhe"]
    docs = env.details(spark, raw_dir, ds.entity, ds.record, multi_line=multi_line)
    from_name = F.nullif(F.regexp_extract("_snapshot", r"_(.+)\.json$", 1), F.lit(""))
    keyed = docs.withColumn("votacao_id", F.coalesce(uri.owner_key(F.col("_endpoint")), from_name))
    return keep_first(keyed.where(F.col("votacao_id").isNotNull()), ["votacao_id"], [F.desc("_snapshot"), F.desc("_part")])
