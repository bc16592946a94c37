"""Views that are refreshed after a load without being recomputed.

A maintained view is kept as partial aggregates per key range of its facts, in the same
manifest as the tables: for each range the folder of its partial rows and the
folders they were made from. ``refresh`` compares these with the current ones, reads
only ranges that have changed since (a changed dimension changes all), and replaces their partial rows; the view itself is the
sum of all ranges. Nothing is added twice: a replayed load names the same ranges and
replaces the same rows. Distinct counts that span ranges are kept as bitmaps.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions import bitmaps
from ..plans import views
from ..sources.store import RANGE, RANGE_KEYS, StarLoad, StarStore, key_range

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Part:
    """Partial rows of ``facts`` (divided by the same key) and ``dims``: ``rows`` makes (faixa, columns of ``shape``) out of them."""
    name: str
    facts: tuple[str, ...]
    dims: tuple[str, ...]
    shape: str
    rows: Callable[[Tables], DataFrame]

    def _current(self, load: StarLoad) -> dict[str, list[str]]:
        facts = [load.noted(t) for t in self.facts]
        dims = [f for t in self.dims for f in load.noted(t).get("", [])]
        return {key: [f for found in facts for f in found.get(key, [])] + dims for key in {k for found in facts for k in found}}

    def refresh(self, store: StarStore) -> list[int]:
        """Bring the partial rows up to date; returns the ranges that were read."""
        with store.begin() as load:
            current, known = self._current(load), load.noted(f"{self.name}.origem")
            stale = sorted(int(k) for k, origin in current.items() if known.get(k) != origin)
            if stale:
                tables = {t: load.read(t, stale).withColumn(RANGE, key_range(F.col(RANGE_KEYS[t]), load.range_width)) for t in self.facts}
                tables |= {t: load.read(t) for t in self.dims}
                folder = f"_views/{self.name}/{uuid.uuid4().hex}"
                # one range's rows in one file, or a few: not one of each task
                made = self.rows(tables).hint("rebalance", RANGE)
                made.write.partitionBy(RANGE).parquet(f"{load.root}/{folder}")
                written = load.written(folder)
                load.replace(self.name, {str(n): written.get(str(n), []) for n in stale})
                load.replace(f"{self.name}.origem", {str(n): current[str(n)] for n in stale})
            return stale

    def read(self, store: StarStore) -> DataFrame:
        """Partial rows of all ranges."""
        with store.begin() as load:
            folders = [f"{load.root}/{f}" for found in load.noted(self.name).values() for f in found]
        if not folders:
            return store.spark.createDataFrame([], self.shape)
        return store.spark.read.schema(self.shape).parquet(*folders)


# --- V1: key figures ---

def _propositions(t: Tables) -> DataFrame:
    return t["fato_proposicoes"].groupBy(RANGE).agg(
        F.count(F.lit(1)).alias("proposicoes"), F.count("tema_id").alias("com_tema"), F.count("resumo_executivo").alias("com_resumo"),
        F.count("embedding").alias("com_embedding"), F.count_if("autores_carregados").alias("com_autor"),
        F.count_if(~F.col("autores_carregados")).alias("sem_autor"),
        F.min("data_apresentacao").alias("data_min"), F.max("data_apresentacao").alias("data_max"), F.max("ingested_at").alias("ultima_carga"))


def _votings(t: Tables) -> DataFrame:
    return t["fato_votacoes"].groupBy(RANGE).agg(
        F.count(F.lit(1)).alias("votacoes"), F.count_if("votos_carregados").alias("votacoes_com_votos"),
        F.count_if(~F.col("votos_carregados")).alias("votacoes_sem_votos"), F.count_if(F.col("proposicao_id").isNull()).alias("sem_proposicao"))


PROPOSITIONS = Part(
    "_vw_proposicoes", ("fato_proposicoes",), (),
    "proposicoes bigint, com_tema bigint, com_resumo bigint, com_embedding bigint, com_autor bigint, sem_autor bigint, data_min date, data_max date, ultima_carga timestamp",
    _propositions)
VOTINGS = Part(
    "_vw_votacoes", ("fato_votacoes",), (), "votacoes bigint, votacoes_com_votos bigint, votacoes_sem_votos bigint, sem_proposicao bigint", _votings)
EXPENSES = Part(
    "_vw_despesas", ("fato_despesas",), (), "despesas_docs bigint, despesas_total decimal(22,2)",
    lambda t: t["fato_despesas"].groupBy(RANGE).agg(F.count(F.lit(1)).alias("despesas_docs"), F.sum("valor_liquido").alias("despesas_total")))
VOTES = Part(
    "_vw_votos", ("fato_votacao_votos",), (), "votos_nominais bigint",
    lambda t: t["fato_votacao_votos"].groupBy(RANGE).agg(F.count(F.lit(1)).alias("votos_nominais")))


def _added(part: DataFrame, *names: str) -> DataFrame:
    return part.agg(*[F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias(n) for n in names])


def kpis(store: StarStore) -> DataFrame:
    """V1 from partial rows; only dimensions are read whole."""
    props = PROPOSITIONS.read(store)
    deputies = store.read("dim_deputados").groupBy("uf").agg(F.count(F.lit(1)).alias("n"))
    count = lambda table, name: store.read(table).agg(F.count(F.lit(1)).alias(name))
    total = F.coalesce(F.sum("despesas_total"), F.lit(0)).cast("decimal(22,2)").alias("despesas_total")
    return views.one_row([
        _added(props, "proposicoes", "com_tema", "com_resumo", "com_embedding", "com_autor"),
        props.agg(F.min("data_min").alias("data_min"), F.max("data_max").alias("data_max"), F.max("ultima_carga").alias("ultima_carga")),
        deputies.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("deputados"), F.count("uf").alias("ufs")),
        count("dim_partidos", "partidos"), count("dim_temas", "temas"),
        _added(VOTINGS.read(store), "votacoes", "votacoes_com_votos"),
        _added(EXPENSES.read(store), "despesas_docs"), EXPENSES.read(store).agg(total),
        _added(VOTES.read(store), "votos_nominais"),
    ]).select(
        "proposicoes", "com_tema", "com_resumo", "com_embedding", "com_autor", "deputados", "ufs", "partidos", "temas", "votacoes", "despesas_docs",
        "despesas_total", "data_min", "data_max", "ultima_carga", "votacoes_com_votos", "votos_nominais")


# --- V23: quality ---

def data_quality(store: StarStore) -> DataFrame:
    """V23 from the same partial rows."""
    props = _added(PROPOSITIONS.read(store), "proposicoes", "com_tema", "com_resumo", "sem_autor").select(F.expr(
        "stack(3, 'proposicoes_sem_tema', proposicoes - com_tema, proposicoes, 'proposicoes_sem_resumo', proposicoes - com_resumo, proposicoes,"
        " 'proposicoes_sem_autor', sem_autor, proposicoes) as (metrica, valor, total)"))
    votes = _added(VOTINGS.read(store), "votacoes", "votacoes_sem_votos", "sem_proposicao").select(F.expr(
        "stack(2, 'votacoes_sem_proposicao', sem_proposicao, votacoes, 'votacoes_sem_votos', votacoes_sem_votos, votacoes) as (metrica, valor, total)"))
    return props.unionByName(votes)


# --- V24: heatmap ---

def _authorship(t: Tables) -> DataFrame:
    keys = [RANGE, "sigla_partido", "tema_id"]
    # propositions are as many as the table has, but their size is guessed from all columns of its files, far too
    # low for three of them: broadcast on that guess, they would pass through the driver's memory
    themes = t["fato_proposicoes"].select("proposicao_id", "tema_id", RANGE).hint("merge")
    rows = views.authors_with_party(t).join(themes, "proposicao_id")
    # a proposition lies in one range, so its count adds up; a deputy signs in many
    counts = rows.groupBy(*keys, "proposicao_id").agg(F.lit(1).alias("n")).groupBy(*keys).agg(F.count(F.lit(1)).alias("qtd_proposicoes"))
    return counts.select("*", F.lit(None).cast("bigint").alias("balde"), F.lit(None).cast("binary").alias("bits")).unionByName(
        bitmaps.bitmaps(rows, keys, "deputado_id").withColumn("qtd_proposicoes", F.lit(0).cast("bigint")))


AUTHORSHIP = Part(
    "_vw_autoria", ("fato_proposicoes", "ponte_proposicao_autores"), ("dim_deputados", "dim_partidos"),
    "sigla_partido string, tema_id int, qtd_proposicoes bigint, balde bigint, bits binary", _authorship)


def heatmap_tema_partido(store: StarStore) -> DataFrame:
    """V24 from partial rows."""
    parts, keys = AUTHORSHIP.read(store), ["sigla_partido", "tema_id"]
    sums = parts.groupBy(*keys, "balde").agg(F.sum("qtd_proposicoes").alias("n"), F.bitmap_or_agg("bits").alias("bits"))
    counts = sums.groupBy(*keys).agg(
        F.sum("n").alias("qtd_proposicoes"), F.coalesce(F.sum(F.when(F.col("balde").isNotNull(), F.bitmap_count("bits"))), F.lit(0)).alias("qtd_deputados_autores"))
    return views.with_theme(counts, {"dim_temas": store.read("dim_temas")})


PARTS = (PROPOSITIONS, VOTINGS, EXPENSES, VOTES, AUTHORSHIP)


def refresh(store: StarStore, parts: tuple[Part, ...] = PARTS) -> dict[str, list[int]]:
    """Refresh after a load, or within one (then tables and views become visible together); the ranges read for each part."""
    return {p.name: p.refresh(store) for p in parts}
