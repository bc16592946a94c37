"""Open research questions over the star tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from . import views
from .views import Tables


def _choices(t: Tables) -> DataFrame:
    """Votes with a choice and a party, equal rows collapsed and counted."""
    votes = t["fato_votacao_votos"].where(F.col("tipo_voto").isNotNull() & F.col("sigla_partido_voto").isNotNull())
    return votes.groupBy("votacao_id", "sigla_partido_voto", "deputado_id", "tipo_voto").agg(
        F.count(F.lit(1)).alias("n")
    )


def _majorities(choices: DataFrame) -> DataFrame:
    per_choice = choices.groupBy("votacao_id", "sigla_partido_voto", "tipo_voto").agg(F.sum("n").alias("n"))
    return per_choice.groupBy("votacao_id", "sigla_partido_voto").agg(
        F.sum("n").alias("votos"),
        F.max("n").alias("maioria"),
        # equal choices: the alphabetically first one is the majority
        F.min_by("tipo_voto", F.struct(-F.col("n"), F.col("tipo_voto"))).alias("voto_maioria"),
    ).withColumn("coesao", F.col("maioria") / F.col("votos"))


def party_cohesion(t: Tables) -> DataFrame:
    """Per vote and party: voters, size of the majority choice, its share.
    Votes without a choice or party do not count."""
    return _majorities(_choices(t))


def cohesion_per_party(t: Tables) -> DataFrame:
    return party_cohesion(t).groupBy(F.col("sigla_partido_voto").alias("sigla")).agg(
        F.count(F.lit(1)).alias("votacoes"),
        F.sum("votos").alias("votos"),
        (F.sum("maioria") / F.sum("votos")).alias("coesao"),
    )


def deputy_loyalty(t: Tables) -> DataFrame:
    """Share of a deputy's votes that follow the party majority. Both sides of
    the join start from the same collapsed votes, so the fact is read and
    shuffled once; AQE splits a hot (vote, party) in the join."""
    keys = ["votacao_id", "sigla_partido_voto"]
    mine = _choices(t)
    line = _majorities(mine).select(*keys, "voto_maioria")
    same = F.when(F.col("tipo_voto") == F.col("voto_maioria"), F.col("n")).otherwise(0)
    return mine.join(line, keys).groupBy("deputado_id").agg(
        F.sum("n").alias("votos"),
        F.sum(same).alias("com_partido"),
    ).withColumn("fidelidade", F.col("com_partido") / F.col("votos"))


def themes_per_week(t: Tables) -> DataFrame:
    rows = t["fato_proposicoes"].where(F.col("data_apresentacao").isNotNull())
    counts = rows.groupBy(F.trunc("data_apresentacao", "week").alias("semana"), "tema_id").agg(
        F.count(F.lit(1)).alias("qtd")
    )
    names = t["dim_temas"].select("tema_id", F.col("nome").alias("tema"))
    return counts.join(names, "tema_id", "left").select(
        "semana", F.coalesce("tema", F.lit(views.NO_THEME)).alias("tema"), "qtd"
    )


def top_authors_of_month(t: Tables, as_of=None, limit: int = 10) -> DataFrame:
    """Authors of most propositions presented in the month of ``as_of``."""
    month = F.trunc(views.day(as_of), "month")
    recent = t["fato_proposicoes"].where(
        (F.col("data_apresentacao") >= month) & (F.col("data_apresentacao") < F.add_months(month, 1))
    ).select("proposicao_id")
    bridge = t["ponte_proposicao_autores"].join(recent, "proposicao_id", "left_semi")
    top = views.top_deputados_autoria({**t, "ponte_proposicao_autores": bridge})
    return top.orderBy(F.desc("proposicoes"), "deputado_id").limit(limit)


def days_to_archive(proposicoes: DataFrame, steps: DataFrame, archived: str = "Arquivada") -> DataFrame:
    """Mean days from presentation to the first archiving step, per kind.
    ``steps`` has proposicao_id, data (timestamp) and situacao."""
    first = steps.where(F.col("situacao") == archived).groupBy("proposicao_id").agg(
        F.min(F.to_date("data")).alias("arquivada_em")
    )
    rows = proposicoes.where(F.col("data_apresentacao").isNotNull()).select(
        "proposicao_id", "tipo", "data_apresentacao"
    ).join(first, "proposicao_id")
    wait = F.datediff("arquivada_em", "data_apresentacao")
    return rows.groupBy("tipo").agg(F.count(F.lit(1)).alias("arquivadas"), F.avg(wait).alias("dias_medios"))
