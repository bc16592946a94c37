"""The analytical views.

Each function takes the star tables as a mapping and returns a lazy
DataFrame. Views are unordered unless a limit makes the order part of the
result; ``ordered`` sorts at the edge. Dimension joins carry no hints: Catalyst
broadcasts a dimension below the configured size and otherwise runs a shuffle
join that AQE can split on hot keys.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

Tables = Mapping[str, DataFrame]

# Score weights by kind of proposition.
HEAVY_KINDS = ("PL", "PLP", "PEC", "MPV")
MEDIUM_KINDS = ("PDL", "PLV")
REFERENCE_YEAR = 2026

# Labels and limits.
NO_PARTY = "N/I"
NO_THEME = "Sem tema"
ALL = "Todos"
EXPLORER_LIMIT = 80
SUPPLIER_LIMIT = 50
RECENT_LIMIT = 12
DIGEST_LIMIT = 5
ALERT_DAYS = 30
DIGEST_DAYS = 7

#: Author rows of a task that joins and counts them, about.
TASK_ROWS = 1_000_000


def day(as_of) -> Column:
    """``as_of`` as a date column; None means the current date."""
    return F.current_date() if as_of is None else F.lit(as_of).cast("date")


def ordered(df: DataFrame, column: str, ascending: bool = False) -> DataFrame:
    """Presentation order of a view; descending puts NULLs first."""
    return df.orderBy(F.col(column).asc_nulls_last() if ascending else F.col(column).desc_nulls_first())


def one_row(parts: list[DataFrame]) -> DataFrame:
    """Merge one-row frames with disjoint columns into a single row."""
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return merged.agg(*[F.max(c).alias(c) for c in merged.columns])


def _rows() -> Column:
    return F.count(F.lit(1))


def _total(name: str) -> Column:
    return F.coalesce(F.sum(name), F.lit(0).cast("decimal(12,2)"))


# --- shared joins -------------------------------------------------------------

def _deputies_with_party(t: Tables) -> DataFrame:
    """Deputies with the acronym of their current party (NULL if none)."""
    parties = t["dim_partidos"].select("partido_id", F.col("sigla").alias("sigla_dep"))
    return t["dim_deputados"].select("deputado_id", "nome", "uf", "partido_id").join(parties, "partido_id", "left")


def authors_with_party(t: Tables, *columns: str) -> DataFrame:
    """Bridge rows with ``sigla_partido`` and ``partido``: the party that
    signed, else the party of the deputy who did. Unresolvable authors
    (committees, executive, unknown deputies) are left out."""
    bridge = t["ponte_proposicao_autores"].select(
        "proposicao_id", "deputado_id", F.col("partido_id").alias("_own"), *columns
    )
    deputies = _deputies_with_party(t).select("deputado_id", F.col("partido_id").alias("_dep_id"), "sigla_dep")
    parties = t["dim_partidos"]
    # the deputy's party counts only when it exists in the dimension
    own = parties.select(F.col("partido_id").alias("_own"), F.col("sigla").alias("_own_sigla"))
    joined = bridge.join(deputies, "deputado_id", "left").join(own, "_own", "left")
    dep_id = F.when(F.col("sigla_dep").isNotNull(), F.col("_dep_id"))
    own_id = F.when(F.col("_own_sigla").isNotNull(), F.col("_own"))
    return joined.select(
        "proposicao_id",
        "deputado_id",
        F.coalesce(own_id, dep_id).alias("partido_id"),
        F.coalesce("_own_sigla", "sigla_dep").alias("sigla_partido"),
        *columns,
    ).where(F.col("sigla_partido").isNotNull())


def authors_by_proposition(t: Tables, *columns: str) -> DataFrame:
    """``authors_with_party`` dealt by proposition to tasks of about TASK_ROWS rows.

    Shuffled rows of a few narrow columns take hundreds of times their bytes once they are
    sorted and counted, so tasks are cut by rows (one count of the bridge) instead of bytes."""
    bridge = t["ponte_proposicao_autores"]
    tasks = max(bridge.sparkSession.sparkContext.defaultParallelism, -(-bridge.count() // TASK_ROWS))
    return authors_with_party(t, *columns).repartition(tasks, "proposicao_id")


def _theme_columns(t: Tables) -> DataFrame:
    return t["dim_temas"].select("tema_id", F.col("nome").alias("tema"), "critico")


# --- key figures --------------------------------------------------------------

def kpis(t: Tables) -> DataFrame:
    """17 figures; every table is read once."""
    props, deputies = t["fato_proposicoes"], t["dim_deputados"]
    embedded = F.count("embedding") if "embedding" in props.columns else F.lit(0).cast("bigint")
    by_uf = deputies.groupBy("uf").agg(_rows().alias("n"))
    parts = [
        props.agg(
            _rows().alias("proposicoes"),
            F.count("tema_id").alias("com_tema"),
            F.count("resumo_executivo").alias("com_resumo"),
            embedded.alias("com_embedding"),
            F.count_if("autores_carregados").alias("com_autor"),
            F.min("data_apresentacao").alias("data_min"),
            F.max("data_apresentacao").alias("data_max"),
            F.max("ingested_at").alias("ultima_carga"),
        ),
        by_uf.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("deputados"), F.count("uf").alias("ufs")),
        t["dim_partidos"].agg(_rows().alias("partidos")),
        t["dim_temas"].agg(_rows().alias("temas")),
        t["fato_votacoes"].agg(_rows().alias("votacoes"), F.count_if("votos_carregados").alias("votacoes_com_votos")),
        t["fato_despesas"].agg(_rows().alias("despesas_docs"), _total("valor_liquido").alias("despesas_total")),
        t["fato_votacao_votos"].agg(_rows().alias("votos_nominais")),
    ]
    return one_row(parts).select(
        "proposicoes", "com_tema", "com_resumo", "com_embedding", "com_autor", "deputados", "ufs", "partidos",
        "temas", "votacoes", "despesas_docs", "despesas_total", "data_min", "data_max", "ultima_carga",
        "votacoes_com_votos", "votos_nominais",
    )


def kpis_legacy(t: Tables) -> DataFrame:
    """Earlier 15-column form: ``com_autor`` counts the old author id."""
    by_id = t["fato_proposicoes"].agg(F.count("autor_id").alias("_by_id"))
    return one_row([kpis(t), by_id]).withColumn("com_autor", F.col("_by_id")).drop(
        "_by_id", "votacoes_com_votos", "votos_nominais"
    )


# --- propositions -------------------------------------------------------------

def proposicoes_por_tipo(t: Tables) -> DataFrame:
    return t["fato_proposicoes"].groupBy("tipo").agg(_rows().alias("qtd"))


def proposicoes_por_tema(t: Tables) -> DataFrame:
    """Every theme, also unused ones. The fact is counted before the join."""
    counts = t["fato_proposicoes"].where(F.col("tema_id").isNotNull()).groupBy("tema_id").agg(_rows().alias("qtd"))
    return _theme_columns(t).join(counts, "tema_id", "left").select(
        "tema_id", "tema", "critico", F.coalesce("qtd", F.lit(0)).alias("qtd")
    )


def _series(df: DataFrame, bucket: Column, name: str) -> DataFrame:
    return df.groupBy(bucket.alias(name)).agg(_rows().alias("qtd"))


def _dated(t: Tables) -> DataFrame:
    return t["fato_proposicoes"].where(F.col("data_apresentacao").isNotNull())


def serie_diaria(t: Tables) -> DataFrame:
    return _series(_dated(t), F.col("data_apresentacao"), "dia")


def serie_semanal(t: Tables) -> DataFrame:
    """ISO weeks, named by their Monday."""
    return _series(_dated(t), F.trunc("data_apresentacao", "week"), "semana")


def proposicoes_por_ano(t: Tables) -> DataFrame:
    return _series(_dated(t), F.year("data_apresentacao"), "ano")


def proposicoes_score(t: Tables, ref_year: int = REFERENCE_YEAR) -> DataFrame:
    """Relevance: kind + critical theme + recency + an existing vote."""
    voted = t["fato_votacoes"].where(F.col("proposicao_id").isNotNull()).select("proposicao_id").distinct()
    voted = voted.withColumn("_voted", F.lit(True))
    year = F.year("data_apresentacao")
    kind = F.when(F.col("tipo").isin(*HEAVY_KINDS), 3).when(F.col("tipo").isin(*MEDIUM_KINDS), 2).otherwise(1)
    theme = F.when(F.col("critico"), 3).otherwise(1)
    recency = (
        F.when(year >= ref_year, 4.0).when(year == ref_year - 1, 3.0).when(year == ref_year - 2, 2.0)
        .when(year >= ref_year - 4, 1.0).otherwise(0.5)
    )
    vote = F.when(F.col("_voted"), 2).otherwise(0)
    rows = t["fato_proposicoes"].join(_theme_columns(t), "tema_id", "left").join(voted, "proposicao_id", "left")
    return rows.select(
        "proposicao_id", "tipo", "data_apresentacao", "ementa", "resumo_executivo", "tema",
        F.coalesce("critico", F.lit(False)).alias("critico"),
        (kind + theme + recency + vote).cast("decimal(4,1)").alias("score_relevancia"),
    )


def score_without_votes(t: Tables, ref_year: int = REFERENCE_YEAR) -> DataFrame:
    """Variant of the score that leaves the vote term out."""
    return proposicoes_score({**t, "fato_votacoes": t["fato_votacoes"].limit(0)}, ref_year)


def _choice(value: str | None) -> str | None:
    value = value.strip() if value else None
    return None if not value or value == ALL else value


def proposicoes_enriquecidas(
    t: Tables, tema: str | None = None, tipo: str | None = None, busca: str | None = None,
    limit: int = EXPLORER_LIMIT, ref_year: int = REFERENCE_YEAR,
) -> DataFrame:
    """Explorer: optional filters ('Todos' or blank is no filter), wildcards
    in the search text are live, best score first, undated before dated."""
    rows = proposicoes_score(t, ref_year).where(F.col("resumo_executivo").isNotNull())
    tema, tipo = _choice(tema), _choice(tipo)
    busca = busca.strip() if busca and busca.strip() else None
    if tema is not None:
        rows = rows.where(F.col("tema") == tema)
    if tipo is not None:
        rows = rows.where(F.col("tipo") == tipo)
    if busca is not None:
        pattern = f"%{busca}%"
        rows = rows.where(F.col("ementa").ilike(pattern) | F.col("resumo_executivo").ilike(pattern))
    top = rows.orderBy(
        F.desc("score_relevancia"), F.col("data_apresentacao").desc_nulls_first(), F.col("proposicao_id")
    ).limit(limit)
    return top.select(
        "proposicao_id", "tipo", "data_apresentacao", "tema", "critico", "ementa", "resumo_executivo",
        F.col("score_relevancia").alias("score"),
    )


# --- deputies, parties, authorship ---------------------------------------------

def deputados_por_partido(t: Tables) -> DataFrame:
    counts = t["dim_deputados"].where(F.col("partido_id").isNotNull()).groupBy("partido_id").agg(
        _rows().alias("deputados")
    )
    return t["dim_partidos"].select("partido_id", "sigla", "nome").join(counts, "partido_id", "left").select(
        "partido_id", "sigla", "nome", F.coalesce("deputados", F.lit(0)).alias("deputados")
    )


def deputados_por_uf(t: Tables) -> DataFrame:
    return t["dim_deputados"].groupBy("uf").agg(_rows().alias("deputados"))


def proposicoes_por_partido_autor(t: Tables) -> DataFrame:
    rows = authors_with_party(t)
    return rows.groupBy(F.col("sigla_partido").alias("sigla")).agg(F.count_distinct("proposicao_id").alias("qtd"))


def proposicoes_por_partido_autor_legacy(t: Tables) -> DataFrame:
    """Earlier form over the single author id of a proposition."""
    per_author = t["fato_proposicoes"].where(F.col("autor_id").isNotNull()).groupBy("autor_id").agg(_rows().alias("n"))
    rows = per_author.join(_deputies_with_party(t), F.col("autor_id") == F.col("deputado_id"))
    return rows.groupBy(F.col("sigla_dep").alias("sigla")).agg(F.sum("n").alias("qtd"))


def top_deputados_autoria(t: Tables) -> DataFrame:
    """Distinct propositions per deputy, counted before the dimension join."""
    pairs = t["ponte_proposicao_autores"].where(F.col("deputado_id").isNotNull())
    counts = pairs.groupBy("deputado_id").agg(F.count_distinct("proposicao_id").alias("proposicoes"))
    return counts.join(_deputies_with_party(t), "deputado_id").select(
        "deputado_id", "nome", F.col("sigla_dep").alias("partido"), "uf", "proposicoes"
    )


def top_deputados_autoria_legacy(t: Tables) -> DataFrame:
    """Earlier form over the single author id of a proposition."""
    counts = t["fato_proposicoes"].where(F.col("autor_id").isNotNull()).groupBy("autor_id").agg(
        _rows().alias("proposicoes")
    )
    return counts.join(_deputies_with_party(t), F.col("autor_id") == F.col("deputado_id")).select(
        "deputado_id", "nome", F.col("sigla_dep").alias("partido"), "uf", "proposicoes"
    )


def _two_distinct(rows: DataFrame, keys: list[str], first: str, second: str, names: tuple[str, str], total: str | None = None) -> DataFrame:
    """Distinct values of two columns per key, and the sum of ``total``.

    Two distinct counts in one aggregate would expand every row into two. Here the
    rows collapse once for each column to distinct (key, value), whose count is a plain
    one, and the few counted rows meet in a join. Neither side holds the distinct
    (key, first, second): a task's aggregates are those of one value."""
    sums = [F.sum(total).alias(total)] if total else []
    one = rows.groupBy(*keys, first).agg(*(sums or [_rows().alias("_n")])).groupBy(*keys).agg(
        F.count(first).alias(names[0]), *sums)
    two = rows.groupBy(*keys, second).agg(F.count(F.lit(1)).alias("_n")).groupBy(
        *[F.col(k).alias(f"_{k}") for k in keys]).agg(F.count(second).alias(names[1]))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return one.join(two, same).drop(*[f"_{k}" for k in keys])


def heatmap_tema_partido(t: Tables) -> DataFrame:
    facts = t["fato_proposicoes"].select("proposicao_id", "tema_id")
    rows = authors_by_proposition(t).join(facts, "proposicao_id")
    # counted per theme id first: the theme names join a handful of rows
    counts = _two_distinct(rows, ["sigla_partido", "tema_id"], "proposicao_id", "deputado_id",
                           ("qtd_proposicoes", "qtd_deputados_autores"))
    return with_theme(counts, t)


def with_theme(counts: DataFrame, t: Tables) -> DataFrame:
    """Cells of the heatmap with the names of their themes."""
    return counts.join(_theme_columns(t), "tema_id", "left").select(
        "sigla_partido",
        F.coalesce("tema", F.lit(NO_THEME)).alias("tema"),
        "tema_id",
        F.coalesce("critico", F.lit(False)).alias("critico"),
        "qtd_proposicoes",
        "qtd_deputados_autores",
    )


def proposicoes_por_deputado(t: Tables) -> DataFrame:
    """Authorship per deputy. Duplicate (deputy, proposition) rows collapse
    before the join, and themes are grouped before they are counted, so no
    distinct aggregate multiplies the rows."""
    pairs = t["ponte_proposicao_autores"].where(F.col("deputado_id").isNotNull()).groupBy(
        "deputado_id", "proposicao_id"
    ).agg(F.count_if("proponente").alias("n"))
    facts = t["fato_proposicoes"].select("proposicao_id", "tema_id")
    per_theme = pairs.join(facts, "proposicao_id").groupBy("deputado_id", "tema_id").agg(
        _rows().alias("p"), F.sum("n").alias("n")
    )
    counts = per_theme.groupBy("deputado_id").agg(
        F.sum("p").alias("qtd_proposicoes"),
        F.count("tema_id").alias("qtd_temas"),
        F.sum("n").alias("qtd_como_proponente"),
    )
    return counts.join(_deputies_with_party(t), "deputado_id").select(
        "deputado_id", F.col("nome").alias("deputado"), F.col("sigla_dep").alias("sigla_partido"), "uf",
        "qtd_proposicoes", "qtd_temas", "qtd_como_proponente",
    )


def proposicoes_por_partido(t: Tables) -> DataFrame:
    known = t["fato_proposicoes"].select("proposicao_id")
    rows = authors_by_proposition(t, "proponente").join(known, "proposicao_id")
    signed = rows.withColumn("qtd_proponente", F.coalesce(F.col("proponente").cast("long"), F.lit(0)))
    return _two_distinct(signed, ["partido_id", "sigla_partido"], "proposicao_id", "deputado_id",
                         ("qtd_proposicoes", "qtd_deputados_autores"), "qtd_proponente")


# --- expenses -----------------------------------------------------------------

def _spend_per_deputy(t: Tables) -> DataFrame:
    """Spend per deputy before any join: the fact is never joined row by row."""
    return t["fato_despesas"].groupBy("deputado_id").agg(F.sum("valor_liquido").alias("s"), _rows().alias("n"))


def despesas_por_partido(t: Tables) -> DataFrame:
    rows = _spend_per_deputy(t).join(_deputies_with_party(t), "deputado_id")
    return rows.groupBy(F.col("sigla_dep").alias("sigla")).agg(_total("s").alias("total"), F.sum("n").alias("docs"))


def despesas_por_categoria(t: Tables) -> DataFrame:
    return t["fato_despesas"].groupBy(F.col("tipo_despesa").alias("categoria")).agg(
        _total("valor_liquido").alias("total"), _rows().alias("docs")
    )


def top_deputados_despesa(t: Tables) -> DataFrame:
    return _spend_per_deputy(t).join(_deputies_with_party(t), "deputado_id").select(
        "deputado_id", "nome", F.col("sigla_dep").alias("partido"), "uf",
        F.coalesce("s", F.lit(0).cast("decimal(12,2)")).alias("total"), F.col("n").alias("docs"),
    )


def despesas_serie_mensal(t: Tables) -> DataFrame:
    return t["fato_despesas"].groupBy("ano", "mes").agg(_total("valor_liquido").alias("total"), _rows().alias("docs"))


def top_fornecedores(t: Tables, limit: int = SUPPLIER_LIMIT) -> DataFrame:
    rows = t["fato_despesas"].where(F.col("fornecedor_nome").isNotNull())
    totals = rows.groupBy("fornecedor_nome", "fornecedor_cnpj").agg(
        _total("valor_liquido").alias("total"), _rows().alias("docs")
    )
    return totals.orderBy(F.desc("total"), "fornecedor_nome", F.col("fornecedor_cnpj").asc_nulls_first()).limit(limit)


# --- votes --------------------------------------------------------------------

def votacoes_resumo(t: Tables) -> DataFrame:
    """One pass, grouped by body first so that the distinct count is a count."""
    votes = t["fato_votacoes"]
    counted = F.sum("qtd_votos") if "qtd_votos" in votes.columns else F.lit(0).cast("bigint")
    per_body = votes.groupBy("orgao").agg(
        _rows().alias("total"),
        F.count_if("aprovacao").alias("aprovadas"),
        F.count_if(~F.col("aprovacao")).alias("reprovadas"),
        F.count_if(F.col("aprovacao").isNull()).alias("sem_resultado"),
        F.count("proposicao_id").alias("com_proposicao"),
        F.min("data").alias("data_min"),
        F.max("data").alias("data_max"),
        F.count_if("votos_carregados").alias("com_votos"),
        counted.alias("votos_nominais"),
    )
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    return per_body.agg(
        total("total"), total("aprovadas"), total("reprovadas"), total("sem_resultado"),
        F.count("orgao").alias("orgaos"),
        total("com_proposicao"),
        F.min("data_min").cast("date").alias("data_min"),
        F.max("data_max").cast("date").alias("data_max"),
        total("com_votos"), total("votos_nominais"),
    )


def votacoes_por_orgao(t: Tables) -> DataFrame:
    return t["fato_votacoes"].groupBy("orgao").agg(_rows().alias("qtd"), F.count_if("aprovacao").alias("aprovadas"))


def votacoes_serie(t: Tables) -> DataFrame:
    return _series(t["fato_votacoes"], F.to_date("data"), "dia")


def votos_partido_tema(t: Tables) -> DataFrame:
    """Single votes by party at vote time (else current party), theme, choice."""
    facts = t["fato_proposicoes"].select("proposicao_id", "tema_id")
    themes = _theme_columns(t).select("tema_id", "tema")
    votings = t["fato_votacoes"].select("votacao_id", "proposicao_id").join(facts, "proposicao_id", "left").join(
        themes, "tema_id", "left"
    ).select("votacao_id", F.coalesce("tema", F.lit(NO_THEME)).alias("tema"))
    deputies = _deputies_with_party(t).select("deputado_id", "sigla_dep")
    votes = t["fato_votacao_votos"].select("votacao_id", "deputado_id", "tipo_voto", "sigla_partido_voto")
    rows = votes.join(votings, "votacao_id").join(deputies, "deputado_id", "left")
    party = F.coalesce("sigla_partido_voto", "sigla_dep", F.lit(NO_PARTY))
    labelled = rows.select(party.alias("sigla_partido"), "tema", "tipo_voto", "deputado_id", "votacao_id", F.lit(1).cast("long").alias("qtd_votos"))
    return _two_distinct(labelled, ["sigla_partido", "tema", "tipo_voto"], "votacao_id", "deputado_id",
                         ("qtd_votacoes", "qtd_deputados"), "qtd_votos").select(
        "sigla_partido", "tema", "tipo_voto", "qtd_votos", "qtd_deputados", "qtd_votacoes")


def votos_por_partido(t: Tables) -> DataFrame:
    """Choices per party at vote time; the current party is never used. Rows
    collapse per deputy first, so the distinct count is a count."""
    choice = F.col("tipo_voto")
    per_deputy = t["fato_votacao_votos"].groupBy(
        F.coalesce("sigla_partido_voto", F.lit(NO_PARTY)).alias("sigla"), "deputado_id"
    ).agg(
        _rows().alias("q"),
        F.count_if(choice.ilike("sim%")).alias("s"),
        F.count_if(choice.ilike("nao%") | choice.ilike("não%")).alias("n"),
    )
    return per_deputy.groupBy("sigla").agg(
        F.sum("q").alias("qtd_votos"), F.sum("s").alias("sim"), F.sum("n").alias("nao"),
        F.count("deputado_id").alias("qtd_deputados"),
    )


# --- alerts, quality, digest ----------------------------------------------------

def _critical(t: Tables) -> DataFrame:
    themes = _theme_columns(t).where("critico").select("tema_id", "tema")
    return t["fato_proposicoes"].join(themes, "tema_id").select(
        "proposicao_id", "tipo", "data_apresentacao", "tema", "ementa"
    )


def alertas_criticas_recentes(t: Tables, as_of=None, days: int = ALERT_DAYS) -> DataFrame:
    return _critical(t).where(F.col("data_apresentacao") >= F.date_sub(day(as_of), days))


def criticas_recentes(t: Tables, limit: int = RECENT_LIMIT) -> DataFrame:
    """Latest critical propositions; undated ones come first."""
    return _critical(t).orderBy(F.col("data_apresentacao").desc_nulls_first(), "proposicao_id").limit(limit)


def data_quality(t: Tables) -> DataFrame:
    """Five gaps, one pass per table."""
    props = t["fato_proposicoes"].agg(
        _rows().alias("t"),
        F.count_if(F.col("tema_id").isNull()).alias("tema"),
        F.count_if(F.col("resumo_executivo").isNull()).alias("resumo"),
        F.count_if(~F.col("autores_carregados")).alias("autor"),
    ).select(F.expr(
        "stack(3, 'proposicoes_sem_tema', tema, t, 'proposicoes_sem_resumo', resumo, t,"
        " 'proposicoes_sem_autor', autor, t) as (metrica, valor, total)"
    ))
    votes = t["fato_votacoes"].agg(
        _rows().alias("t"),
        F.count_if(F.col("proposicao_id").isNull()).alias("proposicao"),
        F.count_if(~F.col("votos_carregados")).alias("votos"),
    ).select(F.expr(
        "stack(2, 'votacoes_sem_proposicao', proposicao, t, 'votacoes_sem_votos', votos, t)"
        " as (metrica, valor, total)"
    ))
    return props.unionByName(votes)


def digest(t: Tables, as_of=None, days: int = DIGEST_DAYS, limit: int = DIGEST_LIMIT) -> DataFrame:
    """Weekly top 5: critical first, then most authors, then newest; the id
    decides what is left open."""
    columns = [c for c in ("autor_principal_nome",) if c in t["fato_proposicoes"].columns]
    recent = t["fato_proposicoes"].where(F.col("data_apresentacao") >= F.date_sub(day(as_of), days))
    rows = recent.join(_theme_columns(t), "tema_id", "left").select(
        "proposicao_id", "tipo", "ementa", "resumo_executivo", "qtd_autores", *columns,
        "data_apresentacao", "tema", "critico",
    )
    return rows.orderBy(
        F.coalesce("critico", F.lit(False)).desc(),
        F.coalesce("qtd_autores", F.lit(0)).desc(),
        F.col("data_apresentacao").desc(),
        "proposicao_id",
    ).limit(limit)


def top_temas(t: Tables, limit: int = DIGEST_LIMIT) -> DataFrame:
    """Themes with most propositions (unused themes do not appear)."""
    used = proposicoes_por_tema(t).where(F.col("qtd") > 0).select("tema", "qtd", "tema_id")
    return used.orderBy(F.desc("qtd"), "tema_id").limit(limit).select("tema", "qtd")


def enrichment_coverage(t: Tables) -> DataFrame:
    props = t["fato_proposicoes"]
    embedded = F.count("embedding") if "embedding" in props.columns else F.lit(0).cast("bigint")
    return props.agg(
        _rows().alias("total"), embedded.alias("com_embedding"), F.count("tema_id").alias("com_tema"),
        F.count("resumo_executivo").alias("com_resumo"),
    )
