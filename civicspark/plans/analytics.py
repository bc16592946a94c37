"""Figures derived from the views: matrices, shares, funnels, rankings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import formats
from ..functions.coerce import to_number
from . import views
from .views import Tables

# How many entries each chart shows, and card texts.
MATRIX_PARTIES = 12
MATRIX_THEMES = 8
RADAR_THEMES = 8
ACTIVE_DAYS = 30
SLICES = {
    "orgaos": 10, "votos_partido": 14, "partido_autor": 14, "bancada": 14, "ufs": 16,
    "despesa_partido": 12, "deputados": 10, "tipos": 12,
}
BADGE_CRITICAL = "Critico"
BADGE_GENERAL = "Geral"
CARD_NO_THEME = "Sem tema classificado"
CARD_NO_AUTHORS = "autoria nao carregada"
CARD_NO_SUMMARY = "Resumo por IA ainda nao gerado."


def _rows_of(df: DataFrame, entries: list[tuple[str, Column]], name: str, value: str) -> DataFrame:
    """One-row frame -> (name, value) rows."""
    cols = [v.cast("bigint").alias(f"_c{i}") for i, (_, v) in enumerate(entries)]
    pairs = ", ".join(f"'{label}', _c{i}" for i, (label, _) in enumerate(entries))
    return df.select(*cols).select(F.expr(f"stack({len(entries)}, {pairs}) as ({name}, {value})"))


def top_slice(df: DataFrame, by: str, n: int, *ties: str) -> DataFrame:
    """First n rows of a ranking; ``ties`` fixes the order of equal values."""
    return df.orderBy(F.col(by).desc_nulls_first(), *[F.col(c).asc_nulls_first() for c in ties]).limit(n)


def heatmap_matrix(t: Tables, parties: int = MATRIX_PARTIES, themes: int = MATRIX_THEMES) -> DataFrame:
    """Long matrix of the biggest parties and themes; empty cells are 0 and
    intensity is relative to the biggest cell of the whole heatmap. The grid
    is built per party from the theme list, not by joining all pairs."""
    # a theme name may span several theme ids; the last cell wins in no order,
    # so cells of one name are summed here
    cells = views.heatmap_tema_partido(t).groupBy("sigla_partido", "tema").agg(
        F.sum("qtd_proposicoes").alias("qtd")
    )
    totals = lambda key: cells.groupBy(key).agg(F.sum("qtd").alias("_t"))
    rows = top_slice(totals("sigla_partido"), "_t", parties, "sigla_partido").select("sigla_partido")
    names = top_slice(totals("tema"), "_t", themes, "tema").agg(F.collect_list("tema")).scalar()
    largest = cells.agg(F.greatest(F.lit(1), F.coalesce(F.max("qtd"), F.lit(0)))).scalar()
    grid = rows.select("sigla_partido", F.explode(names).alias("tema"))
    return grid.join(cells, ["sigla_partido", "tema"], "left").select(
        "sigla_partido", "tema", F.coalesce("qtd", F.lit(0)).alias("qtd"),
        (F.coalesce("qtd", F.lit(0)) / largest).alias("intensidade"),
    )


def heatmap_wide(t: Tables, names: list[str]) -> DataFrame:
    """Party rows with one column per given theme."""
    cells = views.heatmap_tema_partido(t)
    return cells.groupBy("sigla_partido").pivot("tema", names).agg(F.sum("qtd_proposicoes")).na.fill(0)


def theme_ranking(t: Tables, only_critical: bool = False) -> DataFrame:
    """Bar share of each theme relative to the biggest of all themes."""
    themes = views.proposicoes_por_tema(t)
    largest = themes.agg(F.greatest(F.lit(1), F.coalesce(F.max("qtd"), F.lit(0)))).scalar()
    shown = themes.where("critico") if only_critical else themes
    return shown.select("tema_id", "tema", "critico", "qtd", (F.col("qtd") / largest).alias("fatia"))


def theme_highlights(t: Tables) -> DataFrame:
    """Dominant theme, leading critical theme, critical total and its share of
    the classified propositions, backlog."""
    rank = F.struct("qtd", -F.col("tema_id"))
    lead = lambda cond: F.max_by(F.struct("tema", "qtd"), F.when(cond, rank))
    themes = views.proposicoes_por_tema(t).agg(
        lead(F.lit(True)).alias("d"), lead(F.col("critico")).alias("c"),
        F.coalesce(F.sum(F.when(F.col("critico"), F.col("qtd"))), F.lit(0)).alias("criticas_total"),
    ).select(
        F.col("d.tema").alias("dominante"), F.col("d.qtd").alias("dominante_qtd"),
        F.col("c.tema").alias("critico_lider"), F.col("c.qtd").alias("critico_lider_qtd"), "criticas_total",
    )
    base = views.enrichment_coverage(t).select("total", "com_tema")
    merged = views.one_row([themes, base])
    classified = F.greatest(F.col("com_tema"), F.lit(1))
    return merged.select(
        "dominante", "dominante_qtd", "critico_lider", "critico_lider_qtd", "criticas_total",
        formats.pct(F.col("criticas_total"), classified).alias("criticas_pct"),
        F.greatest(F.lit(0), F.col("total") - F.col("com_tema")).alias("sem_classificacao"),
    )


def radar(t: Tables, limit: int = RADAR_THEMES) -> DataFrame:
    """First word of the biggest themes."""
    top = top_slice(views.proposicoes_por_tema(t), "qtd", limit, "tema_id")
    return top.select("tema_id", F.split("tema", " ")[0].alias("tema"), "qtd")


def enrichment_funnel(t: Tables) -> DataFrame:
    row = views.enrichment_coverage(t)
    gap = lambda a, b: F.greatest(F.lit(0), F.col(a) - F.col(b))
    return _rows_of(row, [
        ("Classificadas", F.col("com_tema")),
        ("Resumidas (sem tema)", gap("com_resumo", "com_tema")),
        ("Pendentes", gap("total", "com_resumo")),
    ], "etapa", "qtd")


def coverage_split(t: Tables) -> DataFrame:
    row = views.enrichment_coverage(t)
    return _rows_of(row, [
        ("Enriquecidas", F.col("com_resumo")),
        ("Pendentes", F.greatest(F.lit(0), F.col("total") - F.col("com_resumo"))),
    ], "situacao", "qtd")


def active_days(t: Tables, days: int = ACTIVE_DAYS) -> DataFrame:
    """The latest days with activity, marking the first peak."""
    recent = views.serie_diaria(t).orderBy(F.desc("dia")).limit(days)
    peak = recent.agg(F.max_by("dia", F.struct("qtd", -F.unix_date("dia")))).scalar()
    return recent.select("dia", F.col("qtd"), (F.col("dia") == peak).alias("pico"))


def approval_split(t: Tables) -> DataFrame:
    row = views.votacoes_resumo(t)
    entries = [("Aprovadas", "aprovadas"), ("Reprovadas", "reprovadas"), ("Sem resultado", "sem_resultado")]
    pairs = ", ".join(f"'{label}', {c}, total" for label, c in entries)
    long = row.select(F.expr(f"stack(3, {pairs}) as (resultado, qtd, total)"))
    return long.select("resultado", "qtd", formats.pct(F.col("qtd"), F.col("total")).alias("pct"))


def backlog(t: Tables) -> DataFrame:
    row = views.enrichment_coverage(t)
    return row.select(
        F.greatest(F.lit(0), F.col("total") - F.col("com_tema")).alias("sem_tema"),
        F.greatest(F.lit(0), F.col("total") - F.col("com_resumo")).alias("sem_resumo"),
    )


def options(df: DataFrame, column: str) -> DataFrame:
    """Choice list: 'Todos' plus the distinct values."""
    values = df.where(F.col(column).isNotNull()).select(F.col(column).alias("opcao")).distinct()
    head = df.sparkSession.range(1).select(F.lit(views.ALL).alias("opcao"))
    return head.unionByName(values)


def coerced(df: DataFrame, columns: list[str]) -> DataFrame:
    """Display numbers: NULL, NaN and unparsable values become 0."""
    return df.withColumns({c: to_number(F.col(c)) for c in columns})


def quality_map(t: Tables) -> DataFrame:
    """One row with a map metric -> (valor, total); five entries."""
    entries = F.collect_list(F.struct("metrica", F.struct("valor", "total")))
    return views.data_quality(t).agg(F.map_from_entries(entries).alias("qualidade"))


def digest_cards(t: Tables, as_of=None, **options_) -> DataFrame:
    """Card fields of the weekly digest, ranked."""
    rows = views.digest(t, as_of, **options_)
    # at most a handful of rows: the digest is already limited
    order = (
        F.coalesce("critico", F.lit(False)).desc(), F.coalesce("qtd_autores", F.lit(0)).desc(),
        F.col("data_apresentacao").desc(), F.col("proposicao_id"),
    )
    position = F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(*order))
    many = F.concat(F.col("qtd_autores").cast("string"), F.lit(" autor(es)"))
    authors = F.when(F.col("qtd_autores") > 0, many).otherwise(F.lit(CARD_NO_AUTHORS))
    if "autor_principal_nome" in rows.columns:
        main = F.coalesce(F.concat(F.lit(" · "), F.nullif("autor_principal_nome", F.lit(""))), F.lit(""))
        authors = F.concat(authors, main)
    return rows.select(
        position.alias("posicao"),
        F.when(F.col("critico"), F.lit(BADGE_CRITICAL)).otherwise(F.lit(BADGE_GENERAL)).alias("selo"),
        F.coalesce(F.nullif("tema", F.lit("")), F.lit(CARD_NO_THEME)).alias("tema"),
        authors.alias("autoria"),
        F.concat_ws(" ", "tipo", F.col("proposicao_id").cast("string")).alias("titulo"),
        F.coalesce("ementa", F.lit("")).alias("ementa"),
        F.coalesce(F.nullif("resumo_executivo", F.lit("")), F.lit(CARD_NO_SUMMARY)).alias("resumo"),
    )
