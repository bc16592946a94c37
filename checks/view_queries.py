"""Views, derived figures and research questions with their oracles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from civicspark.operators import text_index, upsert as ups
from civicspark.plans import analytics as A, research as R, rollup, views as V
from civicspark.session import scratch_path
from civicspark.sources import store
from civicspark.sources.store import StarStore
from civicspark.streaming import refresh

from . import standins
from .registry import query, view
from .standins import AS_OF, REF_YEAR, load, table, tables

# Deputies with the label of their party, and bridge rows with the party that counts: the author's own, else the deputy's.
_BENCH = "SELECT * FROM dim_deputados LEFT JOIN (SELECT partido_id, sigla FROM dim_partidos) USING (partido_id)"
_AUTHORED = """SELECT b.proposicao_id, b.deputado_id, b.proponente,
      CASE WHEN own.sigla IS NULL THEN via.sigla ELSE own.sigla END AS sigla,
      CASE WHEN own.partido_id IS NULL THEN via.partido_id ELSE own.partido_id END AS partido_id
    FROM ponte_proposicao_autores b
    LEFT JOIN dim_partidos own USING (partido_id)
    LEFT JOIN (SELECT deputado_id, partido_id, sigla FROM dim_deputados JOIN dim_partidos USING (partido_id)) via
      ON via.deputado_id = b.deputado_id"""

_KPI_FACTS = """SELECT count(*) AS proposicoes, count(tema_id) AS com_tema, count(resumo_executivo) AS com_resumo,
      count(embedding) AS com_embedding, {author} AS com_autor, min(data_apresentacao) AS data_min,
      max(data_apresentacao) AS data_max, max(ingested_at) AS ultima_carga FROM fato_proposicoes"""
_KPI_SPEND = "SELECT count(*) AS despesas_docs, coalesce(sum(valor_liquido), 0)::DOUBLE AS despesas_total FROM fato_despesas"
_KPI_BENCH = "SELECT count(*) AS deputados, count(DISTINCT uf) AS ufs FROM dim_deputados"


def _kpis(author: str, votes: str) -> str:
    """One row out of one aggregate for each table."""
    parts = [_KPI_FACTS.format(author=author), _KPI_BENCH, _KPI_SPEND, "SELECT count(*) AS partidos FROM dim_partidos",
             "SELECT count(*) AS temas FROM dim_temas", f"SELECT count(*) AS votacoes{votes} FROM fato_votacoes"]
    return "SELECT * FROM " + " CROSS JOIN ".join(f"({part})" for part in parts)


view("v1_kpis", V.kpis, _kpis(
    "count(*) FILTER (WHERE autores_carregados)",
    ", count(*) FILTER (WHERE votos_carregados) AS votacoes_com_votos, (SELECT count(*) FROM fato_votacao_votos) AS votos_nominais"))
view("v1_kpis_legacy", V.kpis_legacy, _kpis("count(autor_id)", ""))

view("v2_proposicoes_por_tipo", V.proposicoes_por_tipo,
     "SELECT tipo, count(*) AS qtd FROM fato_proposicoes GROUP BY tipo")

_THEMES = """SELECT t.tema_id, t.nome AS tema, t.critico, count(p.proposicao_id) AS qtd
    FROM dim_temas t LEFT JOIN fato_proposicoes p ON p.tema_id = t.tema_id GROUP BY t.tema_id, t.nome, t.critico"""
view("v3_proposicoes_por_tema", V.proposicoes_por_tema, _THEMES)

view("v4_serie_diaria", V.serie_diaria, """
    SELECT data_apresentacao AS dia, count(*) AS qtd FROM fato_proposicoes
    WHERE data_apresentacao IS NOT NULL GROUP BY 1""")
view("v5_serie_semanal", V.serie_semanal, """
    SELECT CAST(date_trunc('week', data_apresentacao) AS DATE) AS semana, count(*) AS qtd FROM fato_proposicoes
    WHERE data_apresentacao IS NOT NULL GROUP BY 1""")
view("v6_proposicoes_por_ano", V.proposicoes_por_ano, """
    SELECT CAST(extract(year FROM data_apresentacao) AS INT) AS ano, count(*) AS qtd FROM fato_proposicoes
    WHERE data_apresentacao IS NOT NULL GROUP BY 1""")


def _score(vote_points: int) -> str:
    """Points from lookup lists: kind of text, theme, age in years, voted on."""
    return f"""SELECT proposicao_id, tipo, data_apresentacao, ementa, resumo_executivo, tema, coalesce(critico, FALSE) AS critico,
      (coalesce(peso, 1) + if(critico, 3, 1) + if(proposicao_id IN (SELECT proposicao_id FROM fato_votacoes WHERE proposicao_id > -1), {vote_points}, 0)
       + CASE WHEN idade <= 0 THEN 4 WHEN idade <= 4 THEN [3, 2, 1, 1][idade] ELSE 0.5 END)::DOUBLE AS score_relevancia
    FROM (SELECT *, {REF_YEAR} - year(data_apresentacao) AS idade FROM fato_proposicoes)
    LEFT JOIN (SELECT tema_id, nome AS tema, critico FROM dim_temas) USING (tema_id)
    LEFT JOIN (VALUES ('PL', 3), ('PLP', 3), ('PEC', 3), ('MPV', 3), ('PDL', 2), ('PLV', 2)) w(tipo, peso) USING (tipo)"""


_SCORE = _score(2)
view("v7_proposicoes_score", V.proposicoes_score, _SCORE, ref_year=REF_YEAR)
view("v7_score_sem_votos", V.score_without_votes, _score(0), ref_year=REF_YEAR)

view("v8_enriquecidas", V.proposicoes_enriquecidas, f"""
    SELECT proposicao_id, tipo, data_apresentacao, tema, critico, ementa, resumo_executivo, score_relevancia AS score
    FROM ({_SCORE}) s WHERE resumo_executivo IS NOT NULL
    ORDER BY score_relevancia DESC, data_apresentacao DESC NULLS FIRST, proposicao_id LIMIT 80""", ref_year=REF_YEAR)
view("v8_enriquecidas_filtradas", V.proposicoes_enriquecidas, f"""
    SELECT proposicao_id, tipo, data_apresentacao, tema, critico, ementa, resumo_executivo, score_relevancia AS score
    FROM ({_SCORE}) s WHERE resumo_executivo IS NOT NULL AND tema = 'HIGH' AND tipo = 'PL'
      AND (ementa ILIKE '%h_gh%' OR resumo_executivo ILIKE '%h_gh%')
    ORDER BY score_relevancia DESC, data_apresentacao DESC NULLS FIRST, proposicao_id LIMIT 30""",
     tema="HIGH", tipo="PL", busca=" h_gh ", limit=30, ref_year=REF_YEAR)

_BENCH_PARTY = """SELECT partido_id, sigla, nome, coalesce(n, 0) AS deputados FROM dim_partidos
    LEFT JOIN (SELECT partido_id, count(*) AS n FROM dim_deputados GROUP BY ALL) USING (partido_id)"""
view("v9_deputados_por_partido", V.deputados_por_partido, _BENCH_PARTY)
view("v10_deputados_por_uf", V.deputados_por_uf, "SELECT uf, count(*) AS deputados FROM dim_deputados GROUP BY uf")

_PARTY_AUTHOR = f"""SELECT sigla, count(*) AS qtd
    FROM (SELECT DISTINCT sigla, proposicao_id FROM ({_AUTHORED}) WHERE sigla IS NOT NULL) GROUP BY ALL"""
view("v11_proposicoes_por_partido_autor", V.proposicoes_por_partido_autor, _PARTY_AUTHOR)
_PER_AUTHOR = "SELECT autor_id AS deputado_id, count(*) AS proposicoes FROM fato_proposicoes GROUP BY ALL"
view("v11_por_partido_autor_legacy", V.proposicoes_por_partido_autor_legacy, f"""
    SELECT sigla, sum(proposicoes)::BIGINT AS qtd FROM ({_PER_AUTHOR}) JOIN ({_BENCH}) USING (deputado_id) GROUP BY ALL""")

_TOP_AUTHORS = f"""SELECT deputado_id, nome, sigla AS partido, uf, proposicoes FROM ({_BENCH})
    JOIN (SELECT deputado_id, count(*) AS proposicoes FROM (SELECT DISTINCT deputado_id, proposicao_id FROM ponte_proposicao_autores)
      GROUP BY ALL) USING (deputado_id)"""
view("v12_top_deputados_autoria", V.top_deputados_autoria, _TOP_AUTHORS)
view("v12_top_autoria_legacy", V.top_deputados_autoria_legacy, f"""
    SELECT deputado_id, nome, sigla AS partido, uf, proposicoes FROM ({_BENCH}) JOIN ({_PER_AUTHOR}) USING (deputado_id)""")

_PER_SPENDER = "SELECT deputado_id, coalesce(sum(valor_liquido), 0) AS gasto, count(*) AS n FROM fato_despesas GROUP BY ALL"
_SPEND_PARTY = f"""SELECT sigla, sum(gasto)::DOUBLE AS total, sum(n)::BIGINT AS docs
    FROM ({_PER_SPENDER}) JOIN ({_BENCH}) USING (deputado_id) GROUP BY ALL"""
view("v13_despesas_por_partido", V.despesas_por_partido, _SPEND_PARTY)
view("v14_despesas_por_categoria", V.despesas_por_categoria, """
    SELECT tipo_despesa AS categoria, CAST(coalesce(sum(valor_liquido), 0) AS DOUBLE) AS total, count(*) AS docs
    FROM fato_despesas GROUP BY tipo_despesa""")
_TOP_SPEND = f"""SELECT deputado_id, nome, sigla AS partido, uf, gasto::DOUBLE AS total, n AS docs
    FROM ({_BENCH}) JOIN ({_PER_SPENDER}) USING (deputado_id)"""
view("v15_top_deputados_despesa", V.top_deputados_despesa, _TOP_SPEND)
view("v16_despesas_serie_mensal", V.despesas_serie_mensal, """
    SELECT ano, mes, CAST(coalesce(sum(valor_liquido), 0) AS DOUBLE) AS total, count(*) AS docs
    FROM fato_despesas GROUP BY ano, mes""")
view("v17_top_fornecedores", V.top_fornecedores, """
    SELECT fornecedor_nome, fornecedor_cnpj, CAST(total AS DOUBLE) AS total, docs FROM (
      SELECT fornecedor_nome, fornecedor_cnpj, coalesce(sum(valor_liquido), 0) AS total, count(*) AS docs
      FROM fato_despesas WHERE fornecedor_nome IS NOT NULL GROUP BY fornecedor_nome, fornecedor_cnpj
      ORDER BY total DESC, fornecedor_nome, fornecedor_cnpj NULLS FIRST LIMIT 50) s""")

_VOTES_SUMMARY = """SELECT sum(n)::BIGINT AS total, coalesce(max(n) FILTER (WHERE aprovacao), 0) AS aprovadas,
      coalesce(max(n) FILTER (WHERE NOT aprovacao), 0) AS reprovadas, coalesce(max(n) FILTER (WHERE aprovacao IS NULL), 0) AS sem_resultado,
      (SELECT count(DISTINCT orgao) FROM fato_votacoes) AS orgaos, sum(ligadas)::BIGINT AS com_proposicao,
      min(primeira)::DATE AS data_min, max(ultima)::DATE AS data_max, sum(abertas)::BIGINT AS com_votos,
      coalesce(sum(votos), 0)::BIGINT AS votos_nominais
    FROM (SELECT aprovacao, count(*) AS n, count(proposicao_id) AS ligadas, min(data) AS primeira, max(data) AS ultima,
      sum(votos_carregados::INT) AS abertas, sum(qtd_votos) AS votos FROM fato_votacoes GROUP BY aprovacao)"""
view("v18_votacoes_resumo", V.votacoes_resumo, _VOTES_SUMMARY)
_BODIES = "SELECT orgao, count(*) AS qtd, count(*) FILTER (WHERE aprovacao) AS aprovadas FROM fato_votacoes GROUP BY orgao"
view("v19_votacoes_por_orgao", V.votacoes_por_orgao, _BODIES)
view("v20_votacoes_serie", V.votacoes_serie, "SELECT CAST(data AS DATE) AS dia, count(*) AS qtd FROM fato_votacoes GROUP BY 1")

_CRITICAL = """SELECT proposicao_id, tipo, data_apresentacao, tema, ementa
    FROM fato_proposicoes JOIN (SELECT tema_id, nome AS tema FROM dim_temas WHERE critico) USING (tema_id)"""
view("v21_alertas_criticas", V.alertas_criticas_recentes,
     f"{_CRITICAL} WHERE date_diff('day', data_apresentacao, DATE '{AS_OF}') <= 30", as_of=AS_OF)
view("v22_criticas_recentes", V.criticas_recentes, f"""
    SELECT * EXCLUDE r FROM (SELECT *, row_number() OVER (ORDER BY data_apresentacao DESC NULLS FIRST, proposicao_id) AS r
      FROM ({_CRITICAL})) WHERE r <= 12""")

_QUALITY = """SELECT unnest(itens, recursive := TRUE) FROM (
      SELECT [{'metrica': 'proposicoes_sem_tema', 'valor': n - count(tema_id), 'total': n},
        {'metrica': 'proposicoes_sem_resumo', 'valor': n - count(resumo_executivo), 'total': n},
        {'metrica': 'proposicoes_sem_autor', 'valor': count(*) FILTER (WHERE NOT autores_carregados), 'total': n}] AS itens
      FROM fato_proposicoes, (SELECT count(*) AS n FROM fato_proposicoes) GROUP BY n
      UNION ALL SELECT [{'metrica': 'votacoes_sem_proposicao', 'valor': n - count(proposicao_id), 'total': n},
        {'metrica': 'votacoes_sem_votos', 'valor': count(*) FILTER (WHERE NOT votos_carregados), 'total': n}]
      FROM fato_votacoes, (SELECT count(*) AS n FROM fato_votacoes) GROUP BY n)"""
view("v23_data_quality", V.data_quality, _QUALITY)

_HEATMAP = f"""SELECT sigla_partido, coalesce(nome, 'Sem tema') AS tema, g.tema_id AS tema_id, coalesce(critico, FALSE) AS critico,
      qtd_proposicoes, qtd_deputados_autores
    FROM (SELECT sigla AS sigla_partido, tema_id, len(list_distinct(list(proposicao_id))) AS qtd_proposicoes,
        len(list_distinct(list(deputado_id))) AS qtd_deputados_autores
      FROM (SELECT DISTINCT sigla, tema_id, proposicao_id, deputado_id FROM ({_AUTHORED}) JOIN fato_proposicoes USING (proposicao_id))
      WHERE sigla IS NOT NULL GROUP BY ALL) g
    LEFT JOIN dim_temas ON dim_temas.tema_id = g.tema_id"""
view("v24_heatmap_tema_partido", V.heatmap_tema_partido, _HEATMAP)

view("v25_proposicoes_por_deputado", V.proposicoes_por_deputado, f"""
    SELECT deputado_id, nome AS deputado, sigla AS sigla_partido, uf, count(*) AS qtd_proposicoes,
      count(DISTINCT tema_id) AS qtd_temas, sum(assinadas)::BIGINT AS qtd_como_proponente
    FROM (SELECT deputado_id, proposicao_id, count(*) FILTER (WHERE proponente) AS assinadas FROM ponte_proposicao_autores GROUP BY ALL)
    JOIN (SELECT proposicao_id, tema_id FROM fato_proposicoes) USING (proposicao_id)
    JOIN (SELECT deputado_id, nome, uf, sigla FROM ({_BENCH})) USING (deputado_id) GROUP BY deputado_id, nome, sigla, uf""")
view("v26_proposicoes_por_partido", V.proposicoes_por_partido, f"""
    WITH per_author AS (SELECT partido_id, sigla, proposicao_id, deputado_id, count(*) FILTER (WHERE proponente) AS assinadas
      FROM ({_AUTHORED}) SEMI JOIN fato_proposicoes USING (proposicao_id) WHERE sigla IS NOT NULL GROUP BY ALL)
    SELECT partido_id, sigla AS sigla_partido, len(list_distinct(list(proposicao_id))) AS qtd_proposicoes,
      len(list_distinct(list(deputado_id))) AS qtd_deputados_autores, sum(assinadas)::BIGINT AS qtd_proponente
    FROM per_author GROUP BY ALL""")
view("v27_votos_partido_tema", V.votos_partido_tema, f"""
    WITH theme_of AS (SELECT votacao_id, coalesce(nome, 'Sem tema') AS tema FROM fato_votacoes
      LEFT JOIN (SELECT proposicao_id, tema_id FROM fato_proposicoes) USING (proposicao_id) LEFT JOIN dim_temas USING (tema_id)),
    labelled AS (SELECT if(sigla_partido_voto IS NULL, coalesce(sigla, 'N/I'), sigla_partido_voto) AS sigla_partido, tema, tipo_voto,
        deputado_id, votacao_id
      FROM fato_votacao_votos JOIN theme_of USING (votacao_id)
      LEFT JOIN (SELECT deputado_id, sigla FROM ({_BENCH})) USING (deputado_id))
    SELECT sigla_partido, tema, tipo_voto, sum(n)::BIGINT AS qtd_votos, count(DISTINCT deputado_id) AS qtd_deputados,
      count(DISTINCT votacao_id) AS qtd_votacoes
    FROM (SELECT *, count(*) AS n FROM labelled GROUP BY ALL) GROUP BY sigla_partido, tema, tipo_voto""")
_PARTY_VOTES = """SELECT sigla, sum(n)::BIGINT AS qtd_votos, coalesce(sum(n) FILTER (WHERE escolha = 'sim'), 0)::BIGINT AS sim,
      coalesce(sum(n) FILTER (WHERE escolha IN ('nao', 'não')), 0)::BIGINT AS nao, count(DISTINCT deputado_id) AS qtd_deputados
    FROM (SELECT if(sigla_partido_voto IS NULL, 'N/I', sigla_partido_voto) AS sigla, lower(tipo_voto)[1:3] AS escolha, deputado_id,
      count(*) AS n FROM fato_votacao_votos GROUP BY ALL) GROUP BY sigla"""
view("v28_votos_por_partido", V.votos_por_partido, _PARTY_VOTES)

_DIGEST = f"""SELECT p.proposicao_id, p.tipo, p.ementa, p.resumo_executivo, p.qtd_autores, p.autor_principal_nome,
      p.data_apresentacao, t.nome AS tema, t.critico AS critico
    FROM fato_proposicoes p LEFT JOIN dim_temas t ON p.tema_id = t.tema_id
    WHERE p.data_apresentacao >= DATE '{AS_OF}' - INTERVAL 7 DAY
    ORDER BY coalesce(t.critico, FALSE) DESC, coalesce(p.qtd_autores, 0) DESC, p.data_apresentacao DESC, p.proposicao_id LIMIT 5"""
view("v29_digest", V.digest, _DIGEST, as_of=AS_OF)
view("st6_digest_without_rows", V.digest, _DIGEST.replace(AS_OF, "2999-01-01"), as_of="2999-01-01")
view("v30_top_temas", V.top_temas, f"""
    SELECT tema, qtd FROM ({_THEMES}) s WHERE qtd > 0 ORDER BY qtd DESC, tema_id LIMIT 5""")
view("v31_cobertura", V.enrichment_coverage, """
    SELECT count(*) AS total, count(embedding) AS com_embedding, count(tema_id) AS com_tema, count(resumo_executivo) AS com_resumo
    FROM fato_proposicoes""")

# --- derived figures ------------------------------------------------------------

_CELLS = f"SELECT sigla_partido, tema, CAST(sum(qtd_proposicoes) AS BIGINT) AS qtd FROM ({_HEATMAP}) h GROUP BY 1, 2"
view("c1_heatmap_matrix", A.heatmap_matrix, f"""
    WITH cells AS ({_CELLS}),
    parts AS (SELECT sigla_partido FROM cells GROUP BY 1 ORDER BY sum(qtd) DESC, 1 LIMIT 12),
    temas AS (SELECT tema FROM cells GROUP BY 1 ORDER BY sum(qtd) DESC, 1 LIMIT 8)
    SELECT parts.sigla_partido, temas.tema, coalesce(cells.qtd, 0) AS qtd,
      coalesce(cells.qtd, 0) / CAST((SELECT greatest(1, max(qtd)) FROM cells) AS DOUBLE) AS intensidade
    FROM parts CROSS JOIN temas LEFT JOIN cells ON cells.sigla_partido = parts.sigla_partido AND cells.tema = temas.tema""")

_PRIORITIES = ["URGENT", "HIGH", "MEDIUM", "NOT SPECIFIED", "LOW", "Sem tema"]
view("c1_heatmap_wide", A.heatmap_wide, "SELECT sigla_partido, " + ", ".join(
    f"""CAST(coalesce(sum(qtd) FILTER (WHERE tema = '{name}'), 0) AS BIGINT) AS "{name}\"""" for name in _PRIORITIES)
    + f" FROM ({_CELLS}) c GROUP BY 1", names=_PRIORITIES)

_SHARE = f"""SELECT tema_id, tema, critico, qtd, qtd / CAST((SELECT greatest(1, max(qtd)) FROM ({_THEMES}) m) AS DOUBLE) AS fatia
    FROM ({_THEMES}) s"""
view("c2_theme_ranking", A.theme_ranking, _SHARE)
view("p12_only_critical", A.theme_ranking, f"{_SHARE} WHERE critico", only_critical=True)

_N = "(SELECT count(*) FROM fato_proposicoes)"
_NT = "(SELECT count(tema_id) FROM fato_proposicoes)"
_NR = "(SELECT count(resumo_executivo) FROM fato_proposicoes)"
view("c3_theme_highlights", A.theme_highlights, f"""
    WITH t AS ({_THEMES}),
    d AS (SELECT tema, qtd FROM t ORDER BY qtd DESC, tema_id LIMIT 1),
    c AS (SELECT tema, qtd FROM t WHERE critico ORDER BY qtd DESC, tema_id LIMIT 1)
    SELECT (SELECT tema FROM d) AS dominante, (SELECT qtd FROM d) AS dominante_qtd, (SELECT tema FROM c) AS critico_lider,
      (SELECT qtd FROM c) AS critico_lider_qtd, CAST((SELECT sum(qtd) FROM t WHERE critico) AS BIGINT) AS criticas_total,
      printf('%.1f%%', round((SELECT sum(qtd) FROM t WHERE critico) / CAST({_NT} AS DOUBLE) * 100, 1)) AS criticas_pct, {_N} - {_NT} AS sem_classificacao""")
view("c4_radar", A.radar, f"""
    SELECT tema_id, split_part(tema, ' ', 1) AS tema, qtd FROM ({_THEMES}) s ORDER BY qtd DESC, tema_id LIMIT 8""")
view("c5_enrichment_funnel", A.enrichment_funnel, f"""
    SELECT 'Classificadas' AS etapa, {_NT} AS qtd UNION ALL SELECT 'Resumidas (sem tema)', greatest(0, {_NR} - {_NT})
    UNION ALL SELECT 'Pendentes', greatest(0, {_N} - {_NR})""")
view("c6_coverage_split", A.coverage_split, f"""
    SELECT 'Enriquecidas' AS situacao, {_NR} AS qtd UNION ALL SELECT 'Pendentes', greatest(0, {_N} - {_NR})""")
view("c7_active_days", A.active_days, """
    WITH s AS (SELECT data_apresentacao AS dia, count(*) AS qtd FROM fato_proposicoes WHERE data_apresentacao IS NOT NULL
      GROUP BY 1 ORDER BY 1 DESC LIMIT 30)
    SELECT dia, qtd, dia = (SELECT dia FROM s ORDER BY qtd DESC, dia LIMIT 1) AS pico FROM s""")
view("c8_approval_split", A.approval_split, """
    WITH r AS (SELECT CASE WHEN aprovacao THEN 'Aprovadas' WHEN NOT aprovacao THEN 'Reprovadas' ELSE 'Sem resultado' END AS resultado
      FROM fato_votacoes)
    SELECT resultado, count(*) AS qtd, printf('%.1f%%', round(count(*) / CAST((SELECT count(*) FROM r) AS DOUBLE) * 100, 1)) AS pct FROM r GROUP BY 1""")


def _slice(name, fn, sql, by, n, *ties):
    order = ", ".join([f"{by} DESC NULLS FIRST"] + [f"{c} NULLS FIRST" for c in ties])
    query(name, f"SELECT * FROM ({sql}) s ORDER BY {order} LIMIT {n}")(
        lambda spark, sf: A.top_slice(fn(tables(spark, sf)), by, n, *ties))


_slice("c9_top_orgaos", V.votacoes_por_orgao, _BODIES, "qtd", A.SLICES["orgaos"], "orgao")
_slice("c9_top_votos_partido", V.votos_por_partido, _PARTY_VOTES, "qtd_votos", A.SLICES["votos_partido"], "sigla")
_slice("c9_top_partido_autor", V.proposicoes_por_partido_autor, _PARTY_AUTHOR, "qtd", A.SLICES["partido_autor"], "sigla")
_slice("c9_top_bancada", V.deputados_por_partido, _BENCH_PARTY, "deputados", A.SLICES["bancada"], "partido_id")
_slice("c9_top_ufs", V.deputados_por_uf, "SELECT uf, count(*) AS deputados FROM dim_deputados GROUP BY uf",
       "deputados", A.SLICES["ufs"], "uf")
_slice("c9_top_despesa_partido", V.despesas_por_partido, _SPEND_PARTY, "total", A.SLICES["despesa_partido"], "sigla")
_slice("c9_top_deputados_despesa", V.top_deputados_despesa, _TOP_SPEND, "total", A.SLICES["deputados"], "deputado_id")
_slice("c9_top_deputados_autoria", V.top_deputados_autoria, _TOP_AUTHORS, "proposicoes", A.SLICES["deputados"], "deputado_id")
_slice("c9_top_tipos", V.proposicoes_por_tipo, "SELECT tipo, count(*) AS qtd FROM fato_proposicoes GROUP BY tipo",
       "qtd", A.SLICES["tipos"], "tipo")

view("c10_backlog", A.backlog, f"SELECT greatest(0, {_N} - {_NT}) AS sem_tema, greatest(0, {_N} - {_NR}) AS sem_resumo")
query("c11_options", "SELECT 'Todos' AS opcao UNION ALL SELECT DISTINCT tipo FROM fato_proposicoes")(
    lambda spark, sf: A.options(table(spark, sf, "fato_proposicoes"), "tipo"))
query("c12_coerced", """
    SELECT ano, mes, CASE WHEN mes % 2 = 0 THEN 0.0 ELSE CAST(sum(valor_liquido) AS DOUBLE) END AS total
    FROM fato_despesas GROUP BY ano, mes""")(
    lambda spark, sf: A.coerced(
        V.despesas_serie_mensal(tables(spark, sf)).selectExpr(
            "ano", "mes", "CASE WHEN mes % 4 = 0 THEN NULL WHEN mes % 2 = 0 THEN 'NaN' ELSE CAST(total AS STRING) END AS total"),
        ["total"]))
query("c13_quality_map", f"""
    SELECT CAST(max(valor) FILTER (WHERE metrica = 'proposicoes_sem_tema') AS BIGINT) AS sem_tema,
      CAST(max(total) FILTER (WHERE metrica = 'votacoes_sem_votos') AS BIGINT) AS votacoes, CAST(count(*) AS INT) AS metricas
    FROM ({_QUALITY}) q""")(
    lambda spark, sf: A.quality_map(tables(spark, sf)).selectExpr(
        "qualidade['proposicoes_sem_tema'].valor AS sem_tema", "qualidade['votacoes_sem_votos'].total AS votacoes",
        "size(qualidade) AS metricas"))
query("c14_ordered_view", f"{_TOP_SPEND} ORDER BY total DESC")(
    lambda spark, sf: V.ordered(V.top_deputados_despesa(tables(spark, sf)), "total"))
view("c15_digest_cards", A.digest_cards, f"""
    SELECT CAST(row_number() OVER (ORDER BY coalesce(critico, FALSE) DESC, coalesce(qtd_autores, 0) DESC,
        data_apresentacao DESC, proposicao_id) AS INT) AS posicao,
      CASE WHEN critico THEN 'Critico' ELSE 'Geral' END AS selo, coalesce(tema, 'Sem tema classificado') AS tema,
      CASE WHEN qtd_autores > 0 THEN CAST(qtd_autores AS VARCHAR) || ' autor(es)' ELSE 'autoria nao carregada' END
        || coalesce(' · ' || autor_principal_nome, '') AS autoria,
      tipo || ' ' || CAST(proposicao_id AS VARCHAR) AS titulo, ementa,
      coalesce(resumo_executivo, 'Resumo por IA ainda nao gerado.') AS resumo
    FROM ({_DIGEST}) d""", as_of=AS_OF)

# --- predicates and aggregates with no view of their own ---------------------------

# Longer and shorter patterns, accents, wildcards, one of two letters (a scan), one that nothing matches.
_PATTERNS = ("%tion was%", "%CIÓNESCO%", "%the_of%ingha%", "%ei%", "%ñesga%", "%zzqq%")


@query("p5_indexed_search", f"""
    SELECT padrao, doc_id FROM documents, (VALUES {', '.join(f"('{p}')" for p in _PATTERNS)}) v(padrao) WHERE text ILIKE padrao""")
def _indexed_search(spark, sf):
    docs = load(spark, sf, "documents").select("doc_id", "text")
    index = text_index.TextIndex.build(docs, scratch_path(spark, "text-index"), "doc_id", ["text"], buckets=16)
    found = [index.search(docs, p).select(F.lit(p).alias("padrao"), "doc_id") for p in _PATTERNS]
    return reduce(lambda a, b: a.unionByName(b), found)


query("p13_text_contains", """
    SELECT doc_id, lang FROM documents WHERE contains(lower(source || text), lower('SRC1'))""")(
    lambda spark, sf: _contains(load(spark, sf, "documents")))


def _contains(docs):
    from pyspark.sql import functions as F

    from civicspark.functions.text import contains_folded

    return docs.where(contains_folded([F.col("source"), F.col("text")], "SRC1")).select("doc_id", "lang")


# --- research questions -------------------------------------------------------------

_VALID_VOTES = "SELECT * FROM fato_votacao_votos WHERE tipo_voto IS NOT NULL AND sigla_partido_voto IS NOT NULL"
_COHESION = f"""SELECT votacao_id, sigla_partido_voto, CAST(sum(n) AS BIGINT) AS votos, max(n) AS maioria,
      arg_min(tipo_voto, rn) AS voto_maioria
    FROM (SELECT *, row_number() OVER (PARTITION BY votacao_id, sigla_partido_voto ORDER BY n DESC, tipo_voto) AS rn
      FROM (SELECT votacao_id, sigla_partido_voto, tipo_voto, count(*) AS n FROM ({_VALID_VOTES}) v GROUP BY 1, 2, 3) c) r
    GROUP BY 1, 2"""
view("x1_party_cohesion", R.party_cohesion, f"SELECT *, maioria / CAST(votos AS DOUBLE) AS coesao FROM ({_COHESION}) c")
view("x1_cohesion_per_party", R.cohesion_per_party, f"""
    SELECT sigla_partido_voto AS sigla, count(*) AS votacoes, CAST(sum(votos) AS BIGINT) AS votos,
      sum(maioria) / CAST(sum(votos) AS DOUBLE) AS coesao FROM ({_COHESION}) c GROUP BY 1""")
view("x1_deputy_loyalty", R.deputy_loyalty, f"""
    SELECT deputado_id, count(*) AS votos, CAST(count(*) FILTER (WHERE tipo_voto = voto_maioria) AS BIGINT) AS com_partido,
      count(*) FILTER (WHERE tipo_voto = voto_maioria) / CAST(count(*) AS DOUBLE) AS fidelidade
    FROM ({_VALID_VOTES}) v JOIN ({_COHESION}) c USING (votacao_id, sigla_partido_voto) GROUP BY 1""")
view("x2_themes_per_week", R.themes_per_week, """
    SELECT CAST(date_trunc('week', p.data_apresentacao) AS DATE) AS semana, coalesce(t.nome, 'Sem tema') AS tema, count(*) AS qtd
    FROM fato_proposicoes p LEFT JOIN dim_temas t ON t.tema_id = p.tema_id WHERE p.data_apresentacao IS NOT NULL GROUP BY 1, 2""")
view("x2_top_authors_of_month", R.top_authors_of_month, f"""
    WITH month AS (SELECT proposicao_id FROM fato_proposicoes WHERE date_trunc('month', data_apresentacao) = DATE '2001-07-01')
    SELECT deputado_id, nome, sigla AS partido, uf, proposicoes FROM ({_BENCH})
    JOIN (SELECT deputado_id, count(DISTINCT proposicao_id) AS proposicoes FROM ponte_proposicao_autores
      SEMI JOIN month USING (proposicao_id) GROUP BY ALL) USING (deputado_id)
    ORDER BY proposicoes DESC, deputado_id LIMIT 10""", as_of="2001-07-15")
query("x3_days_to_archive", """
    SELECT p.tipo, count(*) AS arquivadas, avg(date_diff('day', p.data_apresentacao, a.d)) AS dias_medios
    FROM fato_proposicoes p JOIN (SELECT l_orderkey, min(CAST(l_shipdate AS DATE)) AS d FROM lineitem
      WHERE l_returnflag = 'R' GROUP BY 1) a ON a.l_orderkey = p.proposicao_id
    WHERE p.data_apresentacao IS NOT NULL GROUP BY 1""")(
    lambda spark, sf: R.days_to_archive(
        table(spark, sf, "fato_proposicoes"),
        load(spark, sf, "lineitem").selectExpr(
            "l_orderkey AS proposicao_id", "l_shipdate AS data",
            "CASE WHEN l_returnflag = 'R' THEN 'Arquivada' ELSE 'Em tramitacao' END AS situacao")))


def _filled_store(spark, sf, width=10_000):
    """The stand-ins of the heatmap in a store of many key ranges."""
    t, st = standins.tables(spark, sf), StarStore(spark, scratch_path(spark, "star"), range_width=width)
    with st.begin() as one:
        for name in ("dim_partidos", "dim_deputados", "dim_temas"):
            one.write(name, t[name])
        one.write("fato_proposicoes", t["fato_proposicoes"].select("proposicao_id", "data_apresentacao", "tipo", "ementa", "tema_id"))
        one.write("ponte_proposicao_autores", t["ponte_proposicao_autores"])
    return st


_MOVED = """WITH moved AS (SELECT proposicao_id, CASE WHEN proposicao_id % 5 = 1 THEN NULL
      WHEN proposicao_id BETWEEN 5000 AND 25000 THEN 1 ELSE tema_id END AS tema_id FROM fato_proposicoes) """


@query("st3_view_refresh", _MOVED + _HEATMAP.replace("fato_proposicoes", "moved"))
def _st3_refresh(spark, sf):
    """V24 kept up to date over two loads that move propositions between themes, each replayed."""
    st = _filled_store(spark, sf)
    refresh.refresh(st)
    for where, theme in (("proposicao_id BETWEEN 5000 AND 25000", F.lit(1)), ("proposicao_id % 5 = 1", F.lit(None))):
        moved = st.read("fato_proposicoes").where(where).select("proposicao_id", theme.cast("int").alias("tema_id"))

        def move(one, moved=moved):
            touched = one.read("fato_proposicoes", one.touched("fato_proposicoes", moved))
            one.write("fato_proposicoes", ups.set_values(touched, moved, ["tema_id"]))
            refresh.refresh(one)

        for _ in range(2):
            store.atomic(st, move)
    return refresh.heatmap_tema_partido(st)


@query("st3_quality_refresh", """
    SELECT 'proposicoes_sem_tema' AS metrica, count(*) FILTER (WHERE tema_id IS NULL OR proposicao_id % 5 = 1) AS valor, count(*) AS total FROM fato_proposicoes
    UNION ALL SELECT 'proposicoes_sem_resumo', count(*), count(*) FROM fato_proposicoes
    UNION ALL SELECT 'proposicoes_sem_autor', count(*), count(*) FROM fato_proposicoes
    UNION ALL SELECT 'votacoes_sem_proposicao', 0, 0 UNION ALL SELECT 'votacoes_sem_votos', 0, 0""")
def _st3_quality(spark, sf):
    """V23 after a load that takes themes away: partial rows of the touched ranges are replaced."""
    st = _filled_store(spark, sf)
    refresh.refresh(st)
    moved = st.read("fato_proposicoes").where("proposicao_id % 5 = 1").select("proposicao_id", F.lit(None).cast("int").alias("tema_id"))
    st.write("fato_proposicoes", ups.set_values(st.read("fato_proposicoes"), moved, ["tema_id"]))
    refresh.refresh(st)
    return refresh.data_quality(st)


@query("u12_atomic_load", """
    SELECT 'dim_partidos' AS tabela, count(*) AS linhas, 3 AS cargas FROM dim_partidos UNION ALL SELECT 'dim_deputados', count(*), 3 FROM dim_deputados
    UNION ALL SELECT 'dim_temas', count(*), 3 FROM dim_temas UNION ALL SELECT 'fato_proposicoes', count(*), 3 FROM fato_proposicoes""")
def _u12_atomic(spark, sf):
    """A load of three tables during which another one is published: it fails cleanly, is run again, and nothing is lost."""
    t, root, tries = standins.tables(spark, sf), scratch_path(spark, "star"), []
    st, other = StarStore(spark, root), StarStore(spark, root)
    st.write("dim_partidos", t["dim_partidos"])

    def job(one):
        tries.append(one.base.number)
        for name in ("dim_deputados", "fato_proposicoes"):
            one.write(name, t[name].drop("embedding"))
        if len(tries) == 1:
            other.write("dim_temas", t["dim_temas"])

    store.atomic(st, job)
    counts = store.row_counts({n: st.read(n) for n in ("dim_partidos", "dim_deputados", "dim_temas", "fato_proposicoes")})
    return counts.withColumn("cargas", F.lit(st.manifest().number))


@query("a2_heatmap_of_year", f"""WITH dated AS (SELECT * FROM fato_proposicoes WHERE data_apresentacao BETWEEN DATE '2000-01-01' AND DATE '2000-12-31')
    SELECT sigla_partido, tema_id, qtd_proposicoes, qtd_deputados_autores FROM ({_HEATMAP.replace("fato_proposicoes", "dated")})""")
def _a2(spark, sf):
    """Distinct propositions and authors of a year from the bitmaps of its months, without the facts."""
    path = scratch_path(spark, "months")
    rollup.monthly_authorship(standins.tables(spark, sf)).write.parquet(path)
    return rollup.authorship_of(spark.read.parquet(path), "2000-01-01", "2000-12-31")
