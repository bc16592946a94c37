"""Scalar functions over whole columns, with their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from civicspark.functions import coerce, cost, formats, text, uri

from .registry import query
from .standins import documents, load, sql

# White space as DuckDB's regular expressions must spell it.
_WS = r"[\s\x0b\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"


def _strip(x):
    return f"regexp_replace(regexp_replace({x}, '^{_WS}+', ''), '{_WS}+$', '')"


def _safe(x):
    return f"(CASE WHEN lower({_strip(x)}) NOT IN ('', 'nan', 'none', 'null') THEN {_strip(x)} END)"


def _clean(x):
    return (f"nullif(trim(regexp_replace(regexp_replace({x}, '{_CONTROL}', '', 'g'), '{_WS}+', ' ', 'g'), ' '), '')")


# Every event gets one of the awkward spellings.
_MESSY = """CASE event_id % 6 WHEN 0 THEN ' NaN ' WHEN 1 THEN '  ' || event_type || chr(9) WHEN 2 THEN 'none'
    WHEN 3 THEN '' WHEN 4 THEN chr(160) || event_type ELSE CAST(user_id AS STRING) END"""

query("f1_safe_str", f"SELECT event_id, {_safe('m')} AS s FROM (SELECT event_id, {_MESSY} AS m FROM events) e")(
    lambda spark, sf: sql(spark, sf, f"SELECT event_id, {_MESSY} AS m FROM {{events}}").select(
        "event_id", text.safe_str(F.col("m")).alias("s")))

query("f2_clean_text", f"SELECT doc_id, {_clean('text')} AS t, substr({_clean('text')}, 1, 40) AS cut FROM documents")(
    lambda spark, sf: documents(spark, sf).select(
        "doc_id", text.clean_text(F.col("text")).alias("t"), text.clean_text(F.col("text"), 40).alias("cut")))

query("f3_strip_accents", "SELECT doc_id, strip_accents(text) AS t FROM documents")(
    lambda spark, sf: documents(spark, sf).select("doc_id", text.strip_accents(F.col("text"), "NFD").alias("t")))

query("f3_strip_accents_full")(
    lambda spark, sf: documents(spark, sf).select("doc_id", text.strip_accents_full("text").alias("t")))

query("f4_normalize_key", """
    SELECT doc_id, trim(regexp_replace(lower(strip_accents(lower(text))), '[^a-z0-9]+', '_', 'g'), '_') AS k FROM documents""")(
    lambda spark, sf: documents(spark, sf).select("doc_id", text.normalize_key(F.col("text")).alias("k")))

_DOC = "CASE WHEN c_custkey % 9 = 0 THEN ' - ' WHEN c_custkey % 9 = 1 THEN 'nan' ELSE '00.' || CAST(c_custkey AS STRING) || '/0001-04 ' END"
query("f5_normalize_cnpj_cpf", f"""
    SELECT c_custkey, nullif(regexp_replace({_safe('d')}, '[./\\s-]', '', 'g'), '') AS d
    FROM (SELECT c_custkey, {_DOC} AS d FROM customer) c""")(
    lambda spark, sf: sql(spark, sf, f"SELECT c_custkey, {_DOC} AS d FROM {{customer}}").select(
        "c_custkey", text.normalize_cnpj_cpf(F.col("d")).alias("d")))

query("f6_uri_id", r"""
    SELECT page_id, TRY_CAST(nullif(regexp_extract(url, '(?:^|/)([0-9]+)/*$', 1), '') AS INT) AS id FROM pages""")(
    lambda spark, sf: load(spark, sf, "pages").select("page_id", uri.numeric_tail(F.col("url")).alias("id")))

query("f7_uri_entity", r"""
    SELECT page_id, nullif(lower(regexp_extract(url, '([^/]+)/+[0-9]+/*$', 1)), '') AS entidade FROM pages""")(
    lambda spark, sf: load(spark, sf, "pages").select("page_id", uri.resource_of(F.col("url")).alias("entidade")))

_FLAG = """CASE event_id % 9 WHEN 0 THEN '1' WHEN 1 THEN '0' WHEN 2 THEN '2' WHEN 3 THEN 'true' WHEN 4 THEN 'Sim'
    WHEN 5 THEN ' t ' WHEN 6 THEN 'nao' WHEN 7 THEN NULL ELSE event_type END"""
query("f8_normalize_bool", f"SELECT event_id, coalesce(lower(trim({_FLAG})) IN ('1', 'true', 's', 'sim', 't'), FALSE) AS b FROM events")(
    lambda spark, sf: sql(spark, sf, f"SELECT event_id, {_FLAG} AS f FROM {{events}}").select(
        "event_id", coerce.to_flag(F.col("f")).alias("b")))

_NUMBER = """CASE c_custkey % 4 WHEN 0 THEN 'abc' WHEN 1 THEN CAST(c_custkey AS STRING) || '.0' WHEN 2 THEN ''
    ELSE ' ' || CAST(c_custkey AS STRING) END"""
query("f9_to_number", """
    SELECT c_custkey, CASE WHEN c_custkey % 2 = 1 THEN CAST(c_custkey AS INT) END AS i,
      CASE WHEN c_custkey % 2 = 1 THEN CAST(c_custkey AS DOUBLE) END AS d FROM customer""")(
    lambda spark, sf: sql(spark, sf, f"SELECT c_custkey, {_NUMBER} AS n FROM {{customer}}").select(
        "c_custkey", coerce.to_int(F.col("n")).alias("i"), coerce.to_double(F.col("n")).alias("d")))

_DATE = """CASE o_orderkey % 3 WHEN 0 THEN 'sem data' WHEN 1 THEN CAST(CAST(o_orderdate AS DATE) AS STRING)
    ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) || 'T10:30' END"""
query("f10_to_date", """
    SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_orderdate AS DATE) END AS d,
      CASE WHEN o_orderkey % 3 = 2 THEN strftime(o_orderdate, '%Y-%m-%d') || ' 10:30'
           WHEN o_orderkey % 3 = 1 THEN strftime(o_orderdate, '%Y-%m-%d') || ' 00:00' END AS t FROM orders""")(
    lambda spark, sf: sql(spark, sf, f"SELECT o_orderkey, {_DATE} AS x FROM {{orders}}").select(
        "o_orderkey", coerce.to_day(F.col("x")).alias("d"),
        F.date_format(coerce.to_instant(F.col("x")), "yyyy-MM-dd HH:mm").alias("t")))

query("f11_approval", """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN TRUE WHEN 'O' THEN FALSE END AS aprovacao FROM orders""")(
    lambda spark, sf: sql(spark, sf, """
        SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN '1' WHEN 'O' THEN '0' ELSE '2' END AS a FROM {orders}""").select(
        "o_orderkey", coerce.to_approval(F.col("a")).alias("aprovacao")))

query("f13_json_text", """
    SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS k, '{"event_type":"' || event_type || '","k":' || json_extract_string(props, '$.k') || '}' AS j
    FROM events""")(
    lambda spark, sf: load(spark, sf, "events").select(
        "event_id", "event_type", F.from_json("props", "k INT")["k"].alias("k")).select(
        "event_id", "k", text.json_text("event_type", "k").alias("j")))

query("f14_message_cut", "SELECT doc_id, substr(coalesce(text, ''), 1, 2000) AS m FROM documents")(
    lambda spark, sf: load(spark, sf, "documents").select("doc_id", text.message(F.col("text")).alias("m")))

query("f17_texts", """
    SELECT o_orderkey, o_orderstatus || ': ' || o_orderpriority AS proposicao,
      o_orderpriority || ': ' || CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority ELSE o_orderstatus END AS tema FROM orders""")(
    lambda spark, sf: load(spark, sf, "orders").select(
        "o_orderkey", text.proposition_text(F.col("o_orderstatus"), F.col("o_orderpriority")).alias("proposicao"),
        text.theme_text(F.col("o_orderpriority"), F.when(F.col("o_orderkey") % 2 == 1, F.col("o_orderstatus"))).alias("tema")))

query("f18_prompt", """
    SELECT doc_id, 'Proposicao (' || CASE WHEN doc_id % 2 = 0 THEN 'Proposicao' ELSE upper(lang) END || '):' || chr(10) || '\"\"\"' || chr(10)
      || text || chr(10) || '\"\"\"' || chr(10) || chr(10) || 'Resumo executivo (max. 3 linhas):' AS prompt FROM documents""")(
    lambda spark, sf: load(spark, sf, "documents").select(
        "doc_id", text.render_prompt(F.when(F.col("doc_id") % 2 == 1, F.upper("lang")), F.col("text")).alias("prompt")))

query("f19_cost", """
    SELECT doc_id, CAST(round(CAST(n_chars AS DECIMAL(18,0)) * 0.00000002, 6) AS DOUBLE) AS embed,
      CAST(round(CAST(n_chars AS DECIMAL(18,0)) * 0.00000015 + CAST(doc_id AS DECIMAL(18,0)) * 0.00000060, 6) AS DOUBLE) AS chat FROM documents""")(
    lambda spark, sf: load(spark, sf, "documents").select(
        "doc_id", F.round(cost.embed_cost(F.col("n_chars")).cast("double"), 6).alias("embed"),
        F.round(cost.chat_cost(F.col("n_chars"), F.col("doc_id")).cast("double"), 6).alias("chat")))

query("f20_pct", """
    SELECT c_custkey, CASE WHEN c_nationkey = 0 THEN '0%'
      ELSE printf('%.1f%%', round(CAST(c_custkey AS DOUBLE) / c_nationkey * 100, 1)) END AS p FROM customer""")(
    lambda spark, sf: load(spark, sf, "customer").select(
        "c_custkey", formats.pct(F.col("c_custkey"), F.col("c_nationkey")).alias("p")))

_DAY = "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderdate END"
query("f21_dates_br", f"""
    SELECT o_orderkey, coalesce(strftime({_DAY}, '%d/%m/%Y'), '—') AS d, coalesce(strftime({_DAY}, '%d/%m'), '') AS curta FROM orders""")(
    lambda spark, sf: sql(spark, sf, f"SELECT o_orderkey, CAST({_DAY} AS DATE) AS d FROM {{orders}}").select(
        "o_orderkey", formats.fmt_day(F.col("d")).alias("d"), formats.fmt_day_short(F.col("d")).alias("curta")))

query("f22_last_load", """
    SELECT event_id, strftime(ts, '%d/%m/%Y · %H:%M UTC') AS carga, strftime(ts, '%H:%M') AS hora FROM events""")(
    lambda spark, sf: load(spark, sf, "events").select(
        "event_id", formats.fmt_last_load(F.col("ts")).alias("carga"), formats.fmt_hour(F.col("ts")).alias("hora")))

query("f23_month_year", """
    SELECT o_orderkey, (['jan','fev','mar','abr','mai','jun','jul','ago','set','out','nov','dez'])[extract(month FROM o_orderdate)]
      || '/' || substr(CAST(extract(year FROM o_orderdate) AS VARCHAR), 3) AS m FROM orders""")(
    lambda spark, sf: load(spark, sf, "orders").select(
        "o_orderkey", formats.fmt_month(F.year("o_orderdate"), F.month("o_orderdate")).alias("m")))


def _pt(x, decimals):
    return f"translate(format('{{:,.{decimals}f}}', {x}), ',.', '.,')"


query("f24_numbers_br", f"""
    SELECT o_orderkey, {_pt('CAST(o_orderkey * 1000 AS DOUBLE)', 0)} AS n, 'R$' || chr(160) || {_pt('round(o_totalprice, 0)', 0)} AS brl,
      'R$ ' || regexp_replace({_pt('round(o_orderkey * 10000 / 1e6, 1)', 1)}, ',0$', '') || ' mi' AS mi FROM orders""")(
    lambda spark, sf: load(spark, sf, "orders").select(
        "o_orderkey", formats.fmt_int(F.col("o_orderkey") * 1000).alias("n"), formats.fmt_brl(F.col("o_totalprice")).alias("brl"),
        formats.fmt_millions(F.col("o_orderkey") * 10000).alias("mi")))

query("f25_link", f"SELECT o_orderkey, '{uri.PROPOSITION_PAGE}' || CAST(o_orderkey AS VARCHAR) AS link FROM orders")(
    lambda spark, sf: load(spark, sf, "orders").select("o_orderkey", uri.proposition_link(F.col("o_orderkey")).alias("link")))

query("f26_theme_key", "SELECT doc_id, regexp_replace(strip_accents(lower(text)), '[^a-z]', '', 'g') AS k FROM documents")(
    lambda spark, sf: documents(spark, sf).select("doc_id", text.theme_key(F.col("text")).alias("k")))

_PATH = """CASE o_orderkey % 6 WHEN 0 THEN '/deputados' WHEN 1 THEN '/deputados/' || CAST(o_custkey AS STRING) || '/despesas'
    WHEN 2 THEN 'votacoes/' || CAST(o_custkey AS STRING) || '-49/Votos/' WHEN 3 THEN '/' || o_orderpriority
    WHEN 4 THEN '//proposicoes//' || CAST(o_custkey AS STRING) ELSE '' END"""
query("s8_path_classifier", """
    SELECT o_orderkey,
      CASE o_orderkey % 6 WHEN 0 THEN 'deputados' WHEN 1 THEN 'deputados_despesas' WHEN 2 THEN 'votacoes_votos' WHEN 4 THEN 'proposicoes' ELSE 'unknown' END AS entidade,
      CASE o_orderkey % 6 WHEN 1 THEN CAST(o_custkey AS VARCHAR) WHEN 2 THEN CAST(o_custkey AS VARCHAR) || '-49' WHEN 3 THEN o_orderpriority
        WHEN 4 THEN CAST(o_custkey AS VARCHAR) END AS id FROM orders""")(
    lambda spark, sf: sql(spark, sf, f"SELECT o_orderkey, {_PATH} AS p FROM {{orders}}").select(
        "o_orderkey", uri.path_entity(F.col("p")).alias("entidade"), uri.path_identifier(F.col("p")).alias("id")))
