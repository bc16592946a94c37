"""Readers, transforms, upserts, bridges, quality and streams with their oracles."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from civicspark import schemas
from civicspark.operators import bridges, dedup, load as load_jobs, quality, transforms, upsert as U
from civicspark.session import scratch_path
from civicspark.sources import datasets, envelopes as env, store
from civicspark.streaming import landing

from .function_queries import _clean, _safe
from .registry import query
from .standins import AS_OF, load, sql, table, tables

# --- raw records with the nested fields SQL text cannot build in both engines -----


def raw_votos(spark, sf):
    voter = lambda cond: F.when(cond, F.struct(F.col("voter_id").alias("id"), F.col("voter_party").alias("siglaPartido"),
                                               F.lit(" SP ").alias("siglaUf")))
    return table(spark, sf, "raw_votos").select(
        *env.ORIGIN, "votacao_id", "tipoVoto", F.lit("2024-01-02T10:00").alias("dataRegistroVoto"),
        voter(~F.col("plain_field")).alias("deputado_"), voter(F.col("plain_field")).alias("deputado"))


def raw_details(spark, sf):
    first = F.struct(F.col("first_id").alias("id"), F.col("first_uri").alias("uri"))
    return table(spark, sf, "raw_links").select(
        "votacao_id", F.col("own_id").alias("idProposicao"), F.col("uri_direct").alias("uriProposicaoObjeto"),
        F.lit(None).cast("string").alias("uriProposicao"),
        F.when(F.col("votacao_id").cast("bigint") % 5 <= 2, F.array(first)).otherwise(F.array().cast("array<struct<id:string,uri:string>>")).alias("proposicoesAfetadas"),
        F.col("objeto").alias("objetoVotacao"), "descricao", F.lit("7").alias("codTipoVotacao"))


# --- transforms -----------------------------------------------------------------


def _first(raw, keys, where, columns):
    """Oracle of an ordered keep-first."""
    return f"""SELECT {columns} FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY _snapshot, _part, _pos) AS rn
      FROM ({raw}) a WHERE {where}) b WHERE rn = 1"""


query("t0_keep_first", """
    SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, l_extendedprice FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_suppkey, l_partkey,
        l_extendedprice, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus) AS rn FROM lineitem) x WHERE rn = 1""")(
    lambda spark, sf: dedup.keep_first(
        load(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"],
        ["l_shipdate", "l_suppkey", "l_partkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus"],
    ).select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_extendedprice"))

query("t1_partidos", _first(
    f"SELECT _snapshot, _part, _pos, CAST(CAST(id AS DOUBLE) AS INT) AS partido_id, {_safe('sigla')} AS sigla, {_clean('nome')} AS nome FROM raw_partidos",
    "partido_id", "sigla IS NOT NULL", "partido_id, sigla, nome"))(
    lambda spark, sf: transforms.partidos(table(spark, sf, "raw_partidos")))

query("t2_deputados", _first(
    f"""SELECT _snapshot, _part, _pos, CAST(id AS INT) AS deputado_id, {_clean('nome')} AS nome, siglaPartido AS sigla_partido, {_safe('siglaUf')} AS uf,
      CAST(NULL AS VARCHAR) AS email, urlFoto AS url_foto, CAST(idLegislatura AS INT) AS id_legislatura, uriPartido AS uri_partido, uri,
      'Em exercicio' AS situacao FROM raw_deputados""",
    "deputado_id", "uf IS NOT NULL",
    "deputado_id, nome, sigla_partido, uf, email, url_foto, id_legislatura, uri_partido, uri, situacao"))(
    lambda spark, sf: transforms.deputados(table(spark, sf, "raw_deputados")))

_PROPS = _first(
    f"""SELECT _snapshot, _part, _pos, CAST(id AS INT) AS proposicao_id, coalesce({_safe('siglaTipo')}, '') AS tipo, coalesce({_clean(_safe('ementa'))}, '') AS ementa,
      TRY_CAST(dataApresentacao AS DATE) AS data_apresentacao FROM raw_proposicoes""",
    "proposicao_id", "ementa <> ''", "proposicao_id, tipo, ementa, data_apresentacao")
query("t3_proposicoes", _PROPS)(
    lambda spark, sf: transforms.proposicoes(table(spark, sf, "raw_proposicoes")).drop("autor_id", "tema_id"))

query("t4_votacoes", _first(
    f"""SELECT _snapshot, _part, _pos, id AS votacao_id, TRY_CAST(data AS TIMESTAMP) AS ts, {_safe('siglaOrgao')} AS orgao, {_clean('descricao')} AS descricao,
      CASE aprovacao WHEN '1' THEN TRUE WHEN '0' THEN FALSE END AS aprovacao FROM raw_votacoes""",
    "votacao_id", "ts IS NOT NULL", "votacao_id, strftime(ts, '%Y-%m-%d %H:%M') AS data, orgao, descricao, aprovacao"))(
    lambda spark, sf: transforms.votacoes(table(spark, sf, "raw_votacoes")).select(
        "votacao_id", F.date_format("data", "yyyy-MM-dd HH:mm").alias("data"), "orgao", "descricao", "aprovacao"))

_EXPENSES = f"""SELECT _snapshot, _part, _pos, codDocumento AS cod_documento, coalesce(CAST(CAST(parcela AS DOUBLE) AS INT), 0) AS parcela, deputado_id,
      CAST(ano AS INT) AS ano, CAST(mes AS INT) AS mes, {_clean('tipoDespesa')} AS tipo_despesa, TRY_CAST(substr(dataDocumento, 1, 10) AS DATE) AS data_documento,
      TRY_CAST(valorDocumento AS DECIMAL(12,2)) AS valor_documento, CAST(valorLiquido AS DECIMAL(12,2)) AS valor_liquido,
      coalesce(CAST(valorGlosa AS DECIMAL(12,2)), 0) AS valor_glosa, CAST(NULL AS INT) AS cod_lote, {_clean('nomeFornecedor')} AS fornecedor_nome,
      regexp_replace(cnpjCpfFornecedor, '[./-]', '', 'g') AS fornecedor_cnpj FROM raw_despesas"""
_EXPENSE_COLUMNS = """cod_documento, parcela, deputado_id, ano, mes, tipo_despesa, data_documento, CAST(valor_documento AS DOUBLE) AS valor_documento,
      CAST(valor_liquido AS DOUBLE) AS valor_liquido, CAST(valor_glosa AS DOUBLE) AS valor_glosa, cod_lote, fornecedor_nome, fornecedor_cnpj"""
query("t5_despesas", _first(_EXPENSES, "cod_documento, parcela", "valor_documento > 0", _EXPENSE_COLUMNS))(
    lambda spark, sf: transforms.despesas(table(spark, sf, "raw_despesas")).drop(
        "tipo_documento", "num_documento", "num_ressarcimento", "url_documento"))

_AUTHOR_ROWS = f"""SELECT _snapshot, _part, _pos, proposicao_id, TRY_CAST(nullif(regexp_extract(uri, '(?:^|/)([0-9]+)/*$', 1), '') AS INT) AS autor_id,
      coalesce(tipo, 'Desconhecido') AS autor_tipo,
      CASE WHEN uri LIKE '%/deputados/%' THEN CAST(regexp_extract(uri, '([0-9]+)/*$', 1) AS INT) END AS deputado_id,
      CASE WHEN uri LIKE '%/partidos/%' THEN CAST(regexp_extract(uri, '([0-9]+)/*$', 1) AS INT) END AS partido_id,
      coalesce({_clean(_safe('nome'))}, '(sem nome)') AS nome_autor, CAST(codTipo AS INT) AS cod_tipo_autor,
      CAST(ordemAssinatura AS INT) AS ordem_assinatura, coalesce(proponente = '1', FALSE) AS proponente, uri AS uri_autor FROM raw_autores"""
_AUTHORS_COLUMNS = "proposicao_id, autor_id, autor_tipo, deputado_id, partido_id, nome_autor, cod_tipo_autor, ordem_assinatura, proponente, uri_autor"
_AUTHOR_KEYS = "proposicao_id, autor_tipo, nome_autor, coalesce(uri_autor, '')"
_AUTHORS = _first(_AUTHOR_ROWS, _AUTHOR_KEYS, "TRUE", f"{_AUTHORS_COLUMNS}, _snapshot, _part, _pos")
query("t6_autores", _first(_AUTHOR_ROWS, _AUTHOR_KEYS, "TRUE", _AUTHORS_COLUMNS))(
    lambda spark, sf: transforms.autores(table(spark, sf, "raw_autores")).drop("raw_payload"))

_MAIN = f"""SELECT proposicao_id, CAST(n AS INT) AS qtd_autores, nome_autor AS autor_principal_nome, autor_tipo AS autor_principal_tipo,
      deputado_id AS autor_principal_deputado_id, partido_id AS autor_principal_partido_id FROM (
      SELECT *, count(*) OVER (PARTITION BY proposicao_id) AS n, row_number() OVER (PARTITION BY proposicao_id ORDER BY
        CASE WHEN proponente THEN 0 WHEN ordem_assinatura IS NOT NULL THEN 1 ELSE 2 END, coalesce(ordem_assinatura, 999999),
        _snapshot, _part, _pos) AS r FROM ({_AUTHORS}) a) m WHERE r = 1"""
query("t7_main_author", _MAIN)(
    lambda spark, sf: transforms.main_authors(transforms.autores(table(spark, sf, "raw_autores"), keep_origin=True)))

_VOTES = _first(
    f"""SELECT _snapshot, _part, _pos, votacao_id, CAST(voter_id AS INT) AS deputado_id, {_clean(_safe('tipoVoto'))} AS tipo_voto,
      {_safe('voter_party')} AS sigla_partido_voto, 'SP' AS sigla_uf_voto FROM raw_votos""",
    "votacao_id, deputado_id", "deputado_id IS NOT NULL", "votacao_id, deputado_id, tipo_voto, sigla_partido_voto, sigla_uf_voto")
query("t8_votos", _VOTES)(
    lambda spark, sf: transforms.votos(raw_votos(spark, sf)).drop("raw_payload", "data_registro_voto"))

_DIRECT = "nullif(uri_direct, '')"
_OWN = "nullif(own_id, '0')"
_HAS_FIRST = "CAST(votacao_id AS BIGINT) % 5 <= 2"
_LINK = f"coalesce({_DIRECT}, CASE WHEN {_OWN} IS NULL AND {_HAS_FIRST} THEN first_uri END)"
_LINKS = f"""SELECT votacao_id, coalesce(CAST({_OWN} AS INT), CASE WHEN {_HAS_FIRST} THEN CAST(nullif(first_id, '0') AS INT) END,
      TRY_CAST(nullif(regexp_extract({_LINK}, '([0-9]+)/*$', 1), '') AS INT)) AS proposicao_id, {_LINK} AS uri_proposicao,
      {_clean("coalesce(nullif(objeto, ''), descricao)")} AS objeto_votacao, 7 AS cod_tipo_votacao FROM raw_links"""
query("t9_vote_links", _LINKS)(lambda spark, sf: transforms.vote_links(raw_details(spark, sf)))

# --- readers: the tables are landed as raw envelopes, then read back ----------------


def _landed(spark, df, entity, snapshots, endpoint=None):
    """Land one listing per (snapshot name, frame) in a fresh raw folder."""
    raw_dir = scratch_path(spark, "raw")
    for name in snapshots:
        env.land(df, raw_dir, entity, name, endpoint=endpoint)
    return raw_dir


def _proposition_records(spark, sf):
    return table(spark, sf, "raw_proposicoes").select("id", "siglaTipo", "ementa", "dataApresentacao")


@query("s1_latest_snapshot", "SELECT c_name AS nome, CAST(c_custkey AS VARCHAR) AS id FROM customer")
def _s1(spark, sf):
    raw_dir = scratch_path(spark, "raw")
    parties = load(spark, sf, "supplier").selectExpr("CAST(s_suppkey AS STRING) AS id", "s_name AS nome")
    env.land(parties, raw_dir, "partidos", "2026-01-01T00-00-00Z")
    newer = load(spark, sf, "customer").selectExpr("CAST(c_custkey AS STRING) AS id", "c_name AS nome")
    env.land(newer, raw_dir, "partidos", "2026-01-02T00-00-00Z")
    env.land(parties, raw_dir, "partidos", "2026-01-03T00-00-00Z_7")  # a detail, not a listing
    return datasets.read_dataset(spark, raw_dir, "partidos", latest=True).select("nome", "id")


@query("s2_all_snapshots", """
    SELECT _snapshot, n, ids FROM (SELECT 'a' AS k, count(*) AS n, count(DISTINCT id) AS ids FROM raw_proposicoes) x
    CROSS JOIN (SELECT '2026-01-01T00-00-00Z.json' AS _snapshot UNION ALL SELECT '2026-01-02T00-00-00Z.json') s""")
def _s2(spark, sf):
    raw_dir = _landed(spark, _proposition_records(spark, sf), "proposicoes", ["2026-01-01T00-00-00Z", "2026-01-02T00-00-00Z"])
    rows = datasets.read_dataset(spark, raw_dir, "proposicoes")
    return rows.groupBy("_snapshot").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("ids"))


@query("s3_listing_vs_detail", """
    SELECT 'listing' AS kind, count(*) AS n FROM customer UNION ALL SELECT 'detail', count(*) FROM customer""")
def _s3(spark, sf):
    rows = load(spark, sf, "customer").selectExpr("CAST(c_custkey AS STRING) AS id", "c_name AS nome")
    raw_dir = _landed(spark, rows, "deputados", ["2026-01-01T00-00-00Z", "2026-01-01T00-00-00Z_12"])
    docs = env.read_envelopes(spark, raw_dir, "deputados", "ARRAY<STRUCT<id: STRING, nome: STRING>>")
    kind = F.when(env.is_listing(F.col("_snapshot")), "listing").otherwise("detail")
    return docs.groupBy(kind.alias("kind")).agg(F.sum(F.size("dados")).alias("n"))


@query("s12_page_concat", "SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS nome FROM customer")
def _s12(spark, sf):
    """Many pages of one listing read as one."""
    rows = load(spark, sf, "customer").selectExpr("CAST(c_custkey AS STRING) AS id", "c_name AS nome")
    raw_dir = scratch_path(spark, "raw")
    env.land(rows, raw_dir, "partidos", "2026-01-01T00-00-00Z", page_size=15)
    return datasets.read_dataset(spark, raw_dir, "partidos").select("id", "nome")


@query("s12_many_partitions", """
    SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS id, count(*) AS vezes, TRUE AS origem_unica FROM lineitem GROUP BY 1""")
def _s12_many(spark, sf):
    """A landing of 64 tasks: every row comes back once, under an origin of its own."""
    lines = load(spark, sf, "lineitem")
    rows = lines.selectExpr("concat(l_orderkey, '-', l_linenumber) AS id", "'t' AS ementa").repartition(64)
    raw_dir = _landed(spark, rows, "proposicoes", ["2026-01-01T00-00-00Z"])
    return _origins(datasets.read_dataset(spark, raw_dir, "proposicoes"), max(64, -(-lines.count() // 500_000)))


def _origins(read, tasks):
    """(id, vezes, origem_unica): rows of each id, and whether none of them shares its origin.

    Origins are long texts that are shuffled as a few bytes: ``tasks`` follows the rows instead."""
    placed = read.select("id", *env.ORIGIN).repartition(tasks, *env.ORIGIN).withColumn(
        "rows", F.count(F.lit(1)).over(Window.partitionBy(*env.ORIGIN)))
    return placed.groupBy("id").agg(F.count(F.lit(1)).alias("vezes"), F.bool_and(F.col("rows") == 1).alias("origem_unica"))


def _expense_dir(spark, sf):
    rows = table(spark, sf, "raw_despesas").drop(*env.ORIGIN)
    endpoint = F.concat(F.lit("/deputados/"), F.col("_owner"), F.lit("/despesas"))
    raw_dir = scratch_path(spark, "raw")
    fields = [c for c in rows.columns if c != "deputado_id"]
    # the landed record keeps the owner in the endpoint only
    owned = rows.withColumn("_owner", F.col("deputado_id").cast("string"))
    pages = owned.select(*fields, "_owner")
    env.land(pages, raw_dir, "deputados_despesas", "2026-01-01T00-00-00Z_lote", endpoint=endpoint)
    return raw_dir


@query("s4_sub_resource", """
    SELECT CAST(deputado_id AS INT) AS deputado_id, codDocumento, parcela, nomeFornecedor FROM raw_despesas""")
def _s4(spark, sf):
    return datasets.read_dataset(spark, _expense_dir(spark, sf), "deputados_despesas").select(
        "deputado_id", "codDocumento", "parcela", "nomeFornecedor")


query("s5_flatten_json", "SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS INT) AS k FROM events")(
    lambda spark, sf: load(spark, sf, "events").select("event_id", "event_type", F.from_json("props", "k INT").alias("p")).select(
        "event_id", "event_type", "p.*"))


@query("s6_missing_columns", "SELECT CAST(c_custkey AS INT) AS proposicao_id, '' AS tipo, 'Texto de ' || c_name AS ementa, CAST(NULL AS DATE) AS data_apresentacao FROM customer")
def _s6(spark, sf):
    rows = load(spark, sf, "customer").selectExpr("CAST(c_custkey AS STRING) AS id", "'Texto de ' || c_name AS ementa")
    raw_dir = _landed(spark, rows, "proposicoes", ["2026-01-01T00-00-00Z"])
    read = datasets.read_dataset(spark, raw_dir, "proposicoes")
    return transforms.proposicoes(read).drop("autor_id", "tema_id")


query("s7_rename", """
    SELECT codDocumento AS cod_documento, CAST(ano AS INT) AS ano, CAST(mes AS INT) AS mes, TRY_CAST(valorDocumento AS DOUBLE) AS valor_documento FROM raw_despesas""")(
    lambda spark, sf: transforms.despesas_fields(table(spark, sf, "raw_despesas")).select("cod_documento", "ano", "mes", "valor_documento"))


@query("s9_detail_scan", "SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS \"nomeCivil\", c_mktsegment AS eleitoral, '42' AS sala FROM customer")
def _s9(spark, sf):
    raw_dir = scratch_path(spark, "raw")
    rows = load(spark, sf, "customer")
    record = F.struct(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("nomeCivil"), F.struct(
        F.col("c_mktsegment").alias("nomeEleitoral"), F.struct(F.lit("42").alias("sala")).alias("gabinete")).alias("ultimoStatus"))
    meta = F.struct(F.concat(F.lit("/deputados/"), F.col("c_custkey")).alias("endpoint")).alias("_meta")
    # every second detail arrives as a list of one
    both = F.when(F.col("c_custkey") % 2 == 0, F.to_json(F.struct(meta, record.alias("dados")))).otherwise(
        F.to_json(F.struct(meta, F.array(record).alias("dados"))))
    rows.select(both.alias("value")).write.text(f"{raw_dir}/deputados/2026-01-01T00-00-00Z_1.json")
    return datasets.read_dataset(spark, raw_dir, "deputados_detalhe").select(
        "id", "nomeCivil", F.col("ultimoStatus.nomeEleitoral").alias("eleitoral"), F.col("ultimoStatus.gabinete.sala").alias("sala"))


@query("s10_dataset_filters", """
    SELECT id, "siglaTipo", "dataApresentacao" FROM raw_proposicoes
    WHERE "siglaTipo" = ' A' AND TRY_CAST("dataApresentacao" AS DATE) BETWEEN DATE '1997-01-01' AND DATE '1998-12-31'""")
def _s10(spark, sf):
    raw_dir = _landed(spark, _proposition_records(spark, sf), "proposicoes", ["2026-01-01T00-00-00Z"])
    return datasets.read_dataset(
        spark, raw_dir, "proposicoes", tipo=" A", apresentacao_inicio="1997-01-01", apresentacao_fim="1998-12-31",
    ).select("id", "siglaTipo", "dataApresentacao")


@query("s11_lineage_audit", "SELECT count(*) AS registros, TRUE AS consistente, '/partidos' AS endpoint FROM customer")
def _s11(spark, sf):
    rows = load(spark, sf, "customer").selectExpr("CAST(c_custkey AS STRING) AS id", "c_name AS nome")
    raw_dir = _landed(spark, rows, "partidos", ["2026-01-01T00-00-00Z"])
    docs = env.read_envelopes(spark, raw_dir, "partidos", "ARRAY<STRUCT<id: STRING, nome: STRING>>")
    return env.lineage(docs).groupBy("endpoint").agg(
        F.sum("found").alias("registros"), F.bool_and("consistent").alias("consistente"))


query("s17_date_window", f"""
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders
    WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '{AS_OF}' - INTERVAL 20 DAY AND DATE '{AS_OF}'""")(
    lambda spark, sf: datasets.date_window(
        load(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d")), "d", AS_OF, 20))

query("s18_deputy_ids", "SELECT CAST(id AS INT) AS deputado_id FROM raw_deputados WHERE id <> '0'")(
    lambda spark, sf: datasets.deputy_ids(table(spark, sf, "raw_deputados")))


@query("s19_star_store", """
    SELECT proposicao_id, tipo, tema_id, CASE WHEN proposicao_id % 2 = 0 THEN 2 ELSE 1 END AS versao
    FROM (SELECT CAST(o_orderkey AS INT) AS proposicao_id, CASE WHEN o_orderkey % 2 = 0 THEN 'X' ELSE o_orderstatus END AS tipo,
      CAST(substr(o_orderpriority, 1, 1) AS INT) AS tema_id FROM orders) o""")
def _s19(spark, sf):
    """Two versions of a table; the reader sees the newest finished one."""
    st = store.StarStore(spark, scratch_path(spark, "star"))
    first = sql(spark, sf, "SELECT o_orderkey AS proposicao_id, o_orderstatus AS tipo, o_orderpriority AS ementa, "
                           "CAST(substr(o_orderpriority, 1, 1) AS INT) AS tema_id, 1 AS qtd_autores FROM {orders}")
    st.write("fato_proposicoes", first)
    changed = F.col("proposicao_id") % 2 == 0
    st.write("fato_proposicoes", st.read("fato_proposicoes").withColumn("tipo", F.when(changed, "X").otherwise(F.col("tipo"))).withColumn(
        "qtd_autores", F.when(changed, 2).otherwise(F.col("qtd_autores"))))
    return st.read("fato_proposicoes").select("proposicao_id", "tipo", "tema_id", F.col("qtd_autores").alias("versao"))


query("s20_row_counts", " UNION ALL ".join(f"SELECT '{t}' AS tabela, count(*) AS linhas FROM {t}" for t in (
    "dim_partidos", "dim_deputados", "dim_temas", "fato_proposicoes", "ponte_proposicao_autores", "fato_votacoes",
    "fato_votacao_votos", "fato_despesas")))(
    lambda spark, sf: store.row_counts(dict(tables(spark, sf))))

query("u13_conform", """
    SELECT CAST(o_orderkey AS INT) AS proposicao_id, CAST(NULL AS DATE) AS data_apresentacao, o_orderstatus AS tipo, o_orderpriority AS ementa,
      CAST(NULL AS INT) AS autor_id, CASE WHEN o_orderkey % 2 = 0 THEN 7 END AS tema_id, FALSE AS autores_carregados, 0 AS qtd_autores FROM orders""")(
    lambda spark, sf: schemas.conform(
        sql(spark, sf, "SELECT o_orderkey AS proposicao_id, o_orderstatus AS tipo, o_orderpriority AS ementa, o_custkey AS unknown, "
                       "CASE WHEN o_orderkey % 2 = 0 THEN 7.0D ELSE CAST('NaN' AS DOUBLE) END AS tema_id FROM {orders}"),
        "fato_proposicoes").select("proposicao_id", "data_apresentacao", "tipo", "ementa", "autor_id", "tema_id", "autores_carregados", "qtd_autores"))


def _landed_core(spark, sf):
    """The four core listings landed as raw envelopes and loaded."""
    raw_dir = scratch_path(spark, "raw")
    for entity in ("partidos", "deputados", "proposicoes", "votacoes"):
        env.land(table(spark, sf, f"raw_{entity}").drop(*env.ORIGIN), raw_dir, entity, "2026-01-01T00-00-00Z")
    st = store.StarStore(spark, scratch_path(spark, "star"))
    load_jobs.load_core(st, raw_dir, F.current_timestamp())
    return st


@query("u12_unreadable_listings", "SELECT 'transform' AS etapa, 'Documento bruto ilegivel' AS mensagem, count(*) AS linhas FROM supplier")
def _unreadable(spark, sf):
    """Truncated documents among the listings: one error row each, and the others are loaded."""
    raw_dir = scratch_path(spark, "raw")
    for entity in ("partidos", "deputados", "proposicoes", "votacoes"):
        env.land(table(spark, sf, f"raw_{entity}").drop(*env.ORIGIN), raw_dir, entity, "2026-01-01T00-00-00Z")
    cut = load(spark, sf, "supplier").selectExpr("""concat('{"_meta": {"endpoint": "/proposicoes"}, "dados": [{"id": ', s_suppkey) AS value""")
    cut.write.text(f"{raw_dir}/proposicoes/2026-01-02T00-00-00Z.json")
    st = store.StarStore(spark, scratch_path(spark, "star"))
    load_jobs.load_core(st, raw_dir, F.current_timestamp())
    return st.read("pipeline_erros").groupBy("etapa", "mensagem").agg(F.count(F.lit(1)).alias("linhas"))


query("u12_core_load", f"""
    SELECT 'dim_partidos' AS tabela, count(DISTINCT CAST(id AS DOUBLE)) AS linhas FROM raw_partidos WHERE {_safe('sigla')} IS NOT NULL
    UNION ALL SELECT 'dim_deputados', count(DISTINCT id) FROM raw_deputados WHERE {_safe('siglaUf')} IS NOT NULL
    UNION ALL SELECT 'fato_proposicoes', count(DISTINCT id) FROM raw_proposicoes WHERE {_safe('ementa')} IS NOT NULL
    UNION ALL SELECT 'fato_votacoes', count(DISTINCT id) FROM raw_votacoes WHERE data <> 'x'""")(
    lambda spark, sf: _core_counts(_landed_core(spark, sf)))


def _core_counts(st):
    return store.row_counts({name: st.read(name) for name in load_jobs.CORE_ORDER})


@query("u11_error_log", "SELECT etapa, entidade_tipo, count(*) AS n FROM (SELECT 'autores' AS etapa, event_type AS entidade_tipo FROM events UNION ALL SELECT 'votos', event_type FROM events) e GROUP BY 1, 2")
def _u11(spark, sf):
    """Two appends to the error log."""
    st = store.StarStore(spark, scratch_path(spark, "star"))
    for stage in ("autores", "votos"):
        st.write("pipeline_erros", load(spark, sf, "events").select(F.lit(stage).alias("etapa"), F.col("event_type").alias("entidade_tipo")))
    return st.read("pipeline_erros").groupBy("etapa", "entidade_tipo").agg(F.count(F.lit(1)).alias("n"))


# --- joins and lookups ----------------------------------------------------------

query("j9_resolve_party", """
    SELECT s_suppkey AS deputado_id, m.partido_id FROM (SELECT s_suppkey, 'NATION_' || CAST(s_suppkey % 30 AS VARCHAR) AS sigla FROM supplier) s
    LEFT JOIN (SELECT sigla, max(partido_id) AS partido_id FROM dim_partidos GROUP BY sigla) m ON m.sigla = s.sigla""")(
    lambda spark, sf: U.resolve_party(
        sql(spark, sf, "SELECT s_suppkey AS deputado_id, 'NATION_' || CAST(s_suppkey % 30 AS STRING) AS sigla_partido FROM {supplier}"),
        table(spark, sf, "dim_partidos")).select("deputado_id", "partido_id"))

query("j10_orphan_authors", """
    SELECT ppa.proposicao_id, ppa.deputado_id, ppa.nome_autor FROM ponte_proposicao_autores ppa
    WHERE ppa.deputado_id IS NOT NULL AND ppa.deputado_id NOT IN (SELECT deputado_id FROM dim_deputados)""")(
    lambda spark, sf: bridges.orphan_authors(
        table(spark, sf, "ponte_proposicao_autores"), table(spark, sf, "dim_deputados")).select("proposicao_id", "deputado_id", "nome_autor"))

# --- upserts: stored rows keep their key, the batch doubles it, so that some keys
# --- meet, some are new and some stay untouched ----------------------------------

_NOW_SQL = "DATE '2026-06-14'"


def _upsert(name, policy, stored, batch, columns, now=True):
    """Register an upsert with a FULL JOIN oracle. ``stored`` and ``batch`` are
    SQL texts; ``columns`` maps each column to its rule."""
    keys = [c for c, r in columns.items() if r in ("key", "blank_key")]
    match = lambda c: f"coalesce(t.{c}, '') = coalesce(s.{c}, '')" if columns[c] == "blank_key" else f"t.{c} = s.{c}"
    on = " AND ".join(match(k) for k in keys)
    rules = {
        "key": "coalesce(t.{c}, s.{c})", "blank_key": "coalesce(t.{c}, s.{c})",
        "overwrite": "CASE WHEN s.given THEN s.{c} ELSE t.{c} END", "keep_old": "coalesce(t.{c}, s.{c})",
        "prefer_new": "coalesce(s.{c}, t.{c})", "insert_only": "CASE WHEN t.stored THEN t.{c} ELSE s.{c} END",
        "untouched": "t.{c}", "stamp": f"CASE WHEN s.given THEN {_NOW_SQL} ELSE t.{{c}} END",
        "born": f"CASE WHEN t.stored THEN t.{{c}} ELSE {_NOW_SQL} END",
    }
    out = ", ".join(
        (r[8:].replace("{c}", c) if r.startswith("default:") else rules[r].format(c=c)) + f" AS {c}" for c, r in columns.items())
    money = lambda c: f"CAST({c} AS DOUBLE) AS {c}" if c.startswith("valor_") else c
    sql_text = f"""SELECT {", ".join(money(c) for c in columns)} FROM (SELECT {out}
      FROM (SELECT *, TRUE AS stored FROM ({stored}) a) t FULL JOIN (SELECT *, TRUE AS given FROM ({batch}) b) s ON {on}) u"""
    query(name, sql_text)(lambda spark, sf: U.upsert(
        sql(spark, sf, stored).select(*columns), sql(spark, sf, batch), policy, F.lit("2026-06-14").cast("date")))


_upsert("u1_upsert_partidos", U.POLICIES["dim_partidos"],
        "SELECT s_suppkey AS partido_id, s_name AS sigla, s_name AS nome, DATE '2020-01-01' AS ingested_at FROM {supplier}",
        "SELECT s_suppkey * 2 AS partido_id, 'N' || s_name AS sigla, CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE s_name END AS nome FROM {supplier}",
        {"partido_id": "key", "sigla": "overwrite", "nome": "overwrite", "ingested_at": "stamp"})

_upsert("u1_upsert_temas", U.POLICIES["dim_temas"],
        "SELECT p_partkey AS tema_id, p_name AS nome, p_type AS descricao, p_size > 20 AS critico FROM {part}",
        "SELECT p_partkey * 2 AS tema_id, 'N' || p_name AS nome, CASE WHEN p_size > 10 THEN p_brand END AS descricao, p_size > 30 AS critico FROM {part}",
        {"tema_id": "key", "nome": "overwrite", "descricao": "overwrite", "critico": "overwrite"})

_upsert("u2_upsert_deputados", U.POLICIES["dim_deputados"],
        "SELECT c_custkey AS deputado_id, c_name AS nome, c_nationkey AS partido_id, 'SP' AS uf, 'Em exercicio' AS situacao, c_mktsegment AS email, DATE '2020-01-01' AS ingested_at FROM {customer}",
        "SELECT c_custkey * 2 AS deputado_id, 'N' || c_name AS nome, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_nationkey END AS partido_id, 'RJ' AS uf, 'Em exercicio' AS situacao, CAST(NULL AS STRING) AS email FROM {customer}",
        {"deputado_id": "key", "nome": "overwrite", "partido_id": "overwrite", "uf": "overwrite", "situacao": "overwrite", "email": "overwrite", "ingested_at": "stamp"})

_STORED_PROPS = """SELECT o_orderkey AS proposicao_id, CAST(o_orderdate AS DATE) AS data_apresentacao, o_orderstatus AS tipo, o_orderpriority AS ementa,
      CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_custkey END AS autor_id, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE 3 END AS tema_id,
      'velho' AS resumo_executivo, TRUE AS autores_carregados, 5 AS qtd_autores, DATE '2020-01-01' AS ingested_at FROM {orders}"""
_BATCH_PROPS = """SELECT o_orderkey * 2 AS proposicao_id, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS data_apresentacao,
      'N' || o_orderstatus AS tipo, 'nova ' || o_orderpriority AS ementa, CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE o_custkey + 1 END AS autor_id,
      CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE 7 END AS tema_id FROM {orders}"""
_upsert("u3_upsert_proposicoes", U.POLICIES["fato_proposicoes"], _STORED_PROPS, _BATCH_PROPS,
        {"proposicao_id": "key", "data_apresentacao": "overwrite", "tipo": "overwrite", "ementa": "overwrite", "autor_id": "prefer_new",
         "tema_id": "keep_old", "resumo_executivo": "untouched", "autores_carregados": "default:coalesce(t.{c}, FALSE)",
         "qtd_autores": "default:coalesce(t.{c}, 0)", "ingested_at": "stamp"})

_upsert("u4_upsert_votacoes", U.POLICIES["fato_votacoes"],
        """SELECT CAST(o_orderkey AS STRING) AS votacao_id, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_custkey END AS proposicao_id, CAST(o_orderdate AS DATE) AS data,
           o_orderpriority AS orgao, 'd' AS descricao, o_orderstatus = 'F' AS aprovacao, TRUE AS votos_carregados, 9 AS qtd_votos, DATE '2020-01-01' AS ingested_at FROM {orders}""",
        """SELECT CAST(o_orderkey * 2 AS STRING) AS votacao_id, o_custkey + 1 AS proposicao_id, CAST(o_orderdate AS DATE) AS data, 'N' AS orgao,
           CAST(NULL AS STRING) AS descricao, CASE o_orderstatus WHEN 'F' THEN TRUE WHEN 'O' THEN FALSE END AS aprovacao FROM {orders}""",
        {"votacao_id": "key", "proposicao_id": "keep_old", "data": "overwrite", "orgao": "overwrite", "descricao": "overwrite", "aprovacao": "overwrite",
         "votos_carregados": "default:coalesce(t.{c}, FALSE)", "qtd_votos": "default:coalesce(t.{c}, 0)", "ingested_at": "stamp"})

_upsert("u5_upsert_despesas", U.POLICIES["fato_despesas"],
        """SELECT CAST(o_orderkey AS STRING) AS cod_documento, 1 AS parcela, o_custkey AS deputado_id, 2001 AS ano, 1 AS mes, 'velha' AS tipo_despesa,
           CAST(o_totalprice AS DECIMAL(12,2)) AS valor_documento, CAST(NULL AS DECIMAL(12,2)) AS valor_liquido, CAST(1 AS DECIMAL(12,2)) AS valor_glosa,
           o_orderpriority AS fornecedor_nome, DATE '2020-01-01' AS ingested_at FROM {orders}""",
        """SELECT CAST(o_orderkey * 2 AS STRING) AS cod_documento, 1 AS parcela, o_custkey + 1 AS deputado_id, 2002 AS ano, 2 AS mes, 'nova' AS tipo_despesa,
           CAST(o_totalprice AS DECIMAL(12,2)) AS valor_documento, CAST(o_totalprice AS DECIMAL(12,2)) AS valor_liquido, CAST(2 AS DECIMAL(12,2)) AS valor_glosa,
           'novo' AS fornecedor_nome FROM {orders}""",
        {"cod_documento": "key", "parcela": "key", "deputado_id": "insert_only", "ano": "insert_only", "mes": "insert_only", "tipo_despesa": "overwrite",
         "valor_documento": "overwrite", "valor_liquido": "overwrite", "valor_glosa": "overwrite", "fornecedor_nome": "insert_only", "ingested_at": "stamp"})

_upsert("u6_upsert_ponte", U.POLICIES["ponte_proposicao_autores"],
        """SELECT o_orderkey AS proposicao_id, 'Deputado(a)' AS autor_tipo, o_orderpriority AS nome_autor, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'u' || o_orderstatus END AS uri_autor,
           1 AS ordem_assinatura, TRUE AS proponente, DATE '2020-01-01' AS criado_em, DATE '2020-01-01' AS atualizado_em FROM {orders}""",
        """SELECT o_orderkey * 2 AS proposicao_id, 'Deputado(a)' AS autor_tipo, o_orderpriority AS nome_autor, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'u' || o_orderstatus END AS uri_autor,
           CASE WHEN o_orderkey % 2 = 0 THEN 2 END AS ordem_assinatura, FALSE AS proponente FROM {orders}""",
        {"proposicao_id": "key", "autor_tipo": "key", "nome_autor": "key", "uri_autor": "blank_key", "ordem_assinatura": "overwrite", "proponente": "overwrite",
         "criado_em": "born", "atualizado_em": "stamp"})

_upsert("u7_upsert_votos", U.POLICIES["fato_votacao_votos"],
        "SELECT CAST(event_id AS STRING) AS votacao_id, user_id AS deputado_id, event_type AS tipo_voto, 'P' AS sigla_partido_voto, DATE '2020-01-01' AS criado_em, DATE '2020-01-01' AS atualizado_em FROM {events}",
        "SELECT CAST(event_id * 2 AS STRING) AS votacao_id, user_id % 3 AS deputado_id, CASE WHEN event_type <> 'error' THEN event_type END AS tipo_voto, 'Q' AS sigla_partido_voto FROM {events}",
        {"votacao_id": "key", "deputado_id": "key", "tipo_voto": "overwrite", "sigla_partido_voto": "overwrite", "criado_em": "born", "atualizado_em": "stamp"})

query("u0_row_order", """
    SELECT l_orderkey AS proposicao_id, arg_max(l_returnflag, ord) AS tipo, min_by(tema, ord) FILTER (WHERE tema IS NOT NULL) AS tema_id,
      max_by(autor, ord) FILTER (WHERE autor IS NOT NULL) AS autor_id
    FROM (SELECT *, CASE WHEN l_linenumber > 3 THEN l_suppkey END AS tema, CASE WHEN l_quantity > 25 THEN l_partkey END AS autor,
      row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_suppkey, l_partkey, l_extendedprice, l_linenumber, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus) AS ord
      FROM lineitem) x GROUP BY 1""")(
    lambda spark, sf: U.fold_batch(
        sql(spark, sf, """SELECT *, l_orderkey AS proposicao_id, l_returnflag AS tipo, CASE WHEN l_linenumber > 3 THEN l_suppkey END AS tema_id,
            CASE WHEN l_quantity > 25 THEN l_partkey END AS autor_id FROM {lineitem}"""),
        U.POLICIES["fato_proposicoes"],
        ["l_shipdate", "l_suppkey", "l_partkey", "l_extendedprice", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus"],
    ).select("proposicao_id", "tipo", "tema_id", "autor_id"))

query("u8_author_flags", f"""
    SELECT p.proposicao_id, (m.proposicao_id IS NOT NULL OR p.autores_carregados) AS autores_carregados, coalesce(m.qtd_autores, p.qtd_autores) AS qtd_autores,
      CASE WHEN m.proposicao_id IS NOT NULL THEN m.autor_principal_nome ELSE p.autor_principal_nome END AS autor_principal_nome,
      m.autor_principal_deputado_id FROM fato_proposicoes p LEFT JOIN ({_MAIN}) m ON m.proposicao_id = p.proposicao_id""")(
    lambda spark, sf: U.set_author_flags(
        table(spark, sf, "fato_proposicoes").select("proposicao_id", "autores_carregados", "qtd_autores", "autor_principal_nome",
                                                    F.lit(None).cast("int").alias("autor_principal_deputado_id")),
        transforms.main_authors(transforms.autores(table(spark, sf, "raw_autores"), keep_origin=True))))

query("u9_vote_flags", """
    SELECT v.votacao_id, (s.votacao_id IS NOT NULL OR v.votos_carregados) AS votos_carregados, coalesce(s.n, v.qtd_votos) AS qtd_votos
    FROM fato_votacoes v LEFT JOIN (SELECT votacao_id, CAST(count(*) AS INT) AS n FROM fato_votacao_votos GROUP BY 1) s ON s.votacao_id = v.votacao_id""")(
    lambda spark, sf: U.set_vote_flags(
        table(spark, sf, "fato_votacoes").select("votacao_id", "votos_carregados", "qtd_votos"),
        table(spark, sf, "fato_votacao_votos").groupBy("votacao_id").agg(F.count(F.lit(1)).cast("int").alias("qtd_votos"))))

query("u10_vote_links", f"""
    SELECT v.votacao_id, coalesce(p.proposicao_id, v.proposicao_id) AS proposicao_id, coalesce(l.uri_proposicao, 'antiga') AS uri_proposicao,
      l.objeto_votacao, l.cod_tipo_votacao FROM fato_votacoes v JOIN ({_LINKS}) l ON l.votacao_id = v.votacao_id
    LEFT JOIN fato_proposicoes p ON p.proposicao_id = l.proposicao_id""")(
    lambda spark, sf: U.set_vote_links(
        table(spark, sf, "fato_votacoes").select(
            "votacao_id", "proposicao_id", F.lit("antiga").alias("uri_proposicao"), F.lit(None).cast("string").alias("objeto_votacao"),
            F.lit(None).cast("int").alias("cod_tipo_votacao")),
        transforms.vote_links(raw_details(spark, sf)), table(spark, sf, "fato_proposicoes")))

query("u14_set_values", """
    SELECT p.proposicao_id, CASE WHEN l.k IS NOT NULL THEN l.q ELSE p.tema_id END AS tema_id, p.resumo_executivo FROM fato_proposicoes p
    LEFT JOIN (SELECT l_orderkey AS k, min(l_linenumber) AS q FROM lineitem GROUP BY 1) l ON l.k = p.proposicao_id""")(
    lambda spark, sf: U.set_values(
        table(spark, sf, "fato_proposicoes").select("proposicao_id", "tema_id", "resumo_executivo"),
        load(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("proposicao_id")).agg(F.min("l_linenumber").alias("tema_id")),
        ["tema_id"]))

# --- bridge jobs ------------------------------------------------------------------

query("b1_pending_authorship", """
    SELECT proposicao_id FROM fato_proposicoes WHERE NOT autores_carregados""")(
    lambda spark, sf: bridges.pending_authorship(table(spark, sf, "fato_proposicoes")))
query("b2_pending_votes", """
    SELECT votacao_id FROM fato_votacoes WHERE NOT votos_carregados""")(
    lambda spark, sf: bridges.pending_votes(table(spark, sf, "fato_votacoes")))


def _authorship(spark, sf):
    """All pending propositions; the newest document of some cannot be read,
    others never landed."""
    props = table(spark, sf, "fato_proposicoes")
    records = table(spark, sf, "raw_autores").withColumn("_snapshot", F.lit("s"))
    landed = sql(spark, sf, "SELECT o_orderkey AS proposicao_id, 's' AS _snapshot, o_orderkey % 11 = 0 AS _unreadable, o_custkey FROM {orders}").where(
        F.col("o_custkey") % 13 != 0).drop("o_custkey")
    return bridges.authorship(bridges.pending_authorship(props, limit=None), landed, records, table(spark, sf, "dim_deputados"), F.lit(None).cast("timestamp"))


_B3_BASE = f"""alvos AS (SELECT p.proposicao_id, o.o_custkey % 13 <> 0 AND p.proposicao_id % 11 <> 0 AS lida, o.o_custkey % 13 = 0 AS ausente
      FROM fato_proposicoes p JOIN orders o ON o.o_orderkey = p.proposicao_id WHERE NOT p.autores_carregados),
    autores AS (SELECT a.* FROM ({_first(_AUTHOR_ROWS.replace("SELECT _snapshot,", "SELECT 's' AS _snapshot,"), _AUTHOR_KEYS, "TRUE", f"{_AUTHORS_COLUMNS}, _part, _pos")}) a
      JOIN alvos t ON t.proposicao_id = a.proposicao_id AND t.lida),
    orfaos AS (SELECT * FROM autores WHERE deputado_id IS NOT NULL AND deputado_id NOT IN (SELECT deputado_id FROM dim_deputados)),
    sem AS (SELECT proposicao_id FROM alvos WHERE lida AND proposicao_id NOT IN (SELECT proposicao_id FROM autores))"""
query("b3_authorship_job", f"""WITH {_B3_BASE}
    SELECT (SELECT count(*) FROM alvos) AS alvos, (SELECT count(*) FROM alvos WHERE lida) AS processadas,
      (SELECT count(DISTINCT proposicao_id) FROM autores) AS com_autores, (SELECT count(*) FROM sem) AS sem_autores,
      (SELECT count(*) FROM autores) AS autores_inseridos, (SELECT count(*) FROM orfaos) AS autores_orfaos,
      (SELECT count(*) FROM alvos WHERE NOT lida) AS erros""")(lambda spark, sf: _authorship(spark, sf)["counters"])
query("b3_authorship_flags", f"""WITH {_B3_BASE}
    SELECT t.proposicao_id, CAST(count(a.proposicao_id) AS INT) AS qtd_autores FROM alvos t LEFT JOIN autores a ON a.proposicao_id = t.proposicao_id
    WHERE t.lida GROUP BY 1""")(lambda spark, sf: _authorship(spark, sf)["flags"].select("proposicao_id", "qtd_autores"))
query("b5_error_rows", f"""WITH {_B3_BASE}
    SELECT 'autores' AS etapa, 'proposicao' AS entidade_tipo, CAST(proposicao_id AS VARCHAR) AS entidade_id, '{bridges.NO_AUTHORS}' AS mensagem FROM sem
    UNION ALL SELECT 'autores', 'autor', CAST(deputado_id AS VARCHAR),
      'Deputado autor sem correspondencia em dim_deputados (prop ' || CAST(proposicao_id AS VARCHAR) || ')' FROM orfaos
    UNION ALL SELECT 'autores', 'proposicao', CAST(proposicao_id AS VARCHAR),
      CASE WHEN ausente THEN '{bridges.NOT_LANDED}' ELSE '{bridges.UNREADABLE}' END FROM alvos WHERE NOT lida""")(
    lambda spark, sf: _authorship(spark, sf)["errors"].drop("payload", "criado_em"))


def _roll_call(spark, sf):
    votings = table(spark, sf, "fato_votacoes")
    landed = votings.select("votacao_id", F.lit("").alias("_snapshot"), (F.length("votacao_id") == 2).alias("_unreadable"))
    return bridges.roll_call(bridges.pending_votes(votings, limit=None), landed, raw_votos(spark, sf), raw_details(spark, sf),
                             F.lit(None).cast("timestamp"))


_B4_BASE = f"""alvos AS (SELECT votacao_id, length(votacao_id) <> 2 AS lida FROM fato_votacoes WHERE NOT votos_carregados),
    votos AS (SELECT v.* FROM ({_VOTES}) v JOIN alvos t ON t.votacao_id = v.votacao_id AND t.lida)"""
query("b4_roll_call_job", f"""WITH {_B4_BASE}
    SELECT (SELECT count(*) FROM alvos) AS alvos, (SELECT count(*) FROM alvos WHERE lida) AS processadas,
      (SELECT count(DISTINCT votacao_id) FROM votos) AS com_votos,
      (SELECT count(*) FROM alvos WHERE lida AND votacao_id NOT IN (SELECT votacao_id FROM votos)) AS sem_votos,
      (SELECT count(*) FROM votos) AS votos_inseridos,
      (SELECT count(*) FROM ({_LINKS}) l JOIN alvos t ON t.votacao_id = l.votacao_id WHERE l.proposicao_id IS NOT NULL) AS vinculadas,
      (SELECT count(*) FROM alvos WHERE NOT lida) AS erros""")(lambda spark, sf: _roll_call(spark, sf)["counters"])
query("b4_roll_call_flags", f"""WITH {_B4_BASE}
    SELECT t.votacao_id, CAST(count(v.votacao_id) AS INT) AS qtd_votos FROM alvos t LEFT JOIN votos v ON v.votacao_id = t.votacao_id
    WHERE t.lida GROUP BY 1""")(lambda spark, sf: _roll_call(spark, sf)["flags"])

# --- quality ----------------------------------------------------------------------


def _checked(spark, sf):
    t = tables(spark, sf)
    return {name: t[name] for name in ("dim_deputados", "dim_partidos", "dim_temas", "fato_proposicoes", "fato_votacoes",
                                       "fato_votacao_votos", "fato_despesas")}


def _null_rules(table_name, columns):
    return [f"SELECT '{table_name}' AS tabela, 'nulo_{c}' AS regra, count(*) FILTER (WHERE {c} IS NULL) AS violacoes FROM {table_name}" for c in columns]


def _pk_rule(table_name, keys):
    return f"SELECT '{table_name}' AS tabela, 'pk' AS regra, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS violacoes FROM (SELECT count(*) AS n FROM {table_name} GROUP BY {keys}) g"


def _fk_rule(table_name, column, parent, key):
    return (f"SELECT '{table_name}' AS tabela, 'fk_{column}' AS regra, count(*) AS violacoes FROM {table_name} "
            f"WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT {key} FROM {parent})")


query("q1_constraints", " UNION ALL ".join(
    _null_rules("dim_deputados", ["deputado_id", "nome", "uf"]) + [_pk_rule("dim_deputados", "deputado_id")]
    + _null_rules("dim_partidos", ["partido_id", "sigla", "nome"]) + [_pk_rule("dim_partidos", "partido_id")]
    + _null_rules("dim_temas", ["tema_id", "nome", "critico"]) + [_pk_rule("dim_temas", "tema_id")]
    + _null_rules("fato_proposicoes", ["proposicao_id", "tipo", "ementa", "autores_carregados", "qtd_autores"]) + [_pk_rule("fato_proposicoes", "proposicao_id")]
    + _null_rules("fato_votacoes", ["votacao_id", "data", "votos_carregados", "qtd_votos"]) + [_pk_rule("fato_votacoes", "votacao_id")]
    + _null_rules("fato_votacao_votos", ["votacao_id", "deputado_id"]) + [_pk_rule("fato_votacao_votos", "votacao_id, deputado_id")]
    + _null_rules("fato_despesas", ["cod_documento", "parcela", "deputado_id", "ano", "mes", "tipo_despesa", "valor_documento"])
    + ["SELECT 'fato_despesas' AS tabela, 'valor_positivo' AS regra, count(*) FILTER (WHERE valor_documento <= 0) AS violacoes FROM fato_despesas",
       _pk_rule("fato_despesas", "cod_documento, parcela")]
    + [_fk_rule("dim_deputados", "partido_id", "dim_partidos", "partido_id"), _fk_rule("fato_proposicoes", "tema_id", "dim_temas", "tema_id"),
       _fk_rule("fato_proposicoes", "autor_id", "dim_deputados", "deputado_id"),
       _fk_rule("fato_votacoes", "proposicao_id", "fato_proposicoes", "proposicao_id"),
       _fk_rule("fato_despesas", "deputado_id", "dim_deputados", "deputado_id"),
       _fk_rule("fato_votacao_votos", "votacao_id", "fato_votacoes", "votacao_id")]))(
    lambda spark, sf: quality.check_constraints(_checked(spark, sf)))

_BROKEN = """(CASE WHEN valor_documento IS NULL THEN 'sem_valor ' ELSE '' END || CASE WHEN valor_documento <= 0 THEN 'valor_nao_positivo ' ELSE '' END
      || CASE WHEN extract(year FROM data_documento) > 2001 OR extract(year FROM data_documento) < 1990 THEN 'data_implausivel ' ELSE '' END)"""
query("q2_quarantine", f"""
    SELECT cod_documento, parcela, deputado_id, trim({_BROKEN}) AS motivos, count(*) AS n FROM ({_EXPENSES}) e WHERE {_BROKEN} <> '' GROUP BY 1, 2, 3, 4""")(
    lambda spark, sf: quality.quarantine_expenses(table(spark, sf, "raw_despesas"), "2000-06-01")[1].groupBy(
        "cod_documento", "parcela", "deputado_id", F.array_join("motivos", " ").alias("motivos")).agg(F.count(F.lit(1)).alias("n")))
query("q3_plausible_dates", """
    SELECT o_orderkey, extract(year FROM o_orderdate) > 2000 OR extract(year FROM o_orderdate) < 1990 AS implausivel FROM orders""")(
    lambda spark, sf: load(spark, sf, "orders").select("o_orderkey", quality.implausible_day(F.col("o_orderdate"), "1999-06-01").alias("implausivel")))
query("q4_validity_counts", f"""
    WITH e AS ({_EXPENSES}), c AS (SELECT count(*) FILTER (WHERE {_BROKEN} = '') AS validas, count(*) FILTER (WHERE {_BROKEN} <> '') AS invalidas,
      count(*) FILTER (WHERE valor_documento IS NULL) AS sv, count(*) FILTER (WHERE valor_documento <= 0) AS vnp,
      count(*) FILTER (WHERE {_BROKEN} LIKE '%data%') AS di FROM e)
    SELECT 'validas' AS situacao, validas AS linhas FROM c UNION ALL SELECT 'invalidas', invalidas FROM c UNION ALL SELECT 'motivo_sem_documento', 0
    UNION ALL SELECT 'motivo_sem_deputado', 0 UNION ALL SELECT 'motivo_sem_valor', sv FROM c UNION ALL SELECT 'motivo_valor_nao_positivo', vnp FROM c
    UNION ALL SELECT 'motivo_data_implausivel', di FROM c""")(
    lambda spark, sf: quality.validity_counts(
        transforms.despesas_fields(table(spark, sf, "raw_despesas")), quality.expense_rules("2000-06-01")))
query("q5_coverage_goals", """
    SELECT m AS metrica, p AS percentual, g AS meta, p >= g AS atingida FROM (
      SELECT 'embedding' AS m, round(100.0 * count(embedding) / count(*), 2) AS p, CAST(80 AS DOUBLE) AS g FROM fato_proposicoes
      UNION ALL SELECT 'tema', round(100.0 * count(tema_id) / count(*), 2), 70 FROM fato_proposicoes
      UNION ALL SELECT 'resumo', round(100.0 * count(resumo_executivo) / count(*), 2), 80 FROM fato_proposicoes) x""")(
    lambda spark, sf: quality.coverage(table(spark, sf, "fato_proposicoes")))
query("a16_filled_share", """
    SELECT count(*) AS total, count(*) FILTER (WHERE autores_carregados) AS preenchidas,
      round(100.0 * count(*) FILTER (WHERE autores_carregados) / nullif(count(*), 0), 2) AS pct FROM fato_proposicoes""")(
    lambda spark, sf: quality.filled_share(table(spark, sf, "fato_proposicoes"), F.col("autores_carregados")))
query("a17_bridge_fill", """
    SELECT count(*) AS linhas, count(DISTINCT proposicao_id) AS props, count(DISTINCT deputado_id) AS deps, count(DISTINCT partido_id) AS parts
    FROM ponte_proposicao_autores""")(lambda spark, sf: quality.bridge_fill(table(spark, sf, "ponte_proposicao_autores")))

# --- streams: landed files processed to the end; the batch result is the oracle -----


def _event_stream(spark, sf):
    """Events landed as JSON files and read back as a stream."""
    folder = scratch_path(spark, "events")
    load(spark, sf, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ts"), "event_type", "value") \
        .repartition(8, "event_id").write.json(folder)
    rows = spark.readStream.schema("event_id BIGINT, ts STRING, event_type STRING, value DOUBLE").option(
        "maxFilesPerTrigger", 3).json(folder)
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def _run(spark, counts, keys):
    return landing.final_counts(counts, keys, scratch_path(spark, "checkpoint"), scratch_path(spark, "stream-out"))


def _added(spark, stream, count):
    return landing.added_counts(stream, count, "qtd", scratch_path(spark, "checkpoint"), scratch_path(spark, "stream-out"))


def _newest_first(spark, sf):
    """Events whose newest days are landed first: all others arrive late, up to a month."""
    folder = scratch_path(spark, "events")
    events = load(spark, sf, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ts"), F.dayofmonth("ts").alias("d"))
    for part in (F.col("d") > 20, F.col("d").between(11, 20), F.col("d") <= 10):
        events.where(part).drop("d").write.mode("append").json(folder)
    rows = spark.readStream.schema("event_id BIGINT, ts STRING").option("maxFilesPerTrigger", 8).json(folder)
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


query("st1_stream_records", "SELECT count(*) AS n, count(DISTINCT id) AS ids FROM raw_proposicoes")(
    lambda spark, sf: _stream_landing(spark, sf))


def _stream_landing(spark, sf):
    raw_dir = _landed(spark, _proposition_records(spark, sf), "proposicoes", ["2026-01-01T00-00-00Z"])
    out = scratch_path(spark, "stream-out")
    stream = landing.stream_records(spark, raw_dir, "proposicoes", max_files=2).select("id", "ementa")
    landing.run_batches(stream, lambda batch, n: batch.write.mode("overwrite").parquet(f"{out}/b={n}"), scratch_path(spark, "checkpoint"))
    read = spark.read.schema("id STRING, ementa STRING").option("recursiveFileLookup", "true").parquet(out)
    return read.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("ids"))


@query("st2_incremental_load", """
    WITH old AS (SELECT CAST(o_orderkey AS INT) AS proposicao_id, o_orderstatus AS tipo, o_orderpriority AS ementa, 3 AS tema_id FROM orders),
    new AS (SELECT CAST(o_orderkey * 2 AS INT) AS proposicao_id, 'N' || o_orderstatus AS tipo, 'nova ' || o_orderpriority AS ementa FROM orders)
    SELECT coalesce(n.proposicao_id, o.proposicao_id) AS proposicao_id, coalesce(n.tipo, o.tipo) AS tipo, coalesce(n.ementa, o.ementa) AS ementa, o.tema_id
    FROM old o FULL JOIN new n ON n.proposicao_id = o.proposicao_id""")
def _st2(spark, sf):
    """Stored rows, then the same increment streamed twice: the replay changes nothing."""
    st = store.StarStore(spark, scratch_path(spark, "star"))
    st.write("fato_proposicoes", sql(spark, sf, "SELECT o_orderkey AS proposicao_id, o_orderstatus AS tipo, o_orderpriority AS ementa, 3 AS tema_id FROM {orders}"))
    rows = sql(spark, sf, """SELECT CAST(o_orderkey * 2 AS STRING) AS id, 'N' || o_orderstatus AS siglaTipo, 'nova ' || o_orderpriority AS ementa,
        CAST(CAST(o_orderdate AS DATE) AS STRING) AS dataApresentacao FROM {orders}""")
    raw_dir = _landed(spark, rows, "proposicoes", ["2026-01-01T00-00-00Z"])
    for _ in range(2):
        landing.load_increment(st, raw_dir, scratch_path(spark, "checkpoint"), F.current_timestamp())
    return st.read("fato_proposicoes").select("proposicao_id", "tipo", "ementa", "tema_id")


query("st3_live_counts", "SELECT event_type, count(*) AS qtd FROM events GROUP BY 1")(
    lambda spark, sf: _run(spark, _event_stream(spark, sf).groupBy("event_type").agg(F.count(F.lit(1)).alias("qtd")), ["event_type"]))
query("st4_daily_series", "SELECT CAST(ts AS DATE) AS dia, event_type, count(*) AS qtd FROM events GROUP BY 1, 2")(
    lambda spark, sf: _added(spark, _event_stream(spark, sf), lambda rows: landing.day_counts(rows, "ts", "event_type")))
query("st4_weekly_series", "SELECT CAST(date_trunc('week', ts) AS DATE) AS semana, count(*) AS qtd FROM events GROUP BY 1")(
    lambda spark, sf: _added(spark, _event_stream(spark, sf), lambda rows: landing.week_counts(rows, "ts")))
query("st5_very_late_rows", "SELECT CAST(ts AS DATE) AS dia, count(*) AS qtd FROM events GROUP BY 1")(
    lambda spark, sf: _added(spark, _newest_first(spark, sf), lambda rows: landing.day_counts(rows, "ts")))
query("st5_late_data", "SELECT CAST(date_trunc('week', ts) AS DATE) AS semana, count(*) AS qtd FROM events GROUP BY 1")(
    lambda spark, sf: _run(spark, landing.week_counts(
        landing.deduplicated(_twice(_event_stream(spark, sf)), ["event_id"], "ts", "40 days"), "ts"), ["semana"]))


def _twice(stream):
    """Every row arrives twice."""
    return stream.withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_copy")
