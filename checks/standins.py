"""Stand-in star tables over the driver's tables.

The same SQL text defines each stand-in for Spark and, as a CTE, for DuckDB.
Every stand-in covers all rows of its source. Keys are shifted or scaled, not
filtered, so that orphans, NULL parties, unused themes and unmatched votes
occur at every scale factor.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

SOURCES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# The last order date of the generated data; "today" in the date windows.
AS_OF = "2001-08-01"
REF_YEAR = 2001

STAR: dict[str, str] = {
    "dim_partidos": """
        SELECT n_nationkey AS partido_id, n_name AS sigla, n_name AS nome FROM {nation}""",
    "dim_deputados": """
        SELECT s_suppkey AS deputado_id, s_name AS nome,
               CASE WHEN s_suppkey % 20 = 7 THEN NULL ELSE s_nationkey END AS partido_id,
               'U' || CAST(s_suppkey % 27 AS STRING) AS uf
        FROM {supplier}""",
    "dim_temas": """
        SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS INT) AS tema_id, substr(o_orderpriority, 3) AS nome,
               substr(o_orderpriority, 1, 1) IN ('1', '2', '4') AS critico
        FROM {orders}""",
    "fato_proposicoes": """
        SELECT o_orderkey AS proposicao_id,
               CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS data_apresentacao,
               CASE o_orderstatus WHEN 'F' THEN 'PL' WHEN 'O' THEN 'PDL' ELSE 'REQ' END AS tipo,
               o_orderpriority || ' ' || o_orderstatus AS ementa,
               CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_custkey END AS autor_id,
               NULLIF(CAST(substr(o_orderpriority, 1, 1) AS INT), 4) AS tema_id,
               CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderpriority END AS embedding,
               CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'resumo ' || o_orderpriority END AS resumo_executivo,
               o_orderkey % 4 <> 1 AS autores_carregados,
               CAST(o_orderkey % 6 AS INT) AS qtd_autores,
               CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE 'C' || CAST(o_custkey AS STRING) END AS autor_principal_nome,
               CAST(o_orderdate AS DATE) AS ingested_at
        FROM {orders}""",
    "ponte_proposicao_autores": """
        SELECT l_orderkey AS proposicao_id,
               CASE WHEN l_linenumber <> 7 THEN l_suppkey + 7 END AS deputado_id,
               CASE WHEN l_linenumber = 7 THEN CAST(l_suppkey % 27 AS INT) END AS partido_id,
               'A' || CAST(l_suppkey AS STRING) AS nome_autor,
               CASE WHEN l_linenumber = 6 THEN NULL ELSE l_linenumber END AS ordem_assinatura,
               l_returnflag = 'A' AS proponente
        FROM {lineitem}""",
    "fato_votacoes": """
        SELECT CAST(o_orderkey AS STRING) AS votacao_id,
               CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderkey * 2 END AS proposicao_id,
               o_orderdate AS data,
               CASE WHEN o_orderkey % 15 = 0 THEN NULL ELSE o_orderpriority END AS orgao,
               CASE o_orderstatus WHEN 'F' THEN TRUE WHEN 'O' THEN FALSE END AS aprovacao,
               o_orderstatus = 'F' AS votos_carregados,
               CAST(o_orderkey % 40 AS INT) AS qtd_votos
        FROM {orders}""",
    "fato_votacao_votos": """
        SELECT CAST(CAST(floor(event_id / 40) AS BIGINT) * 99 AS STRING) AS votacao_id, user_id AS deputado_id,
               CASE event_type WHEN 'purchase' THEN 'Sim' WHEN 'view' THEN 'Não' WHEN 'click' THEN 'nao'
                               WHEN 'error' THEN 'Abstenção' END AS tipo_voto,
               CASE WHEN user_id % 4 = 0 THEN NULL ELSE 'NATION_' || CAST(user_id % 25 AS STRING) END AS sigla_partido_voto
        FROM {events}""",
    "fato_despesas": """
        SELECT CAST(l_orderkey AS STRING) AS cod_documento, l_linenumber AS parcela, l_suppkey + 7 AS deputado_id,
               CAST(extract(year FROM l_shipdate) AS INT) AS ano, CAST(extract(month FROM l_shipdate) AS INT) AS mes,
               l_returnflag || l_linestatus AS tipo_despesa,
               CAST(l_shipdate AS DATE) AS data_documento,
               CAST(l_extendedprice AS DECIMAL(12,2)) AS valor_documento,
               CASE WHEN l_linenumber = 5 THEN NULL
                    ELSE CAST(l_extendedprice AS DECIMAL(12,2)) - CAST(l_quantity AS DECIMAL(12,2)) END AS valor_liquido,
               CASE WHEN l_partkey % 50 = 0 THEN NULL
                    ELSE 'F' || CAST(CAST(floor(l_partkey / 10) AS BIGINT) AS STRING) END AS fornecedor_nome,
               CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE 'D' || CAST(l_partkey % 4 AS STRING) END AS fornecedor_cnpj
        FROM {lineitem}""",
}

# Raw records as the readers deliver them (texts, with origin), built from the
# same tables. The origin is a total order over the source rows.
_LINE_ORIGIN = """
        CAST(CAST(l_shipdate AS DATE) AS STRING) AS _snapshot,
        lpad(CAST(l_suppkey AS STRING), 12, '0') || lpad(CAST(l_partkey AS STRING), 12, '0')
          || lpad(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS STRING), 16, '0')
          || lpad(CAST(CAST(l_quantity AS DECIMAL(12,2)) AS STRING), 16, '0')
          || CAST(CAST(l_discount AS DECIMAL(12,2)) AS STRING) || CAST(CAST(l_tax AS DECIMAL(12,2)) AS STRING)
          || l_returnflag || l_linestatus AS _part,
        l_linenumber AS _pos"""

RAW: dict[str, str] = {
    "raw_partidos": """
        SELECT '' AS _snapshot, c_name AS _part, 0 AS _pos,
               CAST(c_nationkey AS STRING) || CASE WHEN c_custkey % 2 = 0 THEN '.0' ELSE '' END AS id,
               CASE WHEN c_custkey % 7 = 0 THEN ' nan ' ELSE '  ' || c_mktsegment || ' ' END AS sigla,
               c_name || '   ' || c_mktsegment AS nome
        FROM {customer}""",
    "raw_deputados": """
        SELECT '' AS _snapshot, c_name AS _part, 0 AS _pos,
               CAST(c_nationkey * 31 + c_custkey % 5 AS STRING) AS id, ' ' || c_name || '  x ' AS nome,
               c_mktsegment AS siglaPartido, CASE WHEN c_custkey % 9 = 0 THEN 'None' ELSE ' SP' END AS siglaUf,
               'NULL' AS email, 'f' || c_name AS urlFoto, '57' AS idLegislatura,
               'u/partidos/' || CAST(c_nationkey AS STRING) AS uriPartido, 'u/deputados/' || CAST(c_custkey AS STRING) AS uri
        FROM {customer}""",
    "raw_proposicoes": """
        SELECT CAST(CAST(l_shipdate AS DATE) AS STRING) AS _snapshot, _part, _pos,
               CAST(l_orderkey AS STRING) AS id, CASE WHEN l_linenumber = 2 THEN NULL ELSE ' ' || l_returnflag END AS siglaTipo,
               CASE WHEN l_linenumber = 3 THEN ' null ' ELSE 'Ementa   de ' || CAST(l_partkey AS STRING) END AS ementa,
               CASE WHEN l_linenumber = 4 THEN 'sem data' ELSE CAST(CAST(l_shipdate AS DATE) AS STRING) END AS dataApresentacao
        FROM (SELECT *,""" + _LINE_ORIGIN + """ FROM {lineitem}) li""",
    "raw_votacoes": """
        SELECT _snapshot, _part, _pos, CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS id,
               CASE WHEN l_quantity = 1 THEN 'x' ELSE CAST(CAST(l_shipdate AS DATE) AS STRING) || 'T10:00:00' END AS data,
               CASE WHEN l_linenumber = 1 THEN 'nan' ELSE ' ' || l_linestatus || ' ' END AS siglaOrgao,
               'Votacao  ' || l_returnflag AS descricao,
               CASE l_returnflag WHEN 'A' THEN '1' WHEN 'N' THEN '0' ELSE '2' END AS aprovacao
        FROM (SELECT *,""" + _LINE_ORIGIN + """ FROM {lineitem}) li""",
    "raw_despesas": """
        SELECT _snapshot, _part, _pos, l_suppkey AS deputado_id, CAST(l_orderkey AS STRING) AS codDocumento,
               CASE WHEN l_linenumber = 1 THEN NULL ELSE CAST(l_linenumber AS STRING) || '.0' END AS parcela,
               CAST(CAST(extract(year FROM l_shipdate) AS INT) AS STRING) AS ano,
               CAST(CAST(extract(month FROM l_shipdate) AS INT) AS STRING) AS mes,
               '  ' || l_returnflag || '  ' || l_linestatus AS tipoDespesa,
               CASE WHEN l_tax = 0 THEN '0' WHEN l_tax = 0.01 THEN '-1' WHEN l_tax = 0.02 THEN 'abc'
                    ELSE CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS STRING) END AS valorDocumento,
               CAST(CAST(l_quantity AS DECIMAL(12,2)) AS STRING) AS valorLiquido,
               CASE WHEN l_linenumber = 2 THEN NULL ELSE '1.5' END AS valorGlosa,
               CAST(CAST(l_shipdate AS DATE) AS STRING) || 'T00:00:00' AS dataDocumento,
               'NaN' AS codLote, 'F' || CAST(l_partkey AS STRING) || ' ' AS nomeFornecedor,
               '00.' || CAST(l_partkey AS STRING) || '/0001-04' AS cnpjCpfFornecedor
        FROM (SELECT *,""" + _LINE_ORIGIN + """ FROM {lineitem}) li""",
    "raw_autores": """
        SELECT _snapshot, _part, _pos, l_orderkey AS proposicao_id,
               CASE WHEN l_linenumber = 6 THEN NULL
                    WHEN l_linenumber = 7 THEN 'https://x/api/v2/partidos/' || CAST(l_suppkey % 27 AS STRING) || '/'
                    WHEN l_linenumber = 5 THEN 'https://x/api/v2/orgaos/Comissao'
                    ELSE 'https://x/api/v2/deputados/' || CAST(l_suppkey + 7 AS STRING) END AS uri,
               CASE WHEN l_linenumber = 6 THEN 'null' ELSE '  Autor  ' || CAST(l_suppkey AS STRING) END AS nome,
               '10000' AS codTipo,
               CASE WHEN l_linenumber = 6 THEN NULL ELSE 'Deputado(a)' END AS tipo,
               CASE WHEN l_linenumber = 3 THEN NULL ELSE CAST(l_linenumber % 3 AS STRING) END AS ordemAssinatura,
               CASE l_returnflag WHEN 'A' THEN '1' WHEN 'N' THEN 'nao' END AS proponente
        FROM (SELECT *,""" + _LINE_ORIGIN + """ FROM {lineitem}) li""",
    "raw_votos": """
        SELECT '' AS _snapshot, lpad(CAST(event_id AS STRING), 12, '0') AS _part, 0 AS _pos,
               CAST(CAST(floor(event_id / 40) AS BIGINT) AS STRING) AS votacao_id,
               CASE event_type WHEN 'purchase' THEN ' Sim ' WHEN 'view' THEN 'Não' WHEN 'click' THEN 'None' ELSE 'Artigo  17' END AS tipoVoto,
               CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST(user_id % 30 AS STRING) END AS voter_id,
               CASE WHEN user_id % 4 = 0 THEN 'nan' ELSE 'P' || CAST(user_id % 25 AS STRING) END AS voter_party,
               event_type = 'signup' AS plain_field
        FROM {events}""",
    "raw_links": """
        SELECT CAST(o_orderkey AS STRING) AS votacao_id,
               CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderkey * 2 AS STRING) WHEN o_orderstatus = 'O' THEN '0' END AS own_id,
               CASE WHEN o_orderkey % 4 = 0 THEN 'https://x/proposicoes/' || CAST(o_custkey AS STRING) || '/' WHEN o_orderkey % 4 = 1 THEN '' END AS uri_direct,
               CASE WHEN o_orderkey % 5 = 0 THEN CAST(o_custkey + 1 AS STRING) WHEN o_orderkey % 5 = 1 THEN '0' END AS first_id,
               CASE WHEN o_orderkey % 5 <= 2 THEN 'https://x/proposicoes/' || CAST(o_custkey + 2 AS STRING) END AS first_uri,
               CASE WHEN o_orderkey % 6 = 0 THEN '' ELSE ' Objeto  ' || o_orderpriority END AS objeto,
               'Descricao ' || o_orderstatus AS descricao
        FROM {orders}""",
}

ALL = {**STAR, **RAW}
_MARK = re.compile(r"\{(" + "|".join(SOURCES) + r")\}")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Use all cores for heavy row work on an input with fewer splits than
    cores (a single small file); a large input is left as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def sql(spark: SparkSession, sf_dir: str, text: str, heavy: bool = False) -> DataFrame:
    """Run a text whose ``{source}`` marks are driver tables."""
    used = {name: load(spark, sf_dir, name) for name in _MARK.findall(text)}
    return spark.sql(text, **{name: spread(df) if heavy else df for name, df in used.items()})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One stand-in; raw records are cleaned, which is heavy row work."""
    return sql(spark, sf_dir, ALL[name], heavy=name in RAW)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(load(spark, sf_dir, "documents"))


class Star(Mapping):
    """The star tables, each defined on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._make = lambda name: table(spark, sf_dir, name)
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in STAR:
            raise KeyError(name)
        if name not in self._made:
            self._made[name] = self._make(name)
        return self._made[name]

    def __iter__(self):
        return iter(STAR)

    def __len__(self) -> int:
        return len(STAR)


def tables(spark: SparkSession, sf_dir: str) -> Star:
    return Star(spark, sf_dir)


def plain(text: str) -> str:
    return _MARK.sub(r"\1", text)


def with_ctes(body: str) -> str:
    """DuckDB text: the stand-ins named in ``body`` become CTEs."""
    used = [name for name in ALL if re.search(rf"\b{name}\b", body)]
    ctes = [f"{name} AS ({plain(ALL[name])})" for name in used]
    body = plain(body).strip()
    if not ctes:
        return body
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join(ctes) + ",\n" + body[5:]
    return "WITH " + ",\n".join(ctes) + "\n" + body
