"""Star-schema tables as Spark DDL. Money is DECIMAL(12,2), ids are INT."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

TABLES: dict[str, str] = {
    "dim_partidos": """
        partido_id INT NOT NULL, sigla STRING NOT NULL, nome STRING NOT NULL, ingested_at TIMESTAMP""",
    "dim_deputados": """
        deputado_id INT NOT NULL, nome STRING NOT NULL, partido_id INT, uf STRING NOT NULL,
        situacao STRING NOT NULL, email STRING, url_foto STRING, id_legislatura INT,
        uri_partido STRING, uri STRING, ingested_at TIMESTAMP""",
    "dim_temas": """
        tema_id INT NOT NULL, nome STRING NOT NULL, descricao STRING, critico BOOLEAN NOT NULL""",
    "fato_proposicoes": """
        proposicao_id INT NOT NULL, data_apresentacao DATE, tipo STRING NOT NULL, ementa STRING NOT NULL,
        autor_id INT, tema_id INT, embedding ARRAY<FLOAT>, resumo_executivo STRING,
        autores_carregados BOOLEAN NOT NULL, qtd_autores INT NOT NULL,
        autor_principal_nome STRING, autor_principal_tipo STRING,
        autor_principal_deputado_id INT, autor_principal_partido_id INT, ingested_at TIMESTAMP""",
    "fato_votacoes": """
        votacao_id STRING NOT NULL, proposicao_id INT, data TIMESTAMP NOT NULL, orgao STRING,
        descricao STRING, aprovacao BOOLEAN, uri_proposicao STRING, objeto_votacao STRING,
        cod_tipo_votacao INT, votos_carregados BOOLEAN NOT NULL, qtd_votos INT NOT NULL,
        ingested_at TIMESTAMP""",
    "ponte_proposicao_autores": """
        proposicao_id INT NOT NULL, autor_id INT, autor_tipo STRING NOT NULL, deputado_id INT,
        partido_id INT, nome_autor STRING NOT NULL, cod_tipo_autor INT, ordem_assinatura INT,
        proponente BOOLEAN NOT NULL, uri_autor STRING, raw_payload STRING,
        criado_em TIMESTAMP, atualizado_em TIMESTAMP""",
    "fato_votacao_votos": """
        votacao_id STRING NOT NULL, deputado_id INT NOT NULL, tipo_voto STRING,
        sigla_partido_voto STRING, sigla_uf_voto STRING, data_registro_voto TIMESTAMP,
        raw_payload STRING, criado_em TIMESTAMP, atualizado_em TIMESTAMP""",
    "pipeline_erros": """
        etapa STRING NOT NULL, entidade_tipo STRING, entidade_id STRING, mensagem STRING,
        payload STRING, criado_em TIMESTAMP""",
    "fato_despesas": """
        cod_documento STRING NOT NULL, parcela INT NOT NULL, deputado_id INT NOT NULL, ano INT NOT NULL,
        mes INT NOT NULL, tipo_despesa STRING NOT NULL, tipo_documento STRING, num_documento STRING,
        data_documento DATE, valor_documento DECIMAL(12,2) NOT NULL, valor_liquido DECIMAL(12,2),
        valor_glosa DECIMAL(12,2) NOT NULL, num_ressarcimento STRING, cod_lote INT,
        fornecedor_nome STRING, fornecedor_cnpj STRING, url_documento STRING, ingested_at TIMESTAMP""",
}

PRIMARY_KEYS: dict[str, tuple[str, ...]] = {
    "dim_partidos": ("partido_id",),
    "dim_deputados": ("deputado_id",),
    "dim_temas": ("tema_id",),
    "fato_proposicoes": ("proposicao_id",),
    "fato_votacoes": ("votacao_id",),
    "fato_votacao_votos": ("votacao_id", "deputado_id"),
    "fato_despesas": ("cod_documento", "parcela"),
}

# (child table, child column, parent table, parent column). The bridge and the
# deputy of a single vote deliberately have no such rule.
FOREIGN_KEYS: tuple[tuple[str, str, str, str], ...] = (
    ("dim_deputados", "partido_id", "dim_partidos", "partido_id"),
    ("fato_proposicoes", "tema_id", "dim_temas", "tema_id"),
    ("fato_proposicoes", "autor_id", "dim_deputados", "deputado_id"),
    ("fato_votacoes", "proposicao_id", "fato_proposicoes", "proposicao_id"),
    ("fato_despesas", "deputado_id", "dim_deputados", "deputado_id"),
    ("fato_votacao_votos", "votacao_id", "fato_votacoes", "votacao_id"),
)

# Values a row gets when the load does not carry the column at all.
DEFAULTS: dict[str, dict[str, object]] = {
    "dim_temas": {"critico": False},
    "dim_deputados": {"situacao": "Em exercicio"},
    "fato_proposicoes": {"autores_carregados": False, "qtd_autores": 0},
    "fato_votacoes": {"votos_carregados": False, "qtd_votos": 0},
    "ponte_proposicao_autores": {"proponente": False},
    "fato_despesas": {"parcela": 0, "valor_glosa": 0},
}


def struct_type(table: str) -> StructType:
    return StructType.fromDDL(TABLES[table])


def required_columns(table: str) -> list[str]:
    return [f.name for f in struct_type(table).fields if not f.nullable]


def empty_table(spark: SparkSession, table: str) -> DataFrame:
    """A table without rows, which the optimizer knows to be empty: what is joined to it is not shuffled."""
    return spark.createDataFrame([], struct_type(table)).limit(0)


def conform(df: DataFrame, table: str) -> DataFrame:
    """Table columns in order and type: absent ones become their default or
    NULL, NaN becomes NULL, unknown ones are left out. A value beyond its
    column's range fails the write: turned into NULL it would be lost."""
    defaults = DEFAULTS.get(table, {})
    kinds = dict(df.dtypes)
    out = []
    for field in struct_type(table).fields:
        if field.name in kinds:
            value = F.col(field.name)
            if kinds[field.name] in ("double", "float"):
                value = F.when(~F.isnan(value), value)
        else:
            value = F.lit(defaults.get(field.name))
        out.append(value.cast(field.dataType).alias(field.name))
    return df.select(*out)
