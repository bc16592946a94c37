"""One key holding a third of all rows, with and without broadcasts."""

import pytest
from pyspark.sql import functions as F

from checks import standins
from civicspark.operators import dedup, transforms
from civicspark.plans import research, views

SF = "/root/testdata/sf0.001"
# Tiny thresholds make AQE treat the hot partition as skewed at this scale.
SHUFFLE_ONLY = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.0",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
}


def _hot(df, column, value):
    return df.withColumn(column, F.when(F.xxhash64(*df.columns) % 3 == 0, F.lit(value)).otherwise(F.col(column)).cast(df.schema[column].dataType))


def _tables(spark):
    t = dict(standins.tables(spark, SF))
    t["ponte_proposicao_autores"] = _hot(_hot(t["ponte_proposicao_autores"], "proposicao_id", 7), "deputado_id", 9)
    t["fato_votacao_votos"] = _hot(_hot(t["fato_votacao_votos"], "votacao_id", "99"), "deputado_id", 1)
    t["fato_despesas"] = _hot(t["fato_despesas"], "deputado_id", 8)
    return t


def _rows(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("fn", [
    views.heatmap_tema_partido, views.proposicoes_por_deputado, views.proposicoes_por_partido, views.top_deputados_autoria,
    views.votos_partido_tema, views.votos_por_partido, views.despesas_por_partido, views.top_deputados_despesa,
    views.proposicoes_score, research.deputy_loyalty,
], ids=lambda fn: fn.__name__)
def test_hot_keys_give_the_same_rows(spark, fn):
    usual = _rows(fn(_tables(spark)))
    old = {k: spark.conf.get(k, None) for k in SHUFFLE_ONLY}
    for k, v in SHUFFLE_ONLY.items():
        spark.conf.set(k, v)
    try:
        assert _rows(fn(_tables(spark))) == usual
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_key_reaches_the_final_dedup_once_per_task(spark):
    """A key in a third of the rows arrives with one row per input partition."""
    rows = spark.range(0, 30000, 1, 6).selectExpr("CASE WHEN id % 3 = 0 THEN -1 ELSE id END AS k", "id")
    kept = dedup.keep_first(rows, ["k"], ["id"])
    assert kept.where("k = -1").first()["id"] == 0 and kept.count() == 20001


def test_hot_proposition_elects_one_author(spark):
    rows = spark.range(0, 9000, 1, 6).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 1 ELSE id END AS proposicao_id", "'s' AS _snapshot", "'' AS _part", "CAST(id AS INT) AS _pos",
        "'n' || id AS nome_autor", "'T' AS autor_tipo", "1 AS deputado_id", "1 AS partido_id", "CAST(NULL AS INT) AS ordem_assinatura", "false AS proponente")
    hot = transforms.main_authors(rows).where("proposicao_id = 1").first()
    assert hot["autor_principal_nome"] == "n0" and hot["qtd_autores"] == 3001
