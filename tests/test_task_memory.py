"""What one task holds stays small: aggregates of one value at a time, bitmaps as large as their ids."""

import re

from pyspark.sql import functions as F

from checks import etl_queries
from civicspark.functions import bitmaps
from civicspark.plans import rollup, views


def star(spark):
    """Repeated and null keys, parties of one acronym, authors without a proposition."""
    return {
        "dim_partidos": spark.sql("SELECT * FROM VALUES (1, 'A'), (2, 'B'), (3, 'A'), (3, 'A') t(partido_id, sigla)"),
        "dim_deputados": spark.sql("SELECT CAST(id AS INT) AS deputado_id, 'd' AS nome, 'U' AS uf, CAST(1 + id % 4 AS INT) AS partido_id FROM range(12)"),
        "fato_proposicoes": spark.sql("""SELECT CAST(id % 30 AS INT) AS proposicao_id, CAST(nullif(id % 3, 2) AS INT) AS tema_id,
            date_add(DATE '2026-01-01', CAST(id * 3 AS INT)) AS data_apresentacao FROM range(32)"""),
        "dim_temas": spark.sql("SELECT 0 AS tema_id, 'x' AS nome, true AS critico"),
        "ponte_proposicao_autores": spark.sql("""SELECT CAST(nullif(id % 40, 7) AS INT) AS proposicao_id, CAST(nullif(id % 13, 5) AS INT) AS deputado_id,
            CAST(CASE WHEN id % 5 = 0 THEN 1 + id % 3 END AS INT) AS partido_id, nullif(id % 2, id % 4) = 0 AS proponente FROM range(200)"""),
    }


def ordered(df):
    return sorted(map(repr, df.collect()))


def test_two_distinct_counts_are_those_of_one_aggregate(spark):
    t = star(spark)
    rows = views.authors_with_party(t, "proponente").join(t["fato_proposicoes"].select("proposicao_id", "tema_id"), "proposicao_id")
    counts = [F.count_distinct("proposicao_id").alias("qtd_proposicoes"), F.count_distinct("deputado_id").alias("qtd_deputados_autores")]
    plain = rows.groupBy("partido_id", "sigla_partido").agg(*counts, F.coalesce(F.sum(F.col("proponente").cast("long")), F.lit(0)).alias("qtd_proponente"))
    assert ordered(views.proposicoes_por_partido(t).select(*plain.columns)) == ordered(plain)
    cells = rows.groupBy("sigla_partido", "tema_id").agg(*counts)
    assert ordered(views.heatmap_tema_partido(t).select(*cells.columns)) == ordered(cells)


def test_no_aggregate_holds_both_counted_columns(spark):
    for view in (views.proposicoes_por_partido, views.heatmap_tema_partido):
        plan = view(star(spark))._jdf.queryExecution().executedPlan().toString()
        keys = re.findall(r"Aggregate\(keys=\[([^\]]*)\]", plan)
        assert keys and not any("proposicao_id" in k and "deputado_id" in k for k in keys)


def test_monthly_bitmaps_are_words(spark):
    t = star(spark)
    months = rollup.monthly_authorship(t)
    assert dict(months.dtypes)["bits"] == "bigint"
    direct = views.heatmap_tema_partido(t).select(*rollup.KEYS, *rollup.COUNTED)
    assert ordered(rollup.authorship_of(months, "2026-01-01", "2026-12-31").select(*direct.columns)) == ordered(direct)


def test_words_count_each_id_once(spark):
    ids = spark.sql("""SELECT id % 3 AS k, CASE WHEN id % 7 > 0 THEN (id - 50) * 63 END AS x FROM range(100)
        UNION ALL SELECT 9, explode(array(-9223372036854775808, -1, 0, 63, 64, 9223372036854775807))""")
    parts = bitmaps.words(ids, ["k"], "x")
    direct = ids.groupBy("k").agg(F.count_distinct("x").alias("n"))
    assert ordered(bitmaps.distinct_in_words(parts.union(parts), ["k"], "n")) == ordered(direct)


def test_tasks_follow_the_rows_of_the_bridge(spark, monkeypatch):
    t = star(spark)
    usual = ordered(views.heatmap_tema_partido(t))
    monkeypatch.setattr(views, "TASK_ROWS", 10)
    assert views.authors_by_proposition(t).rdd.getNumPartitions() == 20
    assert ordered(views.heatmap_tema_partido(t)) == usual


def test_origins_are_met_in_the_given_number_of_tasks(spark):
    read = spark.sql("SELECT * FROM VALUES ('a', 's', 'p', 0), ('b', 's', 'p', 1), ('a', 's', 'p', 2), ('c', 's', 'p', 1), ('c', 's', 'q', 1) t(id, _snapshot, _part, _pos)")
    found = etl_queries._origins(read, 7)
    assert ordered(found) == ordered(spark.sql("SELECT * FROM VALUES ('a', 2L, true), ('b', 1L, false), ('c', 2L, false) t(id, vezes, origem_unica)"))
    assert "REPARTITION_BY_NUM" in found._jdf.queryExecution().executedPlan().toString()
