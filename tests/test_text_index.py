"""Trigram search against a scan."""

from pyspark.sql import functions as F

from checks import standins
from civicspark.operators import text_index
from civicspark.operators.text_index import TextIndex
from civicspark.plans import views

TEXTS = [
    (1, "Altera a Lei de Educação Básica", None), (2, "ALTERA A LEI DE SAÚDE", "resumo da saúde"), (3, None, None), (4, "", "lei"),
    (5, "100% de desconto_total", "a\\b"), (6, "quebra\nde linha educação", "x"), (7, "aaaa", "AAAAB"), (None, "lei sem número", None),
    (8, "ΟΔΟΣ ΣΑΣ", "emoji 😀abc"), (9, "lei dos 😀ab", "educaçao"), (1, "outro texto da mesma lei", None)]
PATTERNS = [
    "%educação%", "%EDUCAÇÃO%", "%lei de%", "altera%saúde", "%le_ de%", "%aaa%", "%aaab%", "%zzz%", "%", "%ab%", "", "%a\\\\b%", "%100\\% de%", "%desconto\\_t%",
    "%a%b%c%", "%lei sem%", "%ΣΑΣ%", "%οδος%", "%😀abc%", "%quebra\nde%", "lei", "%lei%", "altera a lei de saúde", "%resumo%saúde%", "%número"]


def _rows(df):
    return sorted(map(repr, df.collect()))


def test_search_is_a_scan(spark, tmp_path, monkeypatch):
    table = spark.createDataFrame(TEXTS, "id int, ementa string, resumo string")
    index = TextIndex.build(table.limit(6), str(tmp_path / "index"), "id", ["ementa", "resumo"], buckets=8)
    for _ in range(2):  # a replay changes nothing
        index.extend(table)
    for inline, patterns in ((1000, PATTERNS), (0, PATTERNS[:6])):
        monkeypatch.setattr(text_index, "INLINE_KEYS", inline)
        for pattern in patterns:
            want = table.where(F.col("ementa").ilike(pattern) | F.col("resumo").ilike(pattern))
            assert _rows(index.search(table, pattern)) == _rows(want), pattern


def test_only_buckets_of_the_rarest_are_read(spark, tmp_path):
    table = spark.range(2000).select("id", F.concat(F.lit("projeto de lei "), F.format_string("n%04d", "id")).alias("ementa"))
    index = TextIndex.build(table, str(tmp_path / "index"), "id", ["ementa"], buckets=64)
    rarest = index._looked_up("%lei%n1234%")
    assert len(rarest) == 3 and max(rarest.values()) < 1000 and "lei" not in rarest
    plan = index.candidates(rarest)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan and "PushedFilters: [In(trigram" in plan
    assert [r.id for r in index.search(table, "%lei%n1234%").collect()] == [1234]
    # texts that have changed since are checked, not trusted
    changed = table.withColumn("ementa", F.when(F.col("id") == 1234, "outra").otherwise(F.col("ementa")))
    assert index.search(changed, "%lei%n1234%").count() == 0


def test_empty_table(spark, tmp_path):
    table = spark.createDataFrame([], "id int, ementa string")
    index = TextIndex.build(table, str(tmp_path / "index"), "id", ["ementa"], buckets=8)
    assert index.search(table, "%abc%").count() == 0


def test_explorer_over_the_rows_found(spark, tmp_path):
    tables = standins.tables(spark, "/root/testdata/sf0.001")
    facts = tables["fato_proposicoes"]
    index = TextIndex.build(facts, str(tmp_path / "index"), "proposicao_id", ["ementa", "resumo_executivo"], buckets=8)
    for text in ("urgent", "1-urg%nt", "no such text"):
        want = views.proposicoes_enriquecidas(tables, busca=text).collect()
        found = {**tables, "fato_proposicoes": index.search(facts, f"%{text}%")}
        assert views.proposicoes_enriquecidas(found, busca=text).collect() == want
        assert bool(want) == (text != "no such text")
