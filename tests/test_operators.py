import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from civicspark.operators import dedup, enrich, quality, upsert as U
from civicspark.plans import views as V

from .conftest import rows

NOW = "2026-06-14"


def test_keep_first_does_not_depend_on_partitions(spark):
    rnd = random.Random(3)
    data = [(rnd.choice([1, 1, 1, 2, 3]), f"s{rnd.randrange(5)}", "", i) for i in range(400)]
    want = {}
    for key, snap, part, pos in sorted(data, key=lambda r: (r[1], r[2], r[3])):
        want.setdefault(key, (snap, pos))
    for parts in (1, 3, 16):
        df = spark.createDataFrame(data, "k INT, _snapshot STRING, _part STRING, _pos INT").repartition(parts)
        got = {r["k"]: (r["_snapshot"], r["_pos"]) for r in dedup.keep_first(df, ["k"]).collect()}
        assert got == want


def test_keep_first_prunes_before_the_shuffle(spark):
    plan = dedup.keep_first(spark.range(10).selectExpr("id % 3 AS k", "id"), ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in below


def _props(spark, data):
    return spark.createDataFrame(data, "proposicao_id INT, data_apresentacao STRING, tipo STRING, ementa STRING, autor_id INT, tema_id INT, resumo_executivo STRING, ingested_at STRING")


@pytest.mark.parametrize("small", [False, True])
def test_conflict_policies(spark, small):
    stored = _props(spark, [(1, "2020-01-01", "PL", "a", 9, 3, "r", "old"), (2, "2020-01-01", "PL", "b", None, None, None, "old"),
                            (3, "2020-01-01", "PL", "c", 1, 1, "k", "old")])
    batch = spark.createDataFrame([(1, None, "PDL", "a2", None, 7), (2, "2021-01-01", "PL", "b2", 4, 7), (4, None, "REQ", "d", 5, None)],
                                  "proposicao_id INT, data_apresentacao STRING, tipo STRING, ementa STRING, autor_id INT, tema_id INT")
    policy = U.POLICIES["fato_proposicoes"]
    out = U.upsert(stored, batch, policy, F.lit(NOW), batch_is_small=small)
    want = [(1, None, "PDL", "a2", 9, 3, "r", NOW), (2, "2021-01-01", "PL", "b2", 4, 7, None, NOW), (3, "2020-01-01", "PL", "c", 1, 1, "k", "old"),
            (4, None, "REQ", "d", 5, None, None, NOW)]
    assert sorted(map(tuple, out.collect())) == want
    twice = U.upsert(out, batch, policy, F.lit(NOW), batch_is_small=small)
    assert sorted(map(tuple, twice.collect())) == want


def test_supplier_survives_and_null_uri_is_one_row(spark):
    stored = spark.createDataFrame([("d", 0, "old supplier", 1.0)], "cod_documento STRING, parcela INT, fornecedor_nome STRING, valor_documento DOUBLE")
    batch = spark.createDataFrame([("d", 0, "new supplier", 2.0)], stored.schema)
    assert [tuple(r) for r in U.upsert(stored, batch, U.POLICIES["fato_despesas"], F.lit(NOW)).collect()] == [("d", 0, "old supplier", 2.0)]
    empty = spark.createDataFrame([], "proposicao_id INT, autor_tipo STRING, nome_autor STRING, uri_autor STRING, ordem_assinatura INT")
    row = spark.createDataFrame([(1, "T", "A", None, 1)], empty.schema)
    once = U.upsert(empty, row, U.POLICIES["ponte_proposicao_autores"], F.lit(NOW))
    twice = U.upsert(once, row.withColumn("ordem_assinatura", F.lit(2)), U.POLICIES["ponte_proposicao_autores"], F.lit(NOW))
    assert [tuple(r) for r in twice.collect()] == [(1, "T", "A", None, 2)]


def test_batch_fold_equals_row_by_row(spark):
    """A batch with repeated keys equals its rows applied one after another."""
    rnd = random.Random(5)
    maybe = lambda v: v if rnd.random() > 0.4 else None
    data = [(rnd.randrange(6), maybe(f"d{i}"), f"t{i}", f"e{i}", maybe(i), maybe(i + 100), i) for i in range(60)]
    stored = {k: (k, "x", "PL", "e", maybe(-1), maybe(-2), "r", "old") for k in range(3)}
    state = dict(stored)
    for k, d, t, e, a, th, _ in data:
        old = state.get(k)
        state[k] = (k, d, t, e, a if a is not None else (old[4] if old else None),
                    old[5] if old and old[5] is not None else th, old[6] if old else None, NOW)
    batch = spark.createDataFrame(data, "proposicao_id INT, data_apresentacao STRING, tipo STRING, ementa STRING, autor_id INT, tema_id INT, ord INT").repartition(5)
    out = U.upsert(_props(spark, list(stored.values())), batch, U.POLICIES["fato_proposicoes"], F.lit(NOW), order=["ord"])
    assert sorted(map(tuple, out.collect())) == sorted(state.values())


def test_small_batch_plan_does_not_shuffle_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).selectExpr("CAST(id AS INT) AS partido_id", "'s' AS sigla", "'n' AS nome").write.parquet(path)
    batch = spark.createDataFrame([(1, "x", "y")], "partido_id INT, sigla STRING, nome STRING")
    merged = U.upsert(spark.read.parquet(path), batch, U.POLICIES["dim_partidos"], F.lit(NOW), batch_is_small=True)
    updated = merged._jdf.queryExecution().optimizedPlan().toString()
    assert "FullOuter" not in updated and "LeftOuter" in updated


def test_resolve_party(spark):
    parties = spark.createDataFrame([(1, "A"), (2, "A"), (3, "B")], "partido_id INT, sigla STRING")
    deputies = spark.createDataFrame([(10, "A"), (11, "B"), (12, "?")], "deputado_id INT, sigla_partido STRING")
    assert [r["partido_id"] for r in rows(U.resolve_party(deputies, parties), "deputado_id")] == [2, 3, None]
    given = deputies.withColumn("partido_id", F.when(F.col("deputado_id") == 10, 7))
    assert [r["partido_id"] for r in rows(U.resolve_party(given, parties), "deputado_id")] == [7, None, None]
    empty = deputies.withColumn("partido_id", F.lit(None).cast("int"))
    assert [r["partido_id"] for r in rows(U.resolve_party(empty, parties), "deputado_id")] == [2, 3, None]


def test_score(spark):
    t = {
        "fato_proposicoes": spark.sql("SELECT 1 AS proposicao_id, 'PEC' AS tipo, DATE '2026-02-01' AS data_apresentacao, 'e' AS ementa, 'r' AS resumo_executivo, 1 AS tema_id"
                                      " UNION ALL SELECT 2, 'XX', NULL, 'e', 'r', NULL"),
        "dim_temas": spark.sql("SELECT 1 AS tema_id, 'Saude' AS nome, true AS critico"),
        "fato_votacoes": spark.sql("SELECT 'v' AS votacao_id, 1 AS proposicao_id UNION ALL SELECT 'w', 1 UNION ALL SELECT 'x', NULL"),
    }
    assert [float(r["score_relevancia"]) for r in rows(V.proposicoes_score(t), "proposicao_id")] == [12.0, 2.5]
    assert [float(r["score_relevancia"]) for r in rows(V.score_without_votes(t), "proposicao_id")] == [10.0, 2.5]
    assert V.proposicoes_enriquecidas(t, tema="Todos", tipo=" ", busca="").count() == 2
    assert V.proposicoes_enriquecidas(t, busca="100%").count() == 0


def test_digest_without_recent_rows(spark):
    t = {"fato_proposicoes": spark.sql("SELECT 1 AS proposicao_id, 'PL' AS tipo, DATE '2020-01-01' AS data_apresentacao, 'e' AS ementa, 'r' AS resumo_executivo, 1 AS tema_id, 2 AS qtd_autores"),
         "dim_temas": spark.sql("SELECT 1 AS tema_id, 'Saude' AS nome, true AS critico")}
    assert V.digest(t, as_of="2026-06-14").count() == 0


def test_votes_per_party(spark):
    data = [("Sim",), ("SIM ",), ("Não",), ("NAO",), ("Obstrução",), (None,)]
    votes = spark.createDataFrame(data, "tipo_voto STRING").selectExpr("tipo_voto", "'P' AS sigla_partido_voto", "1 AS deputado_id")
    got = rows(V.votos_por_partido({"fato_votacao_votos": votes}))[0]
    assert (got["sim"], got["nao"], got["qtd_votos"], got["qtd_deputados"]) == (2, 2, 6, 1)


def _brute(vectors, themes):
    unit = lambda m: np.divide(m, np.linalg.norm(m, axis=1, keepdims=True), out=np.zeros_like(m), where=np.linalg.norm(m, axis=1, keepdims=True) != 0)
    scores = np.round(unit(vectors) @ unit(themes).T, 12)
    return scores.argmax(axis=1) + 1, scores.max(axis=1)


@pytest.mark.parametrize("budget", [64 * 1024 * 1024, 8 * 6 * 4])
def test_classification_in_one_or_many_rounds(spark, monkeypatch, budget):
    monkeypatch.setattr(enrich, "MATRIX_BYTES", budget)
    rng = np.random.default_rng(1)
    vecs, themes = rng.normal(size=(50, 6)), rng.normal(size=(11, 6))
    vecs[3] = 0
    themes[7] = themes[2] * 2  # same direction: the lower id wins
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vecs)], "proposicao_id INT, embedding ARRAY<DOUBLE>").repartition(4)
    th = spark.createDataFrame([(i + 1, v.tolist()) for i, v in enumerate(themes)], "tema_id INT, vetor ARRAY<DOUBLE>")
    got = rows(enrich.classify(df, th, 0.3).select("proposicao_id", "tema_id", "melhor_tema", "score"), "proposicao_id")
    got.sort(key=lambda r: r["proposicao_id"])
    ids, best = _brute(vecs, themes)
    assert [r["melhor_tema"] for r in got] == ids.tolist()
    assert [r["score"] for r in got] == pytest.approx(best.tolist())
    assert [r["tema_id"] for r in got] == [int(i) if s >= 0.3 else None for i, s in zip(ids, best)]


def test_threshold_is_inclusive(spark):
    df = spark.createDataFrame([(1, [0.3, float(np.sqrt(1 - 0.09))])], "proposicao_id INT, embedding ARRAY<DOUBLE>")
    th = spark.createDataFrame([(1, [1.0, 0.0])], "tema_id INT, vetor ARRAY<DOUBLE>")
    assert enrich.classify(df, th).first()["tema_id"] == 1
    none = enrich.classify(df, th.limit(0)).first()
    assert (none["tema_id"], none["score"]) == (None, 0.0)


def test_search_exact_and_approximate(spark):
    rng = np.random.default_rng(2)
    vecs = rng.normal(size=(300, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vecs)], "proposicao_id INT, embedding ARRAY<FLOAT>")
    query = vecs[17].tolist()
    exact = [r["proposicao_id"] for r in enrich.search(df, query, "proposicao_id", k=10).collect()]
    brute = np.argsort(-(vecs @ vecs[17]) / np.linalg.norm(vecs, axis=1))[:10].tolist()
    assert exact == brute
    near = [r["proposicao_id"] for r in enrich.search_approx(df, query, "proposicao_id", k=10, bucket_length=2.0).collect()]
    assert 17 in near and len(set(near) & set(brute)) >= 5


def test_embedding_job_survives_a_bad_batch(spark):
    props = spark.createDataFrame([(i, "PL", f"e{i}") for i in range(10)], "proposicao_id INT, tipo STRING, ementa STRING").coalesce(1)

    def encoder(texts):
        if any("e4" in t for t in texts):
            raise ValueError("quota")
        return [[float(len(t))] for t in texts], 7

    out = rows(enrich.embed(props, encoder, batch_size=2), "proposicao_id")
    assert [r["proposicao_id"] for r in out if r["erro"]] == [4, 5] and out[4]["embedding"] is None
    assert out[0]["embedding"] == [6.0] and sum(r["tokens"] for r in out) == 28


def test_hashed_embedding(spark):
    df = spark.createDataFrame([(1, "Lei da Saúde, lei"), (2, ""), (3, "lei da SAÚDE lei")], "i INT, t STRING")
    out = rows(enrich.hashed_embedding(df, "t", dimensions=64), "i")
    assert [r["tokens"] for r in out] == [4, 0, 4] and out[0]["embedding"] == out[2]["embedding"]
    assert np.linalg.norm(out[0]["embedding"]) == pytest.approx(1, abs=1e-6) and not any(out[1]["embedding"])


def test_summary_reads_the_whole_text():
    tail = "saude publica saude."
    text = "Um texto longo comeca aqui. " + "Nada importa muito agora. " * 1 + "Outra frase solta sem repeticao. " + tail
    out = enrich.summary(text, lines=2).splitlines()
    assert tail in out and len(out) == 2
    assert enrich.summary("") == ""


def test_quality_report_and_quarantine(spark):
    t = {"dim_partidos": spark.sql("SELECT 1 AS partido_id, 'A' AS sigla, CAST(NULL AS STRING) AS nome UNION ALL SELECT 1, 'B', 'b'"),
         "dim_deputados": spark.sql("SELECT 1 AS deputado_id, 'n' AS nome, 9 AS partido_id, 'SP' AS uf")}
    got = {(r["tabela"], r["regra"]): r["violacoes"] for r in rows(quality.check_constraints(t))}
    assert got[("dim_partidos", "nulo_nome")] == 1 and got[("dim_partidos", "pk")] == 1 and got[("dim_deputados", "fk_partido_id")] == 1
    rules = {"a": F.col("x") < 0, "b": F.col("x").isNull()}
    df = spark.sql("SELECT 1 AS x UNION ALL SELECT -1 UNION ALL SELECT NULL")
    good, bad = quality.split(df, rules)
    assert good.count() == 1 and sorted(r["motivos"] for r in rows(bad)) == [["a"], ["b"]]
    assert {r["situacao"]: r["linhas"] for r in rows(quality.validity_counts(df, rules))} == {"validas": 1, "invalidas": 2, "motivo_a": 1, "motivo_b": 1}


def test_constraints_scan_each_table_once(spark, tmp_path):
    """A hot orphan key, null keys and repeats; a table that is child and parent is read once."""
    made = {
        "dim_temas": "SELECT CAST(if(id = 3, NULL, id) AS INT) AS tema_id, 'n' AS nome, true AS critico FROM range(5)",
        "fato_proposicoes": """SELECT CAST(if(id < 6, 1, id) AS INT) AS proposicao_id, 't' AS tipo, 'e' AS ementa, false AS autores_carregados,
            0 AS qtd_autores, CAST(CASE WHEN id % 2 = 0 THEN 77 WHEN id % 5 = 0 THEN NULL ELSE 2 END AS INT) AS tema_id FROM range(1000)""",
        "fato_votacoes": """SELECT CAST(id AS STRING) AS votacao_id, timestamp'2020-01-01' AS data, false AS votos_carregados, 0 AS qtd_votos,
            CAST(id AS BIGINT) AS proposicao_id FROM range(20)""",
    }
    for name, text in made.items():
        spark.sql(text).write.parquet(f"{tmp_path}/{name}")
    found = quality.check_constraints({name: spark.read.parquet(f"{tmp_path}/{name}") for name in made})
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == len(made) and "Join" not in plan
    broken = {(r["tabela"], r["regra"]): r["violacoes"] for r in rows(found) if r["violacoes"]}
    assert broken == {("dim_temas", "nulo_tema_id"): 1, ("fato_proposicoes", "pk"): 5, ("fato_proposicoes", "fk_tema_id"): 500,
                      ("fato_votacoes", "fk_proposicao_id"): 5}
    empty = quality.check_constraints({name: spark.read.parquet(f"{tmp_path}/{name}").where("false") for name in made})
    assert found.count() == empty.count() and not any(r["violacoes"] for r in rows(empty))


def test_null_and_ragged_vectors_have_no_theme(spark):
    from civicspark.operators import enrich

    themes = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "tema_id int, vetor array<double>")
    found = enrich.classify(spark.createDataFrame(
        [(1, [2.0, 0.1]), (2, None), (3, [1.0]), (4, [0.0, 0.0]), (5, [0.1, 3.0])], "id int, embedding array<float>"), themes)
    got = {r["id"]: (r["tema_id"], round(r["score"], 3)) for r in found.collect()}
    assert got == {1: (1, 0.999), 2: (None, 0.0), 3: (None, 0.0), 4: (None, 0.0), 5: (2, 0.999)}


def test_distinct_counts_do_not_expand_rows(spark):
    from checks import standins
    from civicspark.plans import views

    tables = standins.tables(spark, "/root/testdata/sf0.001")
    for view in (views.heatmap_tema_partido, views.proposicoes_por_partido, views.votos_partido_tema):
        assert "Expand" not in view(tables)._jdf.queryExecution().optimizedPlan().toString()
