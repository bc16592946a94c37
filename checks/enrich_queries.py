"""Vectors, classification, summaries and costs with their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from civicspark.functions import cost, text, vectors
from civicspark.operators import enrich, enrichment, load as load_jobs, vector_index
from civicspark.session import scratch_path
from civicspark.sources import costlog, seeds
from civicspark.sources.store import StarStore

from .registry import query
from .standins import documents, load, sql, table

_DIM = 256


def _themes(spark, sf):
    """One theme per label: the mean of its vectors."""
    means = enrich.mean_vectors(load(spark, sf, "embeddings"), "label", "embedding")
    return means.select((F.col("label") + 1).alias("tema_id"), "vetor")


_CENTROIDS = """c AS (SELECT label + 1 AS tema_id, list(m ORDER BY i) AS v FROM (
      SELECT label, i, avg(CAST(embedding[i] AS DOUBLE)) AS m FROM (SELECT label, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings) u GROUP BY 1, 2) x
      GROUP BY 1)"""
_SCORED = f"""WITH {_CENTROIDS},
    s AS (SELECT e.vec_id, c.tema_id, round(list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), c.v), 12) AS score FROM embeddings e CROSS JOIN c),
    b AS (SELECT vec_id, arg_max(tema_id, score) AS melhor, max(score) AS score FROM s GROUP BY 1)"""

query("s14_vector_parse", "SELECT vec_id, CAST(len(embedding) AS INT) AS n, TRUE AS igual FROM embeddings")(
    lambda spark, sf: load(spark, sf, "embeddings").select(
        "vec_id", "embedding", vectors.parse_vector(vectors.format_vector(F.col("embedding"))).alias("v")).select(
        "vec_id", F.size("v").alias("n"),
        F.forall(F.zip_with("v", "embedding", lambda a, b: F.abs(a - b) < 1e-7), lambda same: same).alias("igual")))

query("s15_vector_format", """
    SELECT vec_id, '[' || array_to_string(list_transform(embedding, lambda x: printf('%.8f', CAST(x AS DOUBLE))), ',') || ']' AS v FROM embeddings""")(
    lambda spark, sf: load(spark, sf, "embeddings").select("vec_id", vectors.format_vector(F.col("embedding")).alias("v")))

query("f16_cosine", """
    SELECT a.vec_id, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), list_reverse(CAST(a.embedding AS DOUBLE[]))), 9) AS proprio,
      round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(list_transform(a.embedding, lambda x: -x) AS DOUBLE[])), 9) AS oposto, 0.0::DOUBLE AS zero
    FROM embeddings a""")(
    lambda spark, sf: load(spark, sf, "embeddings").select(
        "vec_id", F.round(vectors.cosine(F.col("embedding"), F.reverse("embedding")), 9).alias("proprio"),
        F.round(vectors.cosine(F.col("embedding"), F.transform("embedding", lambda x: -x)), 9).alias("oposto"),
        vectors.cosine(F.col("embedding"), F.transform("embedding", lambda x: F.lit(0.0))).alias("zero")))

query("b6_pending_embedding", """
    SELECT proposicao_id FROM fato_proposicoes WHERE embedding IS NULL AND ementa <> ''""")(
    lambda spark, sf: enrich.pending_embedding(table(spark, sf, "fato_proposicoes")).select("proposicao_id"))
query("b7_pending_classification", "SELECT proposicao_id FROM fato_proposicoes WHERE embedding IS NOT NULL AND tema_id IS NULL")(
    lambda spark, sf: enrich.pending_classification(table(spark, sf, "fato_proposicoes")).select("proposicao_id"))
query("b8_pending_summary", """
    SELECT proposicao_id, data_apresentacao FROM fato_proposicoes WHERE resumo_executivo IS NULL AND ementa <> ''""")(
    lambda spark, sf: enrich.pending_summary(table(spark, sf, "fato_proposicoes")).select("proposicao_id", "data_apresentacao"))

query("b9_classify", f"{_SCORED} SELECT vec_id, CASE WHEN score >= 0.30 THEN melhor END AS tema_id, melhor AS melhor_tema, round(score, 6) AS score FROM b")(
    lambda spark, sf: enrich.classify(load(spark, sf, "embeddings"), _themes(spark, sf)).select(
        "vec_id", "tema_id", "melhor_tema", F.round("score", 6).alias("score")))
query("b9_classification_counts", f"""{_SCORED} SELECT count(*) FILTER (WHERE score >= 0.30) AS classificadas, count(*) FILTER (WHERE score < 0.30) AS sem_tema FROM b""")(
    lambda spark, sf: enrich.classification_counts(enrich.classify(load(spark, sf, "embeddings"), _themes(spark, sf))))

query("b10_hashed_embedding", r"""
    SELECT doc_id, len(list_filter(string_split_regex(lower(text), '[^\p{L}\p{M}\p{Nd}_]+'), lambda w: w <> '')) AS tokens FROM documents""")(
    lambda spark, sf: enrich.hashed_embedding(documents(spark, sf), "text", dimensions=_DIM).where(
        F.abs(vectors.norm(F.col("embedding")) - 1) < 1e-5).select("doc_id", "tokens"))


def _length_encoder(texts):
    """A stand-in for a hosted model: two numbers per text."""
    return [[float(len(t)), 1.0] for t in texts], sum(len(t) for t in texts)


query("b10_embed_job", """
    SELECT proposicao_id, CAST(length(tipo || ': ' || ementa) AS DOUBLE) AS primeiro, TRUE AS ok FROM
      (SELECT CAST(o_orderkey AS INT) AS proposicao_id, o_orderstatus AS tipo, o_orderpriority AS ementa FROM orders) p""")(
    lambda spark, sf: enrich.embed(
        sql(spark, sf, "SELECT CAST(o_orderkey AS INT) AS proposicao_id, o_orderstatus AS tipo, o_orderpriority AS ementa FROM {orders}"),
        _length_encoder).select("proposicao_id", F.col("embedding")[0].cast("double").alias("primeiro"), F.col("erro").isNull().alias("ok")))

def _enriched(spark, sf):
    """A store of propositions enriched twice: the second run finds nothing to do. Returns store and cost log."""
    st, log = StarStore(spark, scratch_path(spark, "star")), scratch_path(spark, "costs")
    load_jobs.load_themes(st, F.current_timestamp())
    st.write("fato_proposicoes", sql(
        spark, sf, "SELECT o_orderkey AS proposicao_id, o_orderstatus AS tipo, o_orderpriority AS ementa FROM {orders}"))
    for _ in range(2):
        enrichment.run(st, F.current_timestamp(), "2026-06-14", log, encoder=_length_encoder,
                       generator=lambda prompt: (str(len(prompt)), 1, 2))
    return st, log


_THEME_LENGTHS = ", ".join(f"({i}, {len(nome) + 2 + len(descricao or nome)})" for i, nome, descricao, _ in seeds.THEMES)
_PROMPT_LENGTH = len(text.PROMPT_SYSTEM) + 2 + len(text.PROMPT_USER) - len("{tipo}") - len("{ementa}")
query("b_enrichment_run", f"""
    WITH p AS (SELECT CAST(o_orderkey AS INT) AS proposicao_id, length(o_orderstatus || ': ' || o_orderpriority)::DOUBLE AS a,
        CAST({_PROMPT_LENGTH} + length(o_orderstatus) + length(o_orderpriority) AS VARCHAR) AS resumo_executivo FROM orders),
    s AS (SELECT proposicao_id, tema_id, round((a * b + 1) / sqrt((a * a + 1) * (b * b + 1)), 12) AS c
      FROM p, (VALUES {_THEME_LENGTHS}) t(tema_id, b)),
    best AS (SELECT proposicao_id, CAST(arg_max(tema_id, c - tema_id * 1e-15) AS INT) AS tema_id FROM s GROUP BY 1)
    SELECT proposicao_id, tema_id, a AS primeiro, resumo_executivo FROM p JOIN best USING (proposicao_id)""")(
    lambda spark, sf: _enriched(spark, sf)[0].read("fato_proposicoes").select(
        "proposicao_id", "tema_id", F.col("embedding")[0].cast("double").alias("primeiro"), "resumo_executivo"))
query("b_enrichment_costs", """
    SELECT 'embed_pending' AS operacao, CAST(sum(length(o_orderstatus || ': ' || o_orderpriority)) AS BIGINT) AS tokens FROM orders
    UNION ALL SELECT 'summarize_pending', 3 * count(*) FROM orders""")(
    lambda spark, sf: costlog.read(spark, _enriched(spark, sf)[1]).select("operacao", "tokens"))

query("b11_summaries", r"""
    WITH d AS (SELECT doc_id, text, list_filter(list_transform(
          regexp_split_to_array(regexp_replace(text, '([.!?])[\s\x0B]+', '\1' || chr(10), 'g'), '\n+'),
          lambda x: trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))), lambda x: x <> '') AS s FROM documents),
    w AS (SELECT doc_id, m AS palavra, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) AS m FROM d) GROUP BY 1, 2),
    f AS (SELECT doc_id, i, s[i] AS frase FROM (SELECT doc_id, s, unnest(range(1, len(s) + 1)) AS i FROM d)),
    p AS (SELECT doc_id, i, unnest(regexp_extract_all(lower(frase), '[\p{L}\p{N}_]+')) AS palavra FROM f),
    t AS (SELECT doc_id, i, sum(n)::DOUBLE / count(*) AS peso FROM p JOIN w USING (doc_id, palavra) GROUP BY 1, 2),
    r AS (SELECT f.*, row_number() OVER (PARTITION BY f.doc_id ORDER BY coalesce(peso, 0) DESC, f.i) AS posicao FROM f LEFT JOIN t USING (doc_id, i)),
    o AS (SELECT doc_id, string_agg(frase, chr(10) ORDER BY i) AS resumo FROM r WHERE posicao <= 3 GROUP BY 1)
    SELECT doc_id, coalesce(resumo, '') AS resumo_executivo, len(regexp_extract_all(text, '[\p{L}\p{N}_]+')) AS tokens_in,
      len(regexp_extract_all(coalesce(resumo, ''), '[\p{L}\p{N}_]+')) AS tokens_out, CAST(NULL AS VARCHAR) AS erro FROM d LEFT JOIN o USING (doc_id)""")(
    lambda spark, sf: enrich.summarize(documents(spark, sf).select("doc_id", F.col("text").alias("ementa")), key="doc_id"))


def _cost_log(spark, sf):
    """One log line per source and language, written as CSV and read back."""
    runs = load(spark, sf, "documents").groupBy("source", "lang").agg(F.sum("n_chars").alias("chars"))
    tokens = F.expr("chars div 4")
    folder = scratch_path(spark, "costs")
    costlog.append(runs.select(
        F.date_add(F.lit("2026-05-01").cast("date"), F.length("source") * 10).alias("data"),
        F.when(F.col("lang") == "en", "embed_pending").otherwise("summarize_pending").alias("operacao"),
        tokens.alias("tokens"), cost.embed_cost(tokens).alias("custo_usd"), F.lit("modelo").alias("modelo")), folder)
    return costlog.read(spark, folder)


_LOG = """l AS (SELECT CAST(DATE '2026-05-01' + CAST(length(source) * 10 AS INT) AS DATE) AS data, CASE WHEN lang = 'en' THEN 'embed_pending' ELSE 'summarize_pending' END AS operacao,
      CAST(sum(n_chars) // 4 AS BIGINT) AS tokens FROM documents GROUP BY source, lang)"""
query("s16_cost_log", f"WITH {_LOG} SELECT data, operacao, count(*) AS n, CAST(sum(tokens) AS BIGINT) AS tokens FROM l GROUP BY 1, 2")(
    lambda spark, sf: _cost_log(spark, sf).groupBy("data", "operacao").agg(F.count(F.lit(1)).alias("n"), F.sum("tokens").alias("tokens")))
query("b12_cost_per_month", f"""WITH {_LOG}, m AS (SELECT CAST(date_trunc('month', data) AS DATE) AS periodo, operacao, count(*) AS execucoes, CAST(sum(tokens) AS BIGINT) AS tokens,
      round(CAST(sum(round(CAST(tokens AS DECIMAL(18,0)) * 0.00000002, 6)) AS DOUBLE), 6) AS custo_usd FROM l GROUP BY 1, 2)
    SELECT periodo, operacao, execucoes, tokens, custo_usd, sum(custo_usd) OVER (PARTITION BY periodo) <= 10 AS dentro_do_teto FROM m""")(
    lambda spark, sf: costlog.roll_up(_cost_log(spark, sf)).withColumn("custo_usd", F.round(F.col("custo_usd").cast("double"), 6)))

query("a15_run_totals", """
    SELECT DATE '2026-06-14' AS data, 'summarize_pending' AS operacao, CAST(sum(n_chars) + sum(doc_id) AS BIGINT) AS tokens,
      CAST(round(CAST(sum(n_chars) AS DECIMAL(18,0)) * 0.00000015 + CAST(sum(doc_id) AS DECIMAL(18,0)) * 0.00000060, 6) AS DOUBLE) AS custo_usd, 'm' AS modelo
    FROM documents
    UNION ALL SELECT DATE '2026-06-14', 'embed_pending', CAST(sum(n_chars) AS BIGINT),
      CAST(round(CAST(sum(n_chars) AS DECIMAL(18,0)) * 0.00000002, 6) AS DOUBLE), 'm' FROM documents""")(
    lambda spark, sf: costlog.summary_entry(
        load(spark, sf, "documents").selectExpr("n_chars AS tokens_in", "doc_id AS tokens_out"), "2026-06-14", "m").unionByName(
        costlog.embed_entry(load(spark, sf, "documents").selectExpr("n_chars AS tokens"), "2026-06-14", "m")))

query("b13_semantic_search_approx")(
    lambda spark, sf: enrich.search_approx(
        load(spark, sf, "embeddings"), _themes(spark, sf).where("tema_id = 4").first()["vetor"], "vec_id", k=25))

query("b13_semantic_search", f"""WITH {_CENTROIDS}
    SELECT e.vec_id, round(list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), c.v), 6) AS score FROM embeddings e, c WHERE c.tema_id = 4
    ORDER BY list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), c.v) DESC, e.vec_id LIMIT 25""")(
    lambda spark, sf: enrich.search(
        load(spark, sf, "embeddings"), _themes(spark, sf).where("tema_id = 4").first()["vetor"], "vec_id", k=25).select(
        "vec_id", F.round("score", 6).alias("score")))


def _index(spark, sf):
    """All vectors by cell, and every hundredth of them as a query."""
    vectors_ = load(spark, sf, "embeddings")
    index = vector_index.VectorIndex.build(vectors_, "vec_id", "embedding", scratch_path(spark, "index"), cell_rows=64)
    return index, vectors_.where("vec_id % 100 = 0")


_NEAREST = """n AS (SELECT q.vec_id AS consulta, e.vec_id, round(list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])), 12) AS s
      FROM embeddings q, embeddings e WHERE q.vec_id % 100 = 0),
    r AS (SELECT *, row_number() OVER (PARTITION BY consulta ORDER BY s DESC, vec_id) AS posicao FROM n)"""

query("b13_cells_topk", f"WITH {_NEAREST} SELECT consulta, vec_id, CAST(posicao AS INT) AS posicao, round(s, 6) AS score FROM r WHERE posicao <= 10")(
    lambda spark, sf: (lambda index, asked: index.search(asked, "vec_id", "embedding", k=10, probes=4, complete=True))(*_index(spark, sf)).select(
        F.col("query").alias("consulta"), F.col("key").alias("vec_id"), F.col("rank").alias("posicao"), F.round("score", 6).alias("score")))


@query("b13_cells_recall", f"""WITH {_NEAREST} SELECT count(*) AS pares, TRUE AS quase_todos, TRUE AS escores_exatos FROM r WHERE posicao <= 10""")
def _cells_recall(spark, sf):
    """Pairs of the exact ten nearest, whether 95 % of them are found in the nearest cells, and whether their scores are those of all pairs."""
    index, asked = _index(spark, sf)
    found = index.search(asked, "vec_id", "embedding", k=10)
    exact = index.search(asked, "vec_id", "embedding", k=10, complete=True)
    return vector_index.recall(found, exact).select(
        "pares", (F.col("achados") >= 0.95 * F.col("pares")).alias("quase_todos"), (F.col("desiguais") == 0).alias("escores_exatos"))
