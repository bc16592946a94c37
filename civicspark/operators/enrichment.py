"""Enrichment run over the store: embed, classify, summarise what is pending, log the cost.

Each step reads what the step before has stored, writes only key ranges it
touches, and leaves finished rows alone, so a second run changes nothing and an
interrupted one is simply run again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import theme_text
from ..sources import costlog
from ..sources.store import StarStore
from . import enrich, upsert as ups
from .load import append_errors, stage, stage_observed

EMBED_MODEL, CHAT_MODEL = "hashed-1536", "offline-summary"


def _save(store: StarStore, results: DataFrame, column: str) -> int:
    """Write one model column back by proposition id; returns the rows written."""
    found = results.where(F.col(column).isNotNull()).select("proposicao_id", column)
    done, seen = stage_observed(found, f"enriched-{column}", rows=F.count(F.lit(1)))
    if seen["rows"]:
        stored = store.read("fato_proposicoes", store.touched("fato_proposicoes", done))
        store.write("fato_proposicoes", ups.set_values(stored, done, [column]))
    return seen["rows"]


def _log_errors(store: StarStore, results: DataFrame, failures: int, step: str, now: Column) -> int:
    if failures:
        failed = results.where(F.col("erro").isNotNull())
        append_errors(store, ups.error_rows(failed, step, "proposicao", F.col("proposicao_id"), F.col("erro"), now))
    return failures


def theme_vectors(themes: DataFrame, encoder: enrich.Encoder | None) -> DataFrame:
    """(tema_id, vetor): themes are encoded on demand from '<name>: <description>'."""
    named = themes.select("tema_id", theme_text(F.col("nome"), F.col("descricao")).alias("texto"))
    if encoder is None:
        return enrich.hashed_embedding(named, "texto", "vetor").select("tema_id", "vetor")
    as_rows = named.select(F.col("tema_id").alias("proposicao_id"), F.col("texto"))
    return enrich.embed_texts(as_rows, encoder).select(
        F.col("proposicao_id").alias("tema_id"), F.col("embedding").alias("vetor")).where("vetor IS NOT NULL")


def run(
    store: StarStore, now: Column, day: str, cost_path: str, *, encoder: enrich.Encoder | None = None,
    generator: enrich.Generator = enrich.offline_generator, limit: int | None = None, threshold: float = enrich.THRESHOLD,
    embed_model: str = EMBED_MODEL, chat_model: str = CHAT_MODEL,
) -> dict[str, int]:
    """One enrichment run; returns how many rows each step has stored and failed.

    Without an encoder texts are embedded by hashing. A row whose model call failed
    stays pending and is logged; nothing else of its batch is lost.
    """
    counts = {}
    props = store.read("fato_proposicoes")
    pending = enrich.pending_embedding(props, limit)
    if encoder is None:
        texts = pending.select("proposicao_id", F.concat("tipo", F.lit(": "), "ementa").alias("texto"))
        vectors = enrich.hashed_embedding(texts, "texto").select("proposicao_id", "embedding", "tokens", F.lit(None).cast("string").alias("erro"))
    else:
        vectors = enrich.embed(pending, encoder)
    vectors, seen = stage_observed(vectors, "vectors", failures=F.count("erro"))
    counts["falhas_vetor"] = _log_errors(store, vectors, seen["failures"], "embedding", now)
    counts["vetores"] = _save(store, vectors, "embedding")
    if counts["vetores"]:
        costlog.append(costlog.embed_entry(vectors, day, embed_model), cost_path)

    themes = stage(theme_vectors(store.read("dim_temas"), encoder), "themes")
    waiting = enrich.pending_classification(store.read("fato_proposicoes"), limit).select("proposicao_id", "embedding")
    counts["temas"] = _save(store, enrich.classify(waiting, themes, threshold), "tema_id")

    todo = enrich.pending_summary(store.read("fato_proposicoes"), limit)
    summaries, seen = stage_observed(
        enrich.summarize(todo, generator, prompt=generator is not enrich.offline_generator), "summaries", failures=F.count("erro"))
    counts["falhas_resumo"] = _log_errors(store, summaries, seen["failures"], "resumo", now)
    counts["resumos"] = _save(store, summaries, "resumo_executivo")
    if counts["resumos"]:
        costlog.append(costlog.summary_entry(summaries, day, chat_model), cost_path)
    return counts
