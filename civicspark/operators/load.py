"""Loads: apply a batch to the stored tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ..functions import uri
from ..session import scratch_path
from ..sources import envelopes as env
from ..sources.datasets import DATASETS
from ..sources.seeds import themes
from ..sources.store import StarStore, atomic
from . import bridges, transforms, upsert as ups

# A staged batch up to this many bytes (measured by the job that writes it) is
# broadcast; a larger one is merged by a shuffle join.
SMALL_BATCH_BYTES = 64 * 1024 * 1024

# Parents before children.
CORE_ORDER = ("dim_partidos", "dim_deputados", "fato_proposicoes", "fato_votacoes")


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write the batch once to the shared folder and read it back: the load
    then depends on a stored table, not on recomputing the raw files."""
    return stage_observed(df, label)[0]


def stage_observed(df: DataFrame, label: str, **metrics: Column) -> tuple[DataFrame, dict]:
    """``stage``, with aggregates of the batch taken by the job that writes it."""
    path, seen = scratch_path(df.sparkSession, label), Observation()
    out = df.observe(seen, *[F.coalesce(m, F.lit(0)).cast("bigint").alias(name) for name, m in metrics.items()]) if metrics else df
    out.write.parquet(path)
    found = seen.get if metrics else {}
    return df.sparkSession.read.schema(df.schema).parquet(path), {name: found.get(name) or 0 for name in metrics}


def width(df: DataFrame) -> Column:
    """Bytes of a row in memory, about: lengths of texts, eight for each number, nested values as text."""
    parts = []
    for f in df.schema.fields:
        col, kind = F.col(f"`{f.name}`"), f.dataType.typeName()
        if kind in ("string", "binary"):
            parts.append(F.octet_length(col))
        elif kind in ("array", "map", "struct"):
            flat = kind == "array" and f.dataType.elementType.typeName() in ("float", "double", "integer", "long")
            parts.append(8 * F.greatest(F.size(col), F.lit(0)) if flat else F.octet_length(F.to_json(F.struct(col))))
        else:
            parts.append(F.lit(8))
    return reduce(lambda x, y: x + y, [F.coalesce(p, F.lit(0)).cast("bigint") for p in parts])


def apply_batch(store: StarStore, table: str, batch: DataFrame, now: Column, *, order=None) -> int:
    """Upsert one batch into a table; returns the rows of the batch."""
    staged, seen = stage_observed(batch, f"batch-{table}", rows=F.count(F.lit(1)), size=F.sum(width(batch)))
    if seen["rows"] == 0:
        return 0
    stored = store.read(table, store.touched(table, staged))
    merged = ups.upsert(stored, staged, ups.POLICIES[table], now, order=order, batch_is_small=seen["size"] <= SMALL_BATCH_BYTES)
    store.write(table, merged)
    return seen["rows"]


def append_errors(store: StarStore, errors: DataFrame) -> None:
    """The error log only grows: every load adds its own version."""
    store.write("pipeline_erros", errors)


# Datasets whose newest listing is read, and those of which every listing is.
NEWEST, ALL_LISTINGS = ("partidos", "deputados"), ("proposicoes", "votacoes")


def read_core(
    spark: SparkSession, raw_dir: str, *, multi_line: bool | None = None, seen: Mapping[str, Observation] | None = None
) -> dict[str, DataFrame]:
    """Core batches out of the raw folder: newest listing for parties and
    deputies, all listings for propositions and votes, whose malformed documents ``seen`` counts."""
    opts, seen = {"multi_line": multi_line}, seen or {}
    record = lambda name: DATASETS[name].record
    return {
        "dim_partidos": transforms.partidos(env.latest_records(spark, raw_dir, "partidos", record("partidos"), **opts)),
        "dim_deputados": transforms.deputados(env.latest_records(spark, raw_dir, "deputados", record("deputados"), **opts)),
        "fato_proposicoes": transforms.proposicoes(
            env.all_records(spark, raw_dir, "proposicoes", record("proposicoes"), seen.get("proposicoes"), **opts)),
        "fato_votacoes": transforms.votacoes(
            env.all_records(spark, raw_dir, "votacoes", record("votacoes"), seen.get("votacoes"), **opts)),
    }


def read_expenses(spark: SparkSession, raw_dir: str, *, multi_line: bool | None = None) -> DataFrame:
    rows = env.sub_resource_records(
        spark, raw_dir, "deputados_despesas", DATASETS["deputados_despesas"].record,
        uri.owner_id(F.col("_endpoint")), "deputado_id", multi_line=multi_line,
    )
    return transforms.despesas(rows)


def unreadable_listings(
    spark: SparkSession, raw_dir: str, now: Column, *, names: Sequence[str] = NEWEST + ALL_LISTINGS, multi_line: bool | None = None
) -> DataFrame:
    """Error rows of the malformed documents among the core listings."""
    parts = []
    for name in names:
        ds = DATASETS[name]
        docs = env.read_envelopes(spark, raw_dir, ds.entity, f"ARRAY<STRUCT<{ds.record}>>", multi_line=multi_line)
        broken = env.unreadable(docs.where(env.is_listing(F.col("_snapshot"))))
        origin = F.concat_ws("/", F.lit(ds.entity), "_snapshot", "_part")
        parts.append(ups.error_rows(broken, "transform", "documento", origin, F.lit(bridges.UNREADABLE), now))
    return reduce(DataFrame.unionByName, parts)


def load_core(
    store: StarStore, raw_dir: str, now: Column, *, with_expenses: bool = False, multi_line: bool | None = None
) -> dict[str, int]:
    """Ordered load of the core tables; expenses only when asked for. All tables become visible together."""
    return atomic(store, lambda load: _load_core(load, raw_dir, now, with_expenses, multi_line))


def _load_core(store: StarStore, raw_dir: str, now: Column, with_expenses: bool, multi_line: bool | None) -> dict[str, int]:
    spark = store.spark
    # the job that loads all listings of a dataset counts their malformed documents; they are looked up only where there are some
    seen = {name: Observation() for name in ALL_LISTINGS}
    batches = read_core(spark, raw_dir, multi_line=multi_line, seen=seen)
    counts = {}
    for table in CORE_ORDER:
        batch = batches[table]
        if table == "dim_deputados":
            batch = ups.resolve_party(batch, store.read("dim_partidos"))
        counts[table] = apply_batch(store, table, batch, now)
    broken = [name for name in ALL_LISTINGS if seen[name].get["broken"]]
    errors = stage(unreadable_listings(spark, raw_dir, now, names=[*NEWEST, *broken], multi_line=multi_line), "unreadable")
    if not errors.isEmpty():
        append_errors(store, errors)
    if with_expenses:
        counts["fato_despesas"] = apply_batch(store, "fato_despesas", read_expenses(spark, raw_dir, multi_line=multi_line), now)
    return counts


def load_themes(store: StarStore, now: Column) -> int:
    return apply_batch(store, "dim_temas", themes(store.spark), now)


def _first_row(df: DataFrame) -> dict[str, int]:
    return df.first().asDict()


def load_authorship(
    store: StarStore, raw_dir: str, now: Column, *, limit: int | None = None,
    proposicao_id: int | None = None, multi_line: bool | None = None,
) -> dict[str, int]:
    """Authorship job over the landed author documents: bridge, flags and errors become visible together."""
    return atomic(store, lambda load: _load_authorship(load, raw_dir, now, limit, proposicao_id, multi_line))


def _load_authorship(
    store: StarStore, raw_dir: str, now: Column, limit: int | None, proposicao_id: int | None, multi_line: bool | None
) -> dict[str, int]:
    props = store.read("fato_proposicoes")
    targets = stage(bridges.pending_authorship(props, limit, proposicao_id), "targets")
    fetched, rows = bridges.fetched_items(store.spark, raw_dir, "proposicoes_autores", multi_line=multi_line)
    job = bridges.authorship(targets, fetched, rows, store.read("dim_deputados"), now, keep=stage)
    counters = _first_row(job["counters"])
    flags = stage(job["flags"], "flags")
    append_errors(store, job["errors"])
    apply_batch(store, "ponte_proposicao_autores", job["ponte"], now)
    stored = store.read("fato_proposicoes", store.touched("fato_proposicoes", flags))
    store.write("fato_proposicoes", ups.set_author_flags(stored, flags))
    return counters


def load_roll_calls(
    store: StarStore, raw_dir: str, now: Column, *, limit: int | None = None,
    votacao_id: str | None = None, multi_line: bool | None = None,
) -> dict[str, int]:
    """Roll-call job over the landed vote documents: votes, links, flags and errors become visible together."""
    return atomic(store, lambda load: _load_roll_calls(load, raw_dir, now, limit, votacao_id, multi_line))


def _load_roll_calls(
    store: StarStore, raw_dir: str, now: Column, limit: int | None, votacao_id: str | None, multi_line: bool | None
) -> dict[str, int]:
    votings = store.read("fato_votacoes")
    targets = stage(bridges.pending_votes(votings, limit, votacao_id), "targets")
    fetched, rows = bridges.fetched_items(store.spark, raw_dir, "votacoes_votos", multi_line=multi_line)
    details = bridges.newest_details(store.spark, raw_dir, multi_line=multi_line)
    job = bridges.roll_call(targets, fetched, rows, details, now, keep=stage)
    counters = _first_row(job["counters"])
    links, flags = job["links"], stage(job["flags"], "flags")
    append_errors(store, job["errors"])
    apply_batch(store, "fato_votacao_votos", job["votos"], now)
    touched = store.touched("fato_votacoes", links.select("votacao_id").union(flags.select("votacao_id")))
    linked = ups.set_vote_links(store.read("fato_votacoes", touched), links, store.read("fato_proposicoes"))
    store.write("fato_votacoes", ups.set_vote_flags(linked, flags))
    return counters
