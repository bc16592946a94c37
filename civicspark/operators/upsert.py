"""Idempotent upserts with one conflict policy per column.

``overwrite``    the new value, even when it is NULL
``keep_old``     the old value, the new one only where the old is NULL
``prefer_new``   the new value, the old one only where the new is NULL
``insert_only``  set when the row is inserted, untouched afterwards
``stamps``       set to ``now`` on insert and on update
``born``         set to ``now`` on insert only
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .. import schemas
from ..functions.text import message


@dataclass(frozen=True)
class Policy:
    table: str
    keys: tuple[str, ...]
    overwrite: tuple[str, ...] = ()
    keep_old: tuple[str, ...] = ()
    prefer_new: tuple[str, ...] = ()
    insert_only: tuple[str, ...] = ()
    stamps: tuple[str, ...] = ()
    born: tuple[str, ...] = ()
    # key columns that may be NULL and match as ''
    blank_keys: tuple[str, ...] = ()

    def key_column(self, name: str) -> Column:
        return F.coalesce(F.col(name), F.lit("")) if name in self.blank_keys else F.col(name)


POLICIES: dict[str, Policy] = {
    p.table: p
    for p in (
        Policy("dim_partidos", ("partido_id",), overwrite=("sigla", "nome"), stamps=("ingested_at",)),
        Policy("dim_temas", ("tema_id",), overwrite=("nome", "descricao", "critico")),
        Policy(
            "dim_deputados", ("deputado_id",),
            overwrite=("nome", "partido_id", "uf", "situacao", "email", "url_foto", "id_legislatura", "uri_partido", "uri"),
            stamps=("ingested_at",),
        ),
        Policy(
            "fato_proposicoes", ("proposicao_id",), overwrite=("data_apresentacao", "tipo", "ementa"),
            keep_old=("tema_id",), prefer_new=("autor_id",), stamps=("ingested_at",),
        ),
        Policy(
            "fato_votacoes", ("votacao_id",), overwrite=("data", "orgao", "descricao", "aprovacao"),
            keep_old=("proposicao_id",), stamps=("ingested_at",),
        ),
        Policy(
            "fato_despesas", ("cod_documento", "parcela"),
            overwrite=("tipo_despesa", "valor_documento", "valor_liquido", "valor_glosa"),
            insert_only=("deputado_id", "ano", "mes", "tipo_documento", "num_documento", "data_documento",
                         "num_ressarcimento", "cod_lote", "fornecedor_nome", "fornecedor_cnpj", "url_documento"),
            stamps=("ingested_at",),
        ),
        Policy(
            "ponte_proposicao_autores", ("proposicao_id", "autor_tipo", "nome_autor", "uri_autor"),
            overwrite=("autor_id", "deputado_id", "partido_id", "cod_tipo_autor", "ordem_assinatura", "proponente", "raw_payload"),
            stamps=("atualizado_em",), born=("criado_em",), blank_keys=("uri_autor",),
        ),
        Policy(
            "fato_votacao_votos", ("votacao_id", "deputado_id"),
            overwrite=("tipo_voto", "sigla_partido_voto", "sigla_uf_voto", "data_registro_voto", "raw_payload"),
            stamps=("atualizado_em",), born=("criado_em",),
        ),
    )
}


def fold_batch(source: DataFrame, policy: Policy, order: Sequence[str | Column]) -> DataFrame:
    """One row per key with the outcome of applying the batch row by row:
    last value for ``overwrite``, first and last non-NULL for ``keep_old`` and
    ``prefer_new``, first value for ``insert_only``. Partial aggregates per
    task; no group is ever collected."""
    rank = F.struct(*order)
    known = lambda c: F.when(F.col(c).isNotNull(), rank)
    have = set(source.columns)
    folds = [F.max_by(c, rank).alias(c) for c in policy.overwrite if c in have]
    folds += [F.min_by(c, known(c)).alias(c) for c in policy.keep_old if c in have]
    folds += [F.max_by(c, known(c)).alias(c) for c in policy.prefer_new if c in have]
    folds += [F.min_by(c, rank).alias(c) for c in policy.insert_only if c in have]
    keys = [policy.key_column(k).alias(k) for k in policy.keys]
    grouped = source.groupBy(*keys).agg(*folds) if folds else source.select(*keys).distinct()
    return grouped.select(
        *[(F.nullif(k, F.lit("")) if k in policy.blank_keys else F.col(k)).alias(k) for k in policy.keys],
        *[c for c in grouped.columns if c not in policy.keys],
    )


def _outcome(policy: Policy, columns: list[str], given: set[str], now: Column) -> list[Column]:
    """Output columns over the joined frame ``t`` (stored) / ``s`` (batch)."""
    matched = F.col("t._stored") & F.col("s._given")
    fresh = F.col("t._stored").isNull()
    defaults = schemas.DEFAULTS.get(policy.table, {})
    out = []
    for name in columns:
        old = F.col(f"t.{name}")
        new = F.col(f"s.{name}") if name in given else F.lit(None)
        initial = F.coalesce(new, F.lit(defaults[name])) if name in defaults else new
        if name in policy.keys:
            value = F.when(fresh, new).otherwise(old)
        elif name in policy.stamps:
            value = F.when(F.col("s._given"), now).otherwise(old)
        elif name in policy.born:
            value = F.when(fresh, now).otherwise(old)
        elif name in policy.overwrite and name in given:
            value = F.when(fresh, initial).when(matched, new).otherwise(old)
        elif name in policy.keep_old:
            value = F.when(fresh, initial).when(matched, F.coalesce(old, new)).otherwise(old)
        elif name in policy.prefer_new:
            value = F.when(fresh, initial).when(matched, F.coalesce(new, old)).otherwise(old)
        else:  # insert_only and columns the load never touches
            value = F.when(fresh, initial).otherwise(old)
        out.append(value.alias(name))
    return out


def upsert(
    target: DataFrame,
    source: DataFrame,
    policy: Policy,
    now: Column,
    *,
    order: Sequence[str | Column] | None = None,
    batch_is_small: bool = False,
) -> DataFrame:
    """New content of the table after applying the batch.

    ``order`` gives the row order inside the batch when keys may repeat; leave
    it out for a batch with unique keys. The general plan is one full outer
    join on the key. When the caller has measured the batch and it fits a
    broadcast (``batch_is_small``), stored rows are updated by a broadcast
    left join and the new keys appended, so the stored table is not shuffled.
    """
    batch = fold_batch(source, policy, order) if order is not None else source
    columns = target.columns
    given = {c for c in batch.columns if c in columns}
    types = dict(target.dtypes)
    batch = batch.select(*[F.col(c).cast(types[c]).alias(c) for c in columns if c in given])

    stored = target.withColumn("_stored", F.lit(True))
    incoming = batch.withColumn("_given", F.lit(True))
    for i, key in enumerate(policy.keys):
        stored = stored.withColumn(f"_k{i}", policy.key_column(key))
        incoming = incoming.withColumn(f"_k{i}", policy.key_column(key))
    names = [f"_k{i}" for i in range(len(policy.keys))]
    outcome = _outcome(policy, columns, given, now)

    def merge(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        on = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in names]
        return left.alias("t").join(right.alias("s"), on, how).select(*outcome)

    if not batch_is_small:
        return merge(stored, incoming, "full_outer")
    updated = merge(stored, F.broadcast(incoming), "left")
    seen = stored.select(*names).join(F.broadcast(incoming.select(*names)), names, "left_semi")
    new_rows = incoming.join(seen, names, "left_anti")
    inserted = merge(stored.limit(0), new_rows, "right")
    return updated.unionByName(inserted)


def update_by_key(target: DataFrame, source: DataFrame, keys: Sequence[str], assign: Mapping[str, Column]) -> DataFrame:
    """Update-only: rows of ``target`` whose key is in ``source`` (unique by
    key) take the assigned values; nothing is inserted. Assignments may refer
    to ``t.<column>`` and ``s.<column>``.

    The source may hold as many keys as the table. Its size is guessed from all columns
    of the files it is read from, far too low for a key and a value: broadcast on
    that guess, it would pass through the driver's memory. So it is always shuffled."""
    left = target.alias("t")
    right = source.withColumn("_given", F.lit(True)).alias("s").hint("merge")
    joined = left.join(right, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys], "left")
    hit = F.col("s._given").isNotNull()
    return joined.select(*[
        (F.when(hit, assign[c]).otherwise(F.col(f"t.{c}")) if c in assign else F.col(f"t.{c}")).alias(c)
        for c in target.columns
    ])


AUTHOR_FLAG_COLUMNS = (
    "qtd_autores", "autor_principal_nome", "autor_principal_tipo",
    "autor_principal_deputado_id", "autor_principal_partido_id",
)


def set_author_flags(proposicoes: DataFrame, flags: DataFrame) -> DataFrame:
    """Loaded flag, author count and main author (all NULL when none)."""
    assign = {c: F.col(f"s.{c}") for c in AUTHOR_FLAG_COLUMNS}
    assign["autores_carregados"] = F.lit(True)
    return update_by_key(proposicoes, flags, ["proposicao_id"], assign)


def set_vote_flags(votacoes: DataFrame, flags: DataFrame) -> DataFrame:
    return update_by_key(
        votacoes, flags, ["votacao_id"], {"votos_carregados": F.lit(True), "qtd_votos": F.col("s.qtd_votos")}
    )


def set_vote_links(votacoes: DataFrame, links: DataFrame, proposicoes: DataFrame) -> DataFrame:
    """Link votes to propositions; an id is stored only if it exists."""
    names = ("proposicao_id", "uri_proposicao", "objeto_votacao", "cod_tipo_votacao")
    known = proposicoes.select(F.col("proposicao_id").alias("_pid"))
    checked = links.join(known, F.col("proposicao_id") == F.col("_pid"), "left").withColumn(
        "proposicao_id", F.col("_pid")
    ).drop("_pid")
    return update_by_key(
        votacoes, checked, ["votacao_id"], {c: F.coalesce(F.col(f"s.{c}"), F.col(f"t.{c}")) for c in names}
    )


def set_values(proposicoes: DataFrame, source: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Write model results (theme, embedding, summary) by proposition id."""
    return update_by_key(proposicoes, source, ["proposicao_id"], {c: F.col(f"s.{c}") for c in columns})


def resolve_party(deputados: DataFrame, partidos: DataFrame) -> DataFrame:
    """Fill ``partido_id`` from ``sigla_partido`` when the load has no ids at
    all; a repeated acronym resolves to the highest id, an unknown one to NULL."""
    lookup = partidos.groupBy("sigla").agg(F.max("partido_id").alias("_pid"))
    joined = deputados.join(lookup, F.col("sigla_partido") == F.col("sigla"), "left").drop("sigla")
    if "partido_id" not in deputados.columns:
        return joined.withColumnRenamed("_pid", "partido_id")
    ids = deputados.agg(F.count("partido_id") > 0).scalar()
    return joined.withColumn("partido_id", F.when(ids, F.col("partido_id")).otherwise(F.col("_pid"))).drop("_pid")


def error_rows(df: DataFrame, etapa: str, tipo: str, entity_id: Column, text: Column, now: Column) -> DataFrame:
    """Rows for the error log."""
    return df.select(
        F.lit(etapa).alias("etapa"),
        F.lit(tipo).alias("entidade_tipo"),
        entity_id.cast("string").alias("entidade_id"),
        message(text).alias("mensagem"),
        F.lit(None).cast("string").alias("payload"),
        now.alias("criado_em"),
    )
