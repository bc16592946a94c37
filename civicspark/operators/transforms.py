"""Raw records -> star rows. Input frames carry the origin columns of
``sources.envelopes``; files are ordered by name, so on duplicates the oldest
valid record wins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import coerce, uri
from ..functions.text import clean_safe, clean_text, json_text, normalize_cnpj_cpf, safe_str
from ..sources.envelopes import ORIGIN
from .dedup import keep_first

# Labels used when a field is missing, and the status of every
# listed deputy.
UNKNOWN_KIND = "Desconhecido"
UNKNOWN_NAME = "(sem nome)"
IN_OFFICE = "Em exercicio"
NO_ORDER = 999999


def _column(df: DataFrame, name: str) -> Column:
    """Field, or NULL where the records do not have it."""
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def _finish(df: DataFrame, keys: list[str], valid: Column) -> DataFrame:
    return keep_first(df, keys, valid=valid).drop(*ORIGIN)


def _present(*names: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in names])


def partidos(records: DataFrame) -> DataFrame:
    rows = records.select(
        *ORIGIN,
        coerce.to_int(F.col("id")).alias("partido_id"),
        safe_str(F.col("sigla")).alias("sigla"),
        clean_safe(F.col("nome")).alias("nome"),
    )
    return _finish(rows, ["partido_id"], _present("partido_id", "sigla"))


def deputados(records: DataFrame) -> DataFrame:
    rows = records.select(
        *ORIGIN,
        coerce.to_int(F.col("id")).alias("deputado_id"),
        clean_safe(F.col("nome")).alias("nome"),
        safe_str(F.col("siglaPartido")).alias("sigla_partido"),
        safe_str(F.col("siglaUf")).alias("uf"),
        safe_str(_column(records, "email")).alias("email"),
        safe_str(_column(records, "urlFoto")).alias("url_foto"),
        coerce.to_int(_column(records, "idLegislatura")).alias("id_legislatura"),
        safe_str(_column(records, "uriPartido")).alias("uri_partido"),
        safe_str(_column(records, "uri")).alias("uri"),
        F.lit(IN_OFFICE).alias("situacao"),
    )
    return _finish(rows, ["deputado_id"], _present("deputado_id", "nome", "uf"))


def proposicoes(records: DataFrame) -> DataFrame:
    """Rows without a text are dropped before the duplicates are."""
    rows = records.select(
        *ORIGIN,
        coerce.to_int(_column(records, "id")).alias("proposicao_id"),
        F.coalesce(safe_str(_column(records, "siglaTipo")), F.lit("")).alias("tipo"),
        F.coalesce(clean_safe(_column(records, "ementa")), F.lit("")).alias("ementa"),
        coerce.to_day(_column(records, "dataApresentacao")).alias("data_apresentacao"),
        F.lit(None).cast("int").alias("autor_id"),
        F.lit(None).cast("int").alias("tema_id"),
    )
    return _finish(rows, ["proposicao_id"], _present("proposicao_id") & (F.col("ementa") != ""))


def votacoes(records: DataFrame) -> DataFrame:
    rows = records.select(
        *ORIGIN,
        _column(records, "id").cast("string").alias("votacao_id"),
        coerce.to_instant(_column(records, "data")).alias("data"),
        safe_str(_column(records, "siglaOrgao")).alias("orgao"),
        clean_safe(_column(records, "descricao")).alias("descricao"),
        coerce.to_approval(_column(records, "aprovacao")).alias("aprovacao"),
        F.lit(None).cast("int").alias("proposicao_id"),
    )
    return _finish(rows, ["votacao_id"], _present("votacao_id", "data"))


def despesas_fields(records: DataFrame) -> DataFrame:
    """Typed expense rows before any is dropped."""
    get = lambda name: _column(records, name)
    return records.select(
        *ORIGIN,
        safe_str(get("codDocumento")).alias("cod_documento"),
        F.coalesce(coerce.to_int(get("parcela")), F.lit(0)).alias("parcela"),
        "deputado_id",
        coerce.to_int(get("ano")).alias("ano"),
        coerce.to_int(get("mes")).alias("mes"),
        clean_safe(get("tipoDespesa")).alias("tipo_despesa"),
        get("tipoDocumento").alias("tipo_documento"),
        get("numDocumento").alias("num_documento"),
        coerce.to_day(get("dataDocumento")).alias("data_documento"),
        coerce.to_money(get("valorDocumento")).alias("valor_documento"),
        coerce.to_money(get("valorLiquido")).alias("valor_liquido"),
        F.coalesce(coerce.to_money(get("valorGlosa")), F.lit(0).cast("decimal(12,2)")).alias("valor_glosa"),
        get("numRessarcimento").alias("num_ressarcimento"),
        coerce.to_int(get("codLote")).alias("cod_lote"),
        clean_safe(get("nomeFornecedor")).alias("fornecedor_nome"),
        normalize_cnpj_cpf(get("cnpjCpfFornecedor")).alias("fornecedor_cnpj"),
        get("urlDocumento").alias("url_documento"),
    )


def despesas(records: DataFrame) -> DataFrame:
    """Needs a document, a deputy and a positive amount."""
    valid = _present("cod_documento", "deputado_id") & (F.col("valor_documento") > 0)
    return _finish(despesas_fields(records), ["cod_documento", "parcela"], valid)


def autores_all(records: DataFrame) -> DataFrame:
    """Author rows of the bridge with their origin, before duplicates go.
    Whether an author is a deputy or a party is read off the URI, whose parts are
    columns of their own first: several fields use them, and each would parse it again."""
    link, number, resource = F.col("_link"), F.col("_number"), F.col("_resource")
    payload = [c for c in ("uri", "nome", "codTipo", "tipo", "ordemAssinatura", "proponente") if c in records.columns]
    parsed = records.withColumn("_link", safe_str(F.col("uri"))).withColumns(
        {"_number": uri.numeric_tail(link), "_resource": uri.resource_of(link)})
    return parsed.select(
        *ORIGIN,
        "proposicao_id",
        number.alias("autor_id"),
        F.coalesce(safe_str(F.col("tipo")), F.lit(UNKNOWN_KIND)).alias("autor_tipo"),
        F.when(resource == "deputados", number).alias("deputado_id"),
        F.when(resource == "partidos", number).alias("partido_id"),
        F.coalesce(clean_safe(F.col("nome")), F.lit(UNKNOWN_NAME)).alias("nome_autor"),
        coerce.to_int(_column(records, "codTipo")).alias("cod_tipo_autor"),
        coerce.to_int(_column(records, "ordemAssinatura")).alias("ordem_assinatura"),
        coerce.to_flag(_column(records, "proponente")).alias("proponente"),
        link.alias("uri_autor"),
        json_text(*payload).alias("raw_payload"),
    )


AUTHOR_KEY = ("proposicao_id", "autor_tipo", "nome_autor", "uri_autor")


def autores(records: DataFrame, keep_origin: bool = False) -> DataFrame:
    keys = [*AUTHOR_KEY[:3], F.coalesce("uri_autor", F.lit(""))]
    rows = keep_first(autores_all(records), keys)
    return rows if keep_origin else rows.drop(*ORIGIN)


def author_priority(order: Column | None = None) -> Column:
    """Sort key of the main-author election: proponents by signature order
    (unsigned last), then the signed, then the rest; ties by input position."""
    signed, proposes = F.col("ordem_assinatura"), F.col("proponente")
    group = F.when(proposes, 0).when(signed.isNotNull(), 1).otherwise(2)
    position = order if order is not None else F.struct(*ORIGIN)
    return F.struct(group.alias("g"), F.coalesce(signed, F.lit(NO_ORDER)).alias("o"), position.alias("p"))


def main_authors(authors: DataFrame, order: Column | None = None) -> DataFrame:
    """Per proposition: number of authors and the elected main author. One
    aggregate with partial results per task; no list is built."""
    chosen = F.struct("nome_autor", "autor_tipo", "deputado_id", "partido_id")
    best = authors.groupBy("proposicao_id").agg(
        F.count(F.lit(1)).cast("int").alias("qtd_autores"),
        F.min_by(chosen, author_priority(order)).alias("m"),
    )
    return best.select(
        "proposicao_id",
        "qtd_autores",
        F.col("m.nome_autor").alias("autor_principal_nome"),
        F.col("m.autor_tipo").alias("autor_principal_tipo"),
        F.col("m.deputado_id").alias("autor_principal_deputado_id"),
        F.col("m.partido_id").alias("autor_principal_partido_id"),
    )


def votos(records: DataFrame) -> DataFrame:
    """Single votes with party and state as they were at vote time."""
    if "deputado_" in records.columns and "deputado" in records.columns:
        voter = F.when(F.col("deputado_").isNotNull(), F.col("deputado_")).otherwise(F.col("deputado"))
    else:
        voter = F.col("deputado_" if "deputado_" in records.columns else "deputado")
    payload = [c for c in ("tipoVoto", "dataRegistroVoto", "deputado_", "deputado") if c in records.columns]
    rows = records.select(
        *ORIGIN,
        F.col("votacao_id").cast("string").alias("votacao_id"),
        coerce.to_int(voter["id"]).alias("deputado_id"),
        clean_safe(F.col("tipoVoto")).alias("tipo_voto"),
        safe_str(voter["siglaPartido"]).alias("sigla_partido_voto"),
        safe_str(voter["siglaUf"]).alias("sigla_uf_voto"),
        coerce.to_instant(F.col("dataRegistroVoto")).alias("data_registro_voto"),
        json_text(*payload).alias("raw_payload"),
    )
    return _finish(rows, ["votacao_id", "deputado_id"], _present("deputado_id"))


def vote_links(detail: DataFrame) -> DataFrame:
    """Best-effort link of a vote to its proposition: own id, else first
    affected proposition, else the number at the end of the URI."""
    first = F.get("proposicoesAfetadas", F.lit(0))
    present = lambda c: F.nullif(F.nullif(c, F.lit("")), F.lit("0"))
    own = present(F.col("idProposicao"))
    direct = safe_str(F.coalesce(F.nullif("uriProposicaoObjeto", F.lit("")), F.col("uriProposicao")))
    link = F.coalesce(direct, F.when(own.isNull(), safe_str(first["uri"])))
    subject = F.coalesce(F.nullif("objetoVotacao", F.lit("")), F.col("descricao"))
    return detail.select(
        "votacao_id",
        F.coalesce(coerce.to_int(own), coerce.to_int(present(first["id"])), uri.numeric_tail(link)).alias("proposicao_id"),
        link.alias("uri_proposicao"),
        clean_safe(subject).alias("objeto_votacao"),
        coerce.to_int(F.col("codTipoVotacao")).alias("cod_tipo_votacao"),
    )
