"""Catalogue of the landed datasets: record schema plus the request filters
each listing supports, applied here as ordinary predicates."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import coerce, uri
from ..functions.text import normalize_cnpj_cpf
from . import envelopes as env


@dataclass(frozen=True)
class Dataset:
    entity: str
    record: str
    kind: str = "listing"  # listing | sub | detail
    owner: str | None = None
    owner_is_number: bool = True
    # parameter -> (rule, field); rules: eq, contains, from, to, asked (value
    # only recorded in the request parameters), party, supplier
    filters: dict[str, tuple[str, str]] = field(default_factory=dict)


_DEPUTY = "id STRING, uri STRING, nome STRING, siglaPartido STRING, uriPartido STRING, siglaUf STRING, idLegislatura STRING, urlFoto STRING, email STRING"
_VOTING = "id STRING, uri STRING, data STRING, dataHoraRegistro STRING, siglaOrgao STRING, uriOrgao STRING, proposicaoObjeto STRING, uriProposicaoObjeto STRING, descricao STRING, aprovacao STRING"
_CABINET = "STRUCT<nome: STRING, predio: STRING, sala: STRING, andar: STRING, telefone: STRING, email: STRING>"
_STATUS = (
    "STRUCT<id: STRING, uri: STRING, nome: STRING, nomeEleitoral: STRING, siglaPartido: STRING, uriPartido: STRING, "
    f"siglaUf: STRING, idLegislatura: STRING, urlFoto: STRING, email: STRING, data: STRING, gabinete: {_CABINET}>"
)
_VOTER = "STRUCT<id: STRING, uri: STRING, nome: STRING, siglaPartido: STRING, uriPartido: STRING, siglaUf: STRING, idLegislatura: STRING, urlFoto: STRING, email: STRING>"

# Field names of the public open-data records.
DATASETS: dict[str, Dataset] = {
    "deputados": Dataset(
        "deputados", _DEPUTY,
        filters={"uf": ("eq", "siglaUf"), "partido": ("eq", "siglaPartido"), "legislatura": ("eq", "idLegislatura"),
                 "nome": ("contains", "nome"), "sexo": ("asked", "siglaSexo")},
    ),
    "partidos": Dataset(
        "partidos", "id STRING, sigla STRING, nome STRING, uri STRING",
        filters={"sigla": ("eq", "sigla"), "data_inicio": ("asked", "dataInicio"), "data_fim": ("asked", "dataFim"),
                 "legislatura": ("asked", "idLegislatura")},
    ),
    "proposicoes": Dataset(
        "proposicoes",
        "id STRING, uri STRING, siglaTipo STRING, codTipo STRING, numero STRING, ano STRING, ementa STRING, dataApresentacao STRING",
        filters={"id": ("eq", "id"), "tipo": ("eq", "siglaTipo"), "ano": ("eq", "ano"), "numero": ("eq", "numero"),
                 "apresentacao_inicio": ("from", "dataApresentacao"), "apresentacao_fim": ("to", "dataApresentacao"),
                 "tramitacao_inicio": ("asked", "dataInicio"), "tramitacao_fim": ("asked", "dataFim"),
                 "autor": ("asked", "autor"), "id_autor": ("asked", "idAutor")},
    ),
    "votacoes": Dataset(
        "votacoes", _VOTING,
        filters={"inicio": ("from", "data"), "fim": ("to", "data"), "id_orgao": ("asked", "idOrgao"),
                 "id_proposicao": ("asked", "idProposicao")},
    ),
    "deputados_despesas": Dataset(
        "deputados_despesas",
        "codDocumento STRING, parcela STRING, ano STRING, mes STRING, tipoDespesa STRING, tipoDocumento STRING, "
        "codTipoDocumento STRING, numDocumento STRING, dataDocumento STRING, valorDocumento STRING, valorLiquido STRING, "
        "valorGlosa STRING, numRessarcimento STRING, codLote STRING, nomeFornecedor STRING, cnpjCpfFornecedor STRING, urlDocumento STRING",
        "sub", "deputado_id",
        filters={"ano": ("eq", "ano"), "mes": ("eq", "mes"), "legislatura": ("asked", "idLegislatura"),
                 "fornecedor": ("supplier", "cnpjCpfFornecedor")},
    ),
    "votacoes_orientacoes": Dataset(
        "votacoes_orientacoes",
        "orientacaoVoto STRING, codTipoLideranca STRING, siglaPartidoBloco STRING, codPartidoBloco STRING, uriPartidoBloco STRING",
        "sub", "votacao_id", owner_is_number=False,
    ),
    "votacoes_votos": Dataset(
        "votacoes_votos",
        f"tipoVoto STRING, dataRegistroVoto STRING, deputado_ {_VOTER}, deputado {_VOTER}",
        "sub", "votacao_id", owner_is_number=False,
    ),
    "deputados_profissoes": Dataset(
        "deputados_profissoes", "dataHora STRING, codTipoProfissao STRING, titulo STRING", "sub", "deputado_id"
    ),
    "deputados_ocupacoes": Dataset(
        "deputados_ocupacoes",
        "titulo STRING, entidade STRING, entidadeUF STRING, entidadePais STRING, anoInicio STRING, anoFim STRING",
        "sub", "deputado_id",
    ),
    "proposicoes_autores": Dataset(
        "proposicoes_autores",
        "uri STRING, nome STRING, codTipo STRING, tipo STRING, ordemAssinatura STRING, proponente STRING",
        "sub", "proposicao_id",
    ),
    "proposicoes_tramitacoes": Dataset(
        "proposicoes_tramitacoes",
        "dataHora STRING, sequencia STRING, siglaOrgao STRING, uriOrgao STRING, regime STRING, descricaoTramitacao STRING, "
        "codTipoTramitacao STRING, descricaoSituacao STRING, codSituacao STRING, despacho STRING, url STRING, ambito STRING",
        "sub", "proposicao_id",
        filters={"inicio": ("from", "dataHora"), "fim": ("to", "dataHora")},
    ),
    "proposicoes_votacoes": Dataset("proposicoes_votacoes", _VOTING, "sub", "proposicao_id"),
    "partidos_membros": Dataset(
        "partidos_membros", _DEPUTY, "sub", "partido_id",
        filters={"legislatura": ("eq", "idLegislatura"), "inicio": ("asked", "dataInicio"), "fim": ("asked", "dataFim")},
    ),
    "deputados_detalhe": Dataset(
        "deputados",
        f"id STRING, uri STRING, nomeCivil STRING, cpf STRING, sexo STRING, dataNascimento STRING, ultimoStatus {_STATUS}",
        "detail",
    ),
    "partidos_detalhe": Dataset(
        "partidos",
        "id STRING, sigla STRING, nome STRING, uri STRING, numeroEleitoral STRING, "
        "status STRUCT<data: STRING, idLegislatura: STRING, situacao: STRING, totalPosse: STRING, totalMembros: STRING>",
        "detail",
    ),
    "proposicoes_detalhe": Dataset(
        "proposicoes",
        "id STRING, uri STRING, siglaTipo STRING, numero STRING, ano STRING, ementa STRING, ementaDetalhada STRING, "
        "keywords STRING, dataApresentacao STRING, descricaoTipo STRING, urlInteiroTeor STRING, "
        "statusProposicao STRUCT<dataHora: STRING, siglaOrgao: STRING, regime: STRING, descricaoSituacao: STRING, despacho: STRING>",
        "detail",
    ),
    "votacoes_detalhe": Dataset(
        "votacoes",
        "id STRING, uri STRING, data STRING, siglaOrgao STRING, aprovacao STRING, idProposicao STRING, "
        "uriProposicaoObjeto STRING, uriProposicao STRING, proposicoesAfetadas ARRAY<STRUCT<id: STRING, uri: STRING>>, "
        "objetoVotacao STRING, descricao STRING, codTipoVotacao STRING",
        "detail",
    ),
}


def _predicate(rule: str, name: str, value) -> Column:
    text = str(value)
    if rule == "eq":
        return F.col(name) == F.lit(text)
    if rule == "contains":
        return F.lower(name).contains(text.lower())
    if rule == "from":
        return coerce.to_day(F.col(name)) >= F.lit(text).cast("date")
    if rule == "to":
        return coerce.to_day(F.col(name)) <= F.lit(text).cast("date")
    if rule == "supplier":
        return normalize_cnpj_cpf(F.col(name)) == normalize_cnpj_cpf(F.lit(text))
    if rule == "asked":
        return F.get_json_object("_params", f"$.{name}") == F.lit(text)
    raise ValueError(f"unknown filter rule {rule}")


def apply_filters(df: DataFrame, name: str, **filters) -> DataFrame:
    """Optional predicates: a parameter left at None filters nothing."""
    known = DATASETS[name].filters
    for parameter, value in filters.items():
        if parameter not in known:
            raise ValueError(f"{name} has no filter {parameter!r}; it has {sorted(known)}")
        if value is not None:
            df = df.where(_predicate(*known[parameter], value))
    return df


def read_dataset(
    spark: SparkSession,
    raw_dir: str,
    name: str,
    *,
    latest: bool = False,
    order_by: str | None = None,
    descending: bool = False,
    owner=None,
    multi_line: bool | None = None,
    **filters,
) -> DataFrame:
    """Typed records of one dataset of the catalogue."""
    ds = DATASETS[name]
    if ds.kind == "detail":
        out = env.details(spark, raw_dir, ds.entity, ds.record, multi_line=multi_line)
    elif ds.kind == "sub":
        key = uri.owner_id(F.col("_endpoint")) if ds.owner_is_number else uri.owner_key(F.col("_endpoint"))
        out = env.sub_resource_records(spark, raw_dir, ds.entity, ds.record, key, ds.owner, multi_line=multi_line)
        if owner is not None:
            out = out.where(F.col(ds.owner) == F.lit(owner))
    else:
        read = env.latest_records if latest else env.all_records
        out = read(spark, raw_dir, ds.entity, ds.record, multi_line=multi_line)
    out = apply_filters(out, name, **filters)
    if order_by:
        out = out.orderBy(F.col(order_by).desc_nulls_last() if descending else F.col(order_by).asc_nulls_last())
    return out


def deputy_ids(listing: DataFrame) -> DataFrame:
    """Driving set of per-deputy jobs: the non-null, non-zero ids of a listing."""
    ids = listing.select(coerce.to_int(F.col("id")).alias("deputado_id"))
    return ids.where(F.col("deputado_id").isNotNull() & (F.col("deputado_id") != 0))


def date_window(df: DataFrame, column: str, as_of, days: int = 1) -> DataFrame:
    """Rows dated in [as_of - days, as_of]."""
    end = F.lit(as_of).cast("date")
    return df.where(F.col(column).between(F.date_sub(end, days), end))
