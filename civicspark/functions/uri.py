"""Rules over API paths and URIs."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Path words that name a resource, not an identifier.
RESOURCE_WORDS = (
    "deputados", "partidos", "proposicoes", "votacoes", "despesas", "orientacoes", "votos",
    "profissoes", "ocupacoes", "autores", "tramitacoes", "membros", "blocos", "eventos",
    "frentes", "legislaturas", "orgaos", "referencias", "discursos", "pauta",
)

# Fixed value: public page of one proposition.
PROPOSITION_PAGE = "https://www.camara.leg.br/proposicoesWeb/fichadetramitacao?idProposicao="


def numeric_tail(uri: Column) -> Column:
    """Last path segment as INT when it is all digits, else NULL."""
    return F.nullif(F.regexp_extract(uri, r"(?:^|/)([0-9]+)/*$", 1), F.lit("")).try_cast("int")


def resource_of(uri: Column) -> Column:
    """Lower-cased segment before a numeric last segment, else NULL."""
    return F.nullif(F.lower(F.regexp_extract(uri, r"([^/]+)/+[0-9]+/*$", 1)), F.lit(""))


def _segments(path: Column) -> Column:
    return F.filter(F.split(path, "/"), lambda part: part != "")


def path_entity(path: Column) -> Column:
    """Known resource words of a path joined by '_', or 'unknown'."""
    words = F.filter(F.transform(_segments(path), F.lower), lambda w: w.isin(*RESOURCE_WORDS))
    return F.when(F.size(words) > 0, F.array_join(words, "_")).otherwise(F.lit("unknown"))


def path_identifier(path: Column) -> Column:
    """Last segment that is not a known resource word, else NULL."""
    rest = F.filter(_segments(path), lambda part: ~F.lower(part).isin(*RESOURCE_WORDS))
    return F.get(F.reverse(rest), F.lit(0))


def owner_id(endpoint: Column) -> Column:
    """Numeric second segment: '/deputados/12/despesas' -> 12."""
    return F.nullif(F.regexp_extract(endpoint, r"^/*[^/]+/+([0-9]+)(?:/|$)", 1), F.lit("")).try_cast("int")


def owner_key(endpoint: Column) -> Column:
    """Second segment as text: '/votacoes/2265603-49/votos' -> '2265603-49'."""
    return F.nullif(F.regexp_extract(endpoint, r"^/*[^/]+/+([^/]+)", 1), F.lit(""))


def proposition_link(proposicao_id: Column) -> Column:
    return F.concat(F.lit(PROPOSITION_PAGE), proposicao_id.cast("string"))
