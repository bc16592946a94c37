"""Monthly roll-ups of authorship and votes that give any period without the facts.

Counts of distinct propositions, deputies, votings and voters are kept as bitmaps per month,
party and theme; a period is the OR of its months. A month of a party and theme holds few of
all ids, so the bitmaps are words of 64 ids.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import bitmaps
from . import views
from .views import Tables

KEYS = ["sigla_partido", "tema_id"]
#: Columns of the roll-up and the ids that they count.
COUNTED = {"qtd_proposicoes": "proposicao_id", "qtd_deputados_autores": "deputado_id"}


def _month(date: str) -> Column:
    return F.trunc(date, "month").alias("mes")


def monthly_authorship(t: Tables) -> DataFrame:
    """(mes, sigla_partido, tema_id, medida, balde, bits); undated propositions have no month (null)."""
    facts = t["fato_proposicoes"].select("proposicao_id", "tema_id", _month("data_apresentacao"))
    rows = views.authors_by_proposition(t).join(facts, "proposicao_id")
    parts = [
        bitmaps.words(rows, ["mes", *KEYS], ident).withColumn("medida", F.lit(name)) for name, ident in COUNTED.items()]
    return reduce(DataFrame.unionByName, parts)


def authorship_of(months: DataFrame, first: str, last: str, keys: list[str] | None = None) -> DataFrame:
    """(keys, qtd_proposicoes, qtd_deputados_autores) of the months from ``first`` to ``last``."""
    keys = KEYS if keys is None else keys
    span = months.where(F.col("mes").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    counts = bitmaps.distinct_in_words(span, [*keys, "medida"], "n")
    return counts.groupBy(*keys).agg(*[
        F.coalesce(F.sum(F.when(F.col("medida") == name, F.col("n"))), F.lit(0)).alias(name) for name in COUNTED])
