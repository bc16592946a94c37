"""Constraint checks, quarantine and coverage targets."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .. import schemas
from . import transforms

# First plausible year and the coverage goals in percent.
FIRST_YEAR = 1990
COVERAGE_GOALS = {"embedding": 80.0, "tema": 70.0, "resumo": 80.0}


def _row_rules(table: str, have: set[str]) -> dict[str, Column]:
    """NOT NULL and CHECK rules of the columns that a table has; true where broken."""
    rules = {f"nulo_{c}": F.col(c).isNull() for c in schemas.required_columns(table) if c in have}
    if table == "fato_despesas" and "valor_documento" in have:
        rules["valor_positivo"] = F.col("valor_documento") <= 0
    return rules


def _entry(table: str, rule: str, key: Column, parent: bool = False) -> Column:
    return F.struct(F.lit(table).alias("tabela"), F.lit(rule).alias("regra"), key.cast("string").alias("chave"), F.lit(parent).alias("pai"))


def check_constraints(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(tabela, regra, violacoes): NOT NULL, CHECK, primary and foreign keys of every given table.

    Each table is scanned once. A row yields an entry (table, rule, key) for each row
    rule that it breaks, for its primary key, for each foreign key that is not null, and
    as the parent of each rule that refers to its table. One grouping counts the entries
    per key, summed before they are shuffled, so that a hot key sends one row a task;
    a foreign key is broken as often as it occurs if no parent entry has it. Keys that
    are null count as equal in a primary key and break no foreign one. Rules that no row
    breaks are returned with 0.
    """
    foreign = [f for f in schemas.FOREIGN_KEYS if f[0] in tables and f[2] in tables and f[1] in tables[f[0]].columns]
    rules: list[tuple[str, str]] = []
    entries: list[DataFrame] = []
    for table, df in tables.items():
        if table not in schemas.TABLES:
            continue
        found = []
        for rule, broken in _row_rules(table, set(df.columns)).items():
            rules.append((table, rule))
            found.append(F.when(broken, _entry(table, rule, F.lit(None))))
        keys = schemas.PRIMARY_KEYS.get(table, ())
        if keys and set(keys) <= set(df.columns):
            rules.append((table, "pk"))
            found.append(_entry(table, "pk", F.to_json(F.struct(*keys))))
        for child, column, parent, parent_key in foreign:
            if child == table:
                rules.append((table, f"fk_{column}"))
                found.append(F.when(F.col(column).isNotNull(), _entry(table, f"fk_{column}", F.col(column))))
            if parent == table:
                found.append(F.when(F.col(parent_key).isNotNull(), _entry(child, f"fk_{column}", F.col(parent_key), parent=True)))
        if found:
            entries.append(df.select(F.explode(F.array_compact(F.array(*found))).alias("e")).select("e.*"))
    counted = reduce(DataFrame.unionByName, entries).groupBy("tabela", "regra", "chave").agg(
        F.count_if(~F.col("pai")).alias("n"), F.max("pai").alias("tem_pai"))
    broken = (
        F.when(F.col("regra") == "pk", F.col("n") - 1)
        .when(F.col("regra").startswith("fk_"), F.when(F.col("tem_pai"), 0).otherwise(F.col("n")))
        .otherwise(F.col("n"))
    )
    every = counted.sparkSession.createDataFrame([(*r, 0) for r in rules], "tabela string, regra string, violacoes bigint")
    return (
        counted.select("tabela", "regra", broken.cast("bigint").alias("violacoes")).unionByName(every)
        .groupBy("tabela", "regra").agg(F.sum("violacoes").alias("violacoes"))
    )


def implausible_day(col: Column, as_of) -> Column:
    """Dated before 1990 or after the year that follows ``as_of``."""
    year = F.year(col)
    return (year < FIRST_YEAR) | (year > F.year(F.lit(as_of).cast("date")) + 1)


def with_reasons(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Adds ``motivos``: the names of the rules each row breaks, in order."""
    reasons = F.array(*[F.when(F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()])
    return df.withColumn("motivos", F.array_compact(reasons))


def split(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantined with ``motivos``); together they are all rows."""
    marked = with_reasons(df, rules)
    broken = F.size("motivos") > 0
    return marked.where(~broken).drop("motivos"), marked.where(broken)


def validity_counts(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """(situacao, linhas): valid, invalid, and one row per broken rule."""
    hit = {name: F.coalesce(rule, F.lit(False)) for name, rule in rules.items()}
    any_hit = reduce(lambda a, b: a | b, hit.values())
    counted = df.agg(
        F.count_if(~any_hit).alias("validas"),
        F.count_if(any_hit).alias("invalidas"),
        *[F.count_if(c).alias(f"motivo_{name}") for name, c in hit.items()],
    )
    names = counted.columns
    pairs = ", ".join(f"'{n}', `{n}`" for n in names)
    return counted.select(F.expr(f"stack({len(names)}, {pairs}) as (situacao, linhas)"))


def expense_rules(as_of) -> dict[str, Column]:
    return {
        "sem_documento": F.col("cod_documento").isNull(),
        "sem_deputado": F.col("deputado_id").isNull(),
        "sem_valor": F.col("valor_documento").isNull(),
        "valor_nao_positivo": F.col("valor_documento") <= 0,
        "data_implausivel": implausible_day(F.col("data_documento"), as_of),
    }


def quarantine_expenses(records: DataFrame, as_of) -> tuple[DataFrame, DataFrame]:
    """Typed expense records split into loadable and quarantined rows."""
    return split(transforms.despesas_fields(records), expense_rules(as_of))


def coverage(proposicoes: DataFrame, goals: Mapping[str, float] = COVERAGE_GOALS) -> DataFrame:
    """Share of propositions with embedding, theme and summary against goals."""
    columns = {"embedding": "embedding", "tema": "tema_id", "resumo": "resumo_executivo"}
    total = F.nullif(F.count(F.lit(1)), F.lit(0))
    row = proposicoes.agg(*[
        F.round(F.lit(100.0) * F.count(columns[name]) / total, 2).alias(name) for name in goals
    ])
    pairs = ", ".join(f"'{n}', `{n}`, {float(goal)}D" for n, goal in goals.items())
    return row.select(F.expr(f"stack({len(goals)}, {pairs}) as (metrica, percentual, meta)")).withColumn(
        "atingida", F.coalesce(F.col("percentual") >= F.col("meta"), F.lit(False))
    )


def filled_share(df: DataFrame, flag: Column) -> DataFrame:
    """(total, preenchidas, pct) of a flag; pct is NULL for an empty table."""
    total, filled = F.count(F.lit(1)), F.count_if(flag)
    return df.agg(
        total.alias("total"),
        filled.alias("preenchidas"),
        F.round(F.lit(100.0) * filled / F.nullif(total, F.lit(0)), 2).alias("pct"),
    )


def bridge_fill(ponte: DataFrame) -> DataFrame:
    return ponte.agg(
        F.count(F.lit(1)).alias("linhas"),
        F.count_distinct("proposicao_id").alias("props"),
        F.count_distinct("deputado_id").alias("deps"),
        F.count_distinct("partido_id").alias("parts"),
    )
