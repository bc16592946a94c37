"""Presentation formats (Brazilian Portuguese)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .coerce import to_number

# Month abbreviations and placeholders.
MONTHS = ("jan", "fev", "mar", "abr", "mai", "jun", "jul", "ago", "set", "out", "nov", "dez")
DASH = "—"
NBSP = " "


def _pt(number: Column, decimals: int) -> Column:
    # format_number rounds half-even, so round half-up first
    shown = F.format_number(F.round(number.cast("decimal(38,6)"), decimals), decimals)
    return F.translate(shown, ",.", ".,")


def fmt_int(col: Column) -> Column:
    """1234567 -> '1.234.567'."""
    return _pt(to_number(col), 0)


def fmt_brl(col: Column) -> Column:
    """Whole reais: 'R$ 1.235' with a no-break space; the sign goes first."""
    number = to_number(col)
    sign = F.when(F.round(number, 0) < 0, F.lit("-")).otherwise(F.lit(""))
    return F.concat(sign, F.lit("R$" + NBSP), _pt(F.abs(number), 0))


def fmt_millions(col: Column) -> Column:
    """'R$ 35,9 mi'; a trailing ',0' is dropped."""
    shown = F.regexp_replace(_pt(to_number(col) / 1e6, 1), ",0$", "")
    return F.concat(F.lit("R$ "), shown, F.lit(" mi"))


def pct(part: Column, whole: Column) -> Column:
    """Share with one decimal; '0%' when the whole is 0."""
    a, b = to_number(part), to_number(whole)
    return F.when(b == 0, F.lit("0%")).otherwise(F.format_string("%.1f%%", a / F.nullif(b, F.lit(0.0)) * 100))


def fmt_day(col: Column) -> Column:
    return F.coalesce(F.date_format(col, "dd/MM/yyyy"), F.lit(DASH))


def fmt_day_short(col: Column) -> Column:
    return F.coalesce(F.date_format(col, "dd/MM"), F.lit(""))


def fmt_last_load(col: Column) -> Column:
    """'13/06/2026 · 01:53 UTC' (the session zone is UTC)."""
    shown = F.concat(F.date_format(col, "dd/MM/yyyy"), F.lit(" · "), F.date_format(col, "HH:mm"), F.lit(" UTC"))
    return F.coalesce(shown, F.lit(DASH))


def fmt_hour(col: Column) -> Column:
    return F.coalesce(F.date_format(col, "HH:mm"), F.lit(DASH))


def fmt_month(ano: Column, mes: Column) -> Column:
    """(2026, 1) -> 'jan/26'; month 0 has no name, others show the number."""
    names = F.array(*[F.lit(m) for m in ("",) + MONTHS])
    name = F.coalesce(F.get(names, mes.cast("int")), mes.cast("string"))
    return F.concat(name, F.lit("/"), F.substring(ano.cast("string"), 3, 10))
