"""Tolerant conversions: a value that does not parse becomes NULL."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import strip_space

# Texts read as true.
TRUE_WORDS = ("1", "true", "s", "sim", "t")


# A failing ``try_cast`` raises and catches an exception per row, so texts that
# are no numbers are sorted out by a pattern first.
_WHOLE = r"^[+-]?[0-9]{1,9}$"
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_ISO = r"^[0-9]{4}(-|$)"


def to_double(col: Column) -> Column:
    text = strip_space(col.cast("string"))
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def to_int(col: Column) -> Column:
    """'12' and '12.0' are both 12."""
    text = strip_space(col.cast("string"))
    return F.when(text.rlike(_WHOLE), text.try_cast("int")).when(
        text.rlike(_NUMBER), text.try_cast("double").try_cast("int")
    )


def to_money(col: Column) -> Column:
    text = strip_space(col.cast("string"))
    return F.when(text.rlike(_NUMBER), text.try_cast("decimal(12,2)"))


def to_day(col: Column) -> Column:
    text = strip_space(col.cast("string"))
    return F.when(text.rlike(_ISO), text.try_cast("date"))


def to_instant(col: Column) -> Column:
    text = strip_space(col.cast("string"))
    return F.when(text.rlike(_ISO), text.try_cast("timestamp"))


def to_flag(col: Column) -> Column:
    """Two-valued: true words or a number whose integer part is 1."""
    text = F.lower(strip_space(col.cast("string")))
    return F.coalesce(text.isin(*TRUE_WORDS) | text.rlike(r"^\+?0*1\.[0-9]*$"), F.lit(False))


def to_approval(col: Column) -> Column:
    """Three-valued result of a vote: 1 true, 0 false, anything else NULL."""
    text = F.lower(strip_space(col.cast("string")))
    return F.when(text.rlike(r"^(\+?0*1(\.0*)?|true)$"), F.lit(True)).when(
        text.rlike(r"^([+-]?0+(\.0*)?|false)$"), F.lit(False)
    )


def to_number(col: Column) -> Column:
    """Number for display: NULL, NaN and unparsable become 0."""
    return F.coalesce(to_double(col), F.lit(0.0))
