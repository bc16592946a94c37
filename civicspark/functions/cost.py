"""Model cost in US dollars."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

# Dollars per million tokens, and the monthly cap.
EMBED_PER_MILLION = Decimal("0.02")
CHAT_INPUT_PER_MILLION = Decimal("0.15")
CHAT_OUTPUT_PER_MILLION = Decimal("0.60")
MONTHLY_CAP = Decimal("10")
MILLION = Decimal("1000000")


def _charge(tokens: Column, price: Decimal) -> Column:
    return tokens.cast("decimal(20,0)") * F.lit(price / MILLION)


def embed_cost(tokens: Column) -> Column:
    return _charge(tokens, EMBED_PER_MILLION).cast("decimal(18,6)")


def chat_cost(tokens_in: Column, tokens_out: Column) -> Column:
    total = _charge(tokens_in, CHAT_INPUT_PER_MILLION) + _charge(tokens_out, CHAT_OUTPUT_PER_MILLION)
    return total.cast("decimal(18,6)")
