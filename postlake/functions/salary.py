"""Salary text -> amounts, currency and band (STD-1, STD-2, FMT-1)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postlake.functions import terms
from postlake.functions.text import contains_any, literal, starts_with_any


def _amount(text: str, pattern: str) -> str:
    """US amounts carry thousands marks, the others a decimal mark."""
    digits = f"regexp_extract({text}, {literal(pattern)}, 1)"
    in_usd = contains_any(text, terms.USD_MARKS)
    plain = f"if({in_usd}, translate({digits}, ',.', ''), translate({digits}, ',', '.'))"
    return f"try_cast(nullif({plain}, '') AS double)"


def salary_fields(text: str) -> dict[str, Column]:
    """STD-1: lower and upper amount and currency of folded salary text."""
    stated = f"{text} IS NOT NULL AND NOT {contains_any(text, terms.NEGOTIABLE_PHRASES)}"
    open_below = starts_with_any(text, terms.TO_PREFIXES)
    open_above = starts_with_any(text, terms.FROM_PREFIXES)
    first = _amount(text, terms.FIRST_AMOUNT)
    second = _amount(text, terms.SECOND_AMOUNT)
    currency = (
        f"if({contains_any(text, terms.USD_MARKS)}, "
        f"{literal(terms.USD_CURRENCY)}, {literal(terms.VND_CURRENCY)})"
    )
    # An open-above text has an upper amount only if it names a second number.
    upper = f"coalesce({second}, CASE WHEN {open_below} AND NOT {open_above} THEN {first} END)"
    return {
        "salary_min": F.expr(f"CASE WHEN {stated} AND NOT {open_below} THEN {first} END"),
        "salary_max": F.expr(f"CASE WHEN {stated} THEN {upper} END"),
        "salary_currency": F.expr(f"CASE WHEN {stated} THEN {currency} END"),
    }


def _in_millions(amount: str, currency: str) -> str:
    return f"""CASE
        WHEN {currency} = {literal(terms.USD_CURRENCY)} THEN {amount} * {terms.USD_TO_MILLION_VND}D
        WHEN {amount} > {terms.PLAIN_VND_ABOVE} THEN {amount} / {terms.VND_PER_MILLION}
        ELSE {amount} END"""


def salary_band(low: str, high: str, currency: str) -> Column:
    """STD-2: band of the mean amount in millions of VND."""
    low, high = _in_millions(low, currency), _in_millions(high, currency)
    mean = f"coalesce(({low} + {high}) / 2, {low}, {high})"
    return F.expr(
        f"""CASE WHEN {mean} IS NULL THEN {literal(terms.BAND_NEGOTIABLE)}
        WHEN {mean} < 10 THEN {literal(terms.BAND_BELOW_10)}
        WHEN {mean} <= 20 THEN {literal(terms.BAND_10_TO_20)}
        WHEN {mean} <= 30 THEN {literal(terms.BAND_20_TO_30)}
        ELSE {literal(terms.BAND_ABOVE_30)} END"""
    )


def salary_text(low: Column, high: Column, currency: Column) -> Column:
    """FMT-1: the salary as shown to a reader; 0 counts as not stated."""
    shown_low = F.when(low != 0, F.format_number(low, 0))
    shown_high = F.when(high != 0, F.format_number(high, 0))
    unit = F.concat(F.lit(" "), F.coalesce(currency, F.lit("None")))
    return F.coalesce(
        F.concat(shown_low, F.lit(" - "), shown_high, unit),
        F.concat(F.lit(terms.SALARY_FROM), shown_low, unit),
        F.concat(F.lit(terms.SALARY_UP_TO), shown_high, unit),
        F.lit(terms.NO_SALARY),
    )
