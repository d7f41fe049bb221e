"""Tolerant parsers for raw claim text.

All of them return NULL for text they cannot read and none of them throws internally:
dates are recognised by their digit shape and then cast, because a formatter that
fails once per row is far slower than the cast.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DIGITS = "0123456789"


def clean_id(raw: Column) -> Column:
    return F.upper(F.trim(raw))


def clean_modifiers(raw: Column) -> Column:
    """Blanks go, case stays."""
    return F.replace(raw, F.lit(" "), F.lit(""))


def parse_units(raw: Column) -> Column:
    return F.nullif(F.trim(raw), F.lit("")).try_cast("smallint")


def parse_date(raw: Column) -> Column:
    """``2026-03-04``, ``03/04/2026`` or ``20260304``; anything else is NULL."""
    text = F.trim(raw)
    shape = F.translate(text, _DIGITS, "9" * len(_DIGITS))

    def iso(year_at: int, month_at: int, day_at: int) -> Column:
        return F.concat_ws(
            "-",
            F.substring(text, year_at, 4),
            F.substring(text, month_at, 2),
            F.substring(text, day_at, 2),
        )

    return (
        F.when(shape == "9999-99-99", text)
        .when(shape == "99/99/9999", iso(7, 1, 4))
        .when(shape == "99999999", iso(1, 5, 7))
        .try_cast("date")
    )


def parse_currency(raw: Column) -> Column:
    """Drop ``$`` and thousands commas; an amount in parentheses is negative."""
    text = F.trim(raw)
    plain = F.trim(F.translate(text, "$,", ""))
    bracketed = F.concat(F.lit("-"), F.trim(F.translate(text, "()$,", "")))
    amount = F.when(text.like("(%)"), bracketed).otherwise(plain)
    # Spark would also read an exponent (1e3) here; a claim amount never has one.
    numeric = amount.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)$")
    return F.when(numeric, amount.try_cast("decimal(12,2)"))
