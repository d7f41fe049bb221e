"""Small arithmetic expressions shared by the reports."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from remitlens.schemas import SHARE, TOTAL

HUNDRED = Decimal("100")
NO_MONEY = Decimal("0.00")


def money_or_zero(amount: Column) -> Column:
    return F.coalesce(amount, F.lit(NO_MONEY))


def sum_money(amount: Column) -> Column:
    return F.sum(amount).cast(TOTAL)


def sum_if(condition: Column, amount: Column) -> Column:
    """Sum over the rows that meet the condition, 0 when there are none."""
    return F.sum(F.when(condition, amount).otherwise(F.lit(0)))


def count_if(condition: Column) -> Column:
    return sum_if(condition, F.lit(1).cast("bigint"))


def pct(part: Column, whole: Column) -> Column:
    """Share in percent with two decimals; NULL when the whole is zero."""
    ratio = part.cast(TOTAL) * HUNDRED / F.nullif(whole.cast(TOTAL), F.lit(NO_MONEY))
    return ratio.cast(SHARE)


def in_force(on: Column, start: Column, end: Column) -> Column:
    """Whether a day lies in an effective period whose end may be open."""
    return (start <= on) & (end.isNull() | (end >= on))
