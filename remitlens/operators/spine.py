"""Date and number spines."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _days(start: Column, end: Column) -> Column:
    return F.explode(F.sequence(start, end, F.expr("interval 1 day")))


def date_spine(
    spark: SparkSession, start: dt.date | str, end: dt.date | str, name: str = "partition_date"
) -> DataFrame:
    """Every date from ``start`` to ``end``, both included."""
    start, end = _as_date(start), _as_date(end)
    if end < start:
        raise ValueError(f"end date {end} precedes start date {start}; nothing to load")
    return spark.range(1).select(_days(F.lit(start), F.lit(end)).alias(name))


def calendar_from_bounds(
    df: DataFrame, date_col: str, name: str = "partition_date"
) -> DataFrame:
    """A gap-free calendar from the first to the last date of a column; empty for no dates."""
    bounds = df.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi"))
    return bounds.filter("lo is not null").select(_days(F.col("lo"), F.col("hi")).alias(name))


def number_spine(spark: SparkSession, n: int, name: str = "n") -> DataFrame:
    """1..n, generated in parallel."""
    return spark.range(1, n + 1).withColumnRenamed("id", name)


def _as_date(value: dt.date | str) -> dt.date:
    return dt.date.fromisoformat(value) if isinstance(value, str) else value
