"""Is every day present, is its volume plausible, is its reject rate normal?"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitlens.functions.measures import pct
from remitlens.operators.spine import calendar_from_bounds

BASELINE_DAYS = 7
# Thresholds and the flags that stop the nightly run.
DROP_FACTOR = Decimal("0.5")
SPIKE_FACTOR = Decimal("2.0")
MAX_REJECT_PCT = Decimal("2.0")
FAULTS = [
    "LOAD FAILED",
    "VOLUME DROP OVER 50 PCT",
    "VOLUME SPIKE OVER 100 PCT",
    "REJECT RATE OVER THRESHOLD",
]
HEALTH_COLUMNS = [
    "partition_date", "load_status", "rows_written", "source_rows_read", "rejected_rows",
    "reject_rate_pct", "load_seconds", "rolling_avg_rows", "health_flag",
]


class PipelineUnhealthy(RuntimeError):
    """Raised by ``health_gate``."""


def trailing_mean(
    df: DataFrame, date_col: str, value_col: str, name: str, days: int = BASELINE_DAYS
) -> DataFrame:
    """Mean of the ``days`` dates before each date, on a gap-free calendar.

    Each value is handed to the dates it counts for and averaged there, so the calendar
    is never gathered into one task the way an unpartitioned window would.
    """
    ahead = df.filter(F.col(value_col).isNotNull()).select(
        F.explode(
            F.sequence(F.date_add(date_col, 1), F.date_add(date_col, days), F.expr("interval 1 day"))
        ).alias(date_col),
        F.col(value_col).cast("decimal(12,2)").alias("value"),
    )
    means = ahead.groupBy(date_col).agg(F.avg("value").alias(name))
    return df.join(means, date_col, "left")


def _flag(reject_pct: Column, mean: Column) -> Column:
    c = F.col
    return (
        F.when(c("logged_status").isNull(), "MISSING PARTITION")
        .when(c("logged_status") == "FAILED", "LOAD FAILED")
        .when(c("rows_written") == 0, "EMPTY PARTITION")
        .when(c("rows_written") < mean * F.lit(DROP_FACTOR), "VOLUME DROP OVER 50 PCT")
        .when(c("rows_written") > mean * F.lit(SPIKE_FACTOR), "VOLUME SPIKE OVER 100 PCT")
        .when(reject_pct > F.lit(MAX_REJECT_PCT), "REJECT RATE OVER THRESHOLD")
        .otherwise("OK")
    )


def pipeline_health(claims: DataFrame, log: DataFrame) -> DataFrame:
    """One row per calendar date between the first and the last date of service."""
    c = F.col
    calendar = calendar_from_bounds(claims, "service_from_date")
    days = trailing_mean(
        calendar.join(log, "partition_date", "left"), "partition_date", "rows_written", "mean_rows"
    ).withColumnRenamed("load_status", "logged_status")
    arrived = c("source_rows_read") + c("rejected_rows")
    # The threshold looks at the unrounded rate, the report shows two decimals.
    exact_pct = (
        c("rejected_rows").cast("decimal(20,2)") * Decimal("100")
        / F.nullif(arrived.cast("decimal(20,2)"), F.lit(Decimal("0.00")))
    )
    return days.select(
        "partition_date",
        F.coalesce("logged_status", F.lit("MISSING")).alias("load_status"),
        "rows_written",
        "source_rows_read",
        "rejected_rows",
        pct(c("rejected_rows"), arrived).alias("reject_rate_pct"),
        F.timestamp_diff("SECOND", c("load_start_utc"), c("load_end_utc")).alias("load_seconds"),
        c("mean_rows").cast("decimal(12,2)").alias("rolling_avg_rows"),
        _flag(exact_pct, c("mean_rows")).alias("health_flag"),
    )


def unhealthy_partitions(health: DataFrame) -> DataFrame:
    return health.filter("health_flag <> 'OK'").orderBy(F.desc("partition_date"))


def health_summary(health: DataFrame) -> DataFrame:
    return (
        health.groupBy("health_flag")
        .agg(
            F.count("*").alias("partition_count"),
            F.min("partition_date").alias("first_date"),
            F.max("partition_date").alias("last_date"),
        )
        .orderBy(F.desc("partition_count"))
    )


def health_gate_detail(health: DataFrame, as_of: dt.date, days: int = 7) -> DataFrame:
    """One row: number of faulty partitions since ``as_of - days`` and their list by date."""
    since = as_of - dt.timedelta(days=days)
    faults = health.filter(
        (F.col("partition_date") >= F.lit(since)) & F.col("health_flag").isin(FAULTS)
    ).select(
        F.concat(
            F.date_format("partition_date", "yyyy-MM-dd"), F.lit(" "), "health_flag", F.lit("; ")
        ).alias("item")
    )
    # Items start with the date, so ordering them orders the dates.
    return faults.agg(
        F.count("*").alias("bad_partitions"),
        F.coalesce(F.expr("listagg(item) WITHIN GROUP (ORDER BY item)"), F.lit("")).alias("detail"),
    )


def health_gate(health: DataFrame, as_of: dt.date, days: int = 7) -> None:
    """Raise when a recent partition is faulty."""
    bad, detail = health_gate_detail(health, as_of, days).first()
    if bad:
        raise PipelineUnhealthy(
            f"Pipeline health check failed on {bad} partition(s): {detail.strip()}"
        )
