"""Price, classify and aggregate claims to the daily fact; decide which dates to load."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitlens.functions.measures import money_or_zero, sum_money
from remitlens.operators.asof import asof_rate
from remitlens.operators.merge import LOADED
from remitlens.operators.spine import date_spine
from remitlens.plans.adjudicate import config_pct, price_at
from remitlens.schemas import columns
from remitlens.sources.reference import NO_DENIAL_RULE

GRAIN = ["service_date", "lob", "provider_type", "rule_id", "verdict"]


def with_denials(claims: DataFrame, denials: DataFrame) -> DataFrame:
    """Stored claims with ``denying_rule_id`` from the stored denials."""
    rule = denials.select("claim_id", F.col("rule_id").alias("denying_rule_id"))
    return claims.join(rule, "claim_id", "left")


def price(
    claims: DataFrame, providers: DataFrame, fees: DataFrame, config: DataFrame
) -> DataFrame:
    """Add ``provider_type`` and ``expected_allowed`` at the standard percentage.

    A claim without a rate or percentage keeps its row with a NULL price.
    """
    types = providers.select("provider_id", "provider_type")
    standard = config_pct(config).select("provider_type", "price_pct_standard")
    base = claims.drop("provider_type", "price_pct_standard", "schedule_rate")
    return (
        asof_rate(base.join(types, "provider_id"), fees)
        .join(standard, "provider_type", "left")
        .withColumn("expected_allowed", price_at(F.col("price_pct_standard"), "decimal(14,2)"))
        .drop("schedule_rate", "price_pct_standard")
    )


def classify(priced: DataFrame, rules: DataFrame, config: DataFrame) -> DataFrame:
    """Add ``rule_id`` and exactly one ``verdict`` to claims carrying ``denying_rule_id``.

    The verdict of a denial depends on its rule's configuration key, not on the claim.
    """
    wrong_rules = rules.join(
        config.filter("loaded_value <> standard_value").select("config_key"),
        "config_key", "left_semi",
    ).select(F.col("rule_id").alias("denying_rule_id"), F.lit(True).alias("wrong_config"))
    c = F.col
    paid = c("denying_rule_id").isNull()
    verdict = (
        F.when(c("adjudication_status") == "PENDING", "PENDING ADJUDICATION")
        .when(paid & c("expected_allowed").isNull(), "UNPRICED")
        .when(paid & (money_or_zero(c("paid_amount")) >= c("expected_allowed")), "CLEAN")
        .when(paid | c("wrong_config"), "CONFIGURATION DEFECT")
        .otherwise("CORRECT DENIAL")
    )
    return (
        priced.join(wrong_rules, "denying_rule_id", "left")
        .withColumn("verdict", verdict)
        .withColumn("rule_id", F.coalesce("denying_rule_id", F.lit(NO_DENIAL_RULE)))
        .drop("wrong_config")
    )


def daily_fact(classified: DataFrame) -> DataFrame:
    c = F.col
    expected, paid = money_or_zero(c("expected_allowed")), money_or_zero(c("paid_amount"))
    denied = (c("adjudication_status") == "DENIED").cast("bigint")
    return (
        classified.withColumn("service_date", c("service_from_date"))
        .groupBy(*GRAIN)
        .agg(
            F.count("*").alias("claim_count"),
            F.sum(denied).alias("denied_count"),
            sum_money(c("billed_amount")).alias("billed_amount"),
            sum_money(expected).alias("expected_allowed_amount"),
            sum_money(paid).alias("paid_amount"),
            sum_money(expected - paid).alias("amount_at_risk"),
        )
        .withColumn("partition_loaded_utc", F.current_timestamp())
        .select(*columns("fact_claim_denial_daily"))
    )


def build_fact(
    claims: DataFrame, providers: DataFrame, fees: DataFrame, rules: DataFrame, config: DataFrame
) -> DataFrame:
    """Fact rows of claims that carry ``denying_rule_id``."""
    return daily_fact(classify(price(claims, providers, fees, config), rules, config))


@dataclass
class DateLoad:
    fact: DataFrame
    results: DataFrame


def load_dates(
    dates: DataFrame,
    claims: DataFrame,
    rejects: DataFrame,
    providers: DataFrame,
    fees: DataFrame,
    rules: DataFrame,
    config: DataFrame,
    started: dt.datetime,
) -> DateLoad:
    """Fact rows and log results of all ``dates`` (partition_date) in one job.

    ``claims`` carries ``denying_rule_id``.  Stored partitioned by service date, only the
    partitions of the requested dates are read.
    """
    scope = dates.select(F.col("partition_date").alias("service_from_date"))
    scoped = claims.join(scope, "service_from_date", "left_semi")
    fact = build_fact(scoped, providers, fees, rules, config)
    return DateLoad(fact, load_results(dates, fact, scoped, rejects, started))


def load_results(
    dates: DataFrame, fact: DataFrame, scoped: DataFrame, rejects: DataFrame, started: dt.datetime
) -> DataFrame:
    """One SUCCESS row per requested date, with zero counts where nothing was found."""

    def per_date(df: DataFrame, date_col: str, name: str) -> DataFrame:
        return df.groupBy(F.col(date_col).alias("partition_date")).agg(F.count("*").alias(name))

    counts = [
        per_date(fact, "service_date", "rows_written"),
        per_date(scoped, "service_from_date", "source_rows_read"),
        per_date(rejects, "service_date", "rejected_rows"),
    ]
    joined = reduce(lambda df, count: df.join(count, "partition_date", "left"), counts, dates)
    return joined.fillna(0, ["rows_written", "source_rows_read", "rejected_rows"]).select(
        "partition_date",
        "rows_written",
        "source_rows_read",
        "rejected_rows",
        F.lit(started).cast("timestamp").alias("load_start_utc"),
        F.current_timestamp().alias("load_end_utc"),
        F.lit("SUCCESS").alias("load_status"),
        F.lit(None).cast("string").alias("load_message"),
    )


def failed_result(dates: DataFrame, started: dt.datetime, message: str) -> DataFrame:
    """Log rows of dates whose load raised an error."""
    zero = F.lit(0).cast("bigint")
    return dates.select(
        "partition_date",
        zero.alias("rows_written"),
        zero.alias("source_rows_read"),
        zero.alias("rejected_rows"),
        F.lit(started).cast("timestamp").alias("load_start_utc"),
        F.current_timestamp().alias("load_end_utc"),
        F.lit("FAILED").alias("load_status"),
        F.lit(message[:512]).alias("load_message"),
    )


def pending_dates(spine: DataFrame, log: DataFrame, reload: bool = False) -> DataFrame:
    """Dates of the spine without a good load, or all of them for a reload."""
    if reload:
        return spine
    good = log.filter(F.col("load_status").isin(LOADED)).select("partition_date")
    return spine.join(good, "partition_date", "left_anti")


def backfill_dates(
    log: DataFrame, start: dt.date | str, end: dt.date | str, reload: bool = False
) -> DataFrame:
    return pending_dates(date_spine(log.sparkSession, start, end), log, reload)


def catch_up_dates(log: DataFrame, as_of: dt.date, lookback: int = 7) -> DataFrame:
    """Dates the nightly run loads: yesterday and ``lookback`` days before it, unless good."""
    yesterday = as_of - dt.timedelta(days=1)
    return backfill_dates(log, yesterday - dt.timedelta(days=lookback), yesterday)


def stale_dates(dates: DataFrame, fact: DataFrame) -> DataFrame:
    """Requested dates without a fact row; their stored partition has to be removed."""
    loaded = fact.select(F.col("service_date").alias("partition_date"))
    return dates.join(loaded, "partition_date", "left_anti")


def replace_fact_dates(current: DataFrame, fact: DataFrame, dates: DataFrame) -> DataFrame:
    """The fact after a reload of ``dates``: their old rows go even when no new row comes."""
    touched = dates.select(F.col("partition_date").alias("service_date"))
    kept = current.join(touched, "service_date", "left_anti")
    return kept.select(*current.columns).unionByName(fact.select(*current.columns))
