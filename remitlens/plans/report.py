"""Measures of the exposure and health report pages, computed from the fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitlens.functions.measures import sum_if, sum_money
from remitlens.operators.spine import calendar_from_bounds
from remitlens.plans.analysis import CORRECT, DEFECT
from remitlens.schemas import TOTAL
from remitlens.sources.reference import NO_DENIAL_NAME, NO_DENIAL_RULE


def dim_date(fact: DataFrame) -> DataFrame:
    """Date dimension over the fact's dates; sort months by (year, month_num)."""
    return calendar_from_bounds(fact, "service_date", "date").select(
        "date",
        F.year("date").alias("year"),
        F.month("date").alias("month_num"),
        F.date_format("date", "MMM yyyy").alias("month_name"),
        F.date_format("date", "'Q'q yyyy").alias("quarter_name"),
        # weekday: Monday is 0
        F.date_sub("date", F.weekday("date")).alias("week_start"),
    )


def slice_fact(
    fact: DataFrame,
    lob: str | None = None,
    provider_type: str | None = None,
    month: str | None = None,
) -> DataFrame:
    """The page's slicers; ``month`` is 'yyyy-MM'."""
    if lob is not None:
        fact = fact.filter(F.col("lob") == lob)
    if provider_type is not None:
        fact = fact.filter(F.col("provider_type") == provider_type)
    if month is not None:
        # A date range, so that only the month's partitions are read.
        first = F.to_date(F.lit(f"{month}-01"))
        fact = fact.filter(
            (F.col("service_date") >= first) & (F.col("service_date") <= F.last_day(first))
        )
    return fact


def _exposure() -> Column:
    return sum_if(F.col("verdict") == DEFECT, F.col("amount_at_risk")).cast(TOTAL)


def _denied(verdict: str) -> Column:
    return sum_if(F.col("verdict") == verdict, F.col("denied_count"))


def _rate(part: str, whole: str) -> Column:
    """Ratio with six decimals, NULL when the whole is zero."""
    return F.try_divide(
        F.col(part).cast(TOTAL), F.col(whole).cast(TOTAL)
    ).cast("decimal(12,6)")


def kpi_measures(fact: DataFrame, by: list[str] | None = None, **slicers: str) -> DataFrame:
    """All measures, over everything or per group.

    The verdict a measure asks for replaces any outer verdict filter, so ``fact`` must not
    be filtered by verdict.
    """
    return (
        slice_fact(fact, **slicers)
        .groupBy(*(by or []))
        .agg(
            F.sum("claim_count").alias("total_claims"),
            F.sum("denied_count").alias("denied_claims"),
            sum_money(F.col("billed_amount")).alias("billed"),
            sum_money(F.col("paid_amount")).alias("paid"),
            sum_money(F.col("expected_allowed_amount")).alias("expected_allowed"),
            _exposure().alias("exposure"),
            _denied(CORRECT).alias("correct_denials"),
            _denied(DEFECT).alias("defect_driven_denials"),
        )
        .withColumn("denial_rate", _rate("denied_claims", "total_claims"))
        .withColumn("pct_denials_from_defects", _rate("defect_driven_denials", "denied_claims"))
    )


def config_status(config: DataFrame) -> DataFrame:
    wrong = F.col("loaded_value") != F.col("standard_value")
    return config.select(
        "config_key", "config_path", "loaded_value", "standard_value", "standard_source",
        F.when(wrong, "DEFECT").otherwise("OK").alias("config_status"),
    )


def rule_dimension(rules: DataFrame) -> DataFrame:
    """Rules plus the member that fact rows without a denial belong to."""
    none = rules.sparkSession.range(1).select(
        F.lit(NO_DENIAL_RULE).alias("rule_id"),
        F.lit(NO_DENIAL_NAME).alias("rule_name"),
        F.lit(0).cast("smallint").alias("rule_sequence"),
        F.lit(None).cast("string").alias("config_key"),
    )
    return none.unionByName(rules)


def denials_by_rule_verdict(fact: DataFrame, rules: DataFrame, **slicers: str) -> DataFrame:
    per_rule = slice_fact(fact, **slicers).groupBy("rule_id", "verdict").agg(
        F.sum("denied_count").alias("denied_claims")
    )
    return per_rule.join(rule_dimension(rules), "rule_id").select(
        "rule_name", "verdict", "denied_claims"
    )


def exposure_by_provider_type(fact: DataFrame, **slicers: str) -> DataFrame:
    return slice_fact(fact, **slicers).groupBy("provider_type").agg(_exposure().alias("exposure"))


def exposure_by_month(fact: DataFrame, **slicers: str) -> DataFrame:
    return (
        slice_fact(fact, **slicers)
        .groupBy(F.year("service_date").alias("year"), F.month("service_date").alias("month_num"))
        .agg(_exposure().alias("exposure"))
        .withColumn(
            "month_name",
            F.date_format(F.make_date("year", "month_num", F.lit(1)), "MMM yyyy"),
        )
        .orderBy("year", "month_num")
    )


def unhealthy_count(health: DataFrame) -> DataFrame:
    return health.filter("health_flag <> 'OK'").agg(F.count("*").alias("unhealthy_partitions"))


def volume_vs_baseline(health: DataFrame) -> DataFrame:
    return health.select("partition_date", "rows_written", "rolling_avg_rows")


def report_tables(
    fact: DataFrame, config: DataFrame, rules: DataFrame, health: DataFrame
) -> dict[str, DataFrame]:
    """Everything the report reads: aggregates and small dimensions, no claim detail."""
    return {
        "fact_claim_denial_daily": fact,
        "plan_config": config_status(config),
        "adjudication_rule": rule_dimension(rules),
        "dim_date": dim_date(fact),
        "pipeline_health": health,
    }
