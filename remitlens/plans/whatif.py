"""What would change if the configuration matched the contract?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitlens.functions.measures import count_if, money_or_zero
from remitlens.plans.adjudicate import apply_config, gather_facts
from remitlens.schemas import TOTAL


def standardize_config(config: DataFrame) -> DataFrame:
    """Set every wrong loaded value to its standard."""
    wrong = F.col("loaded_value") != F.col("standard_value")
    return config.withColumn(
        "last_changed_by",
        F.when(wrong, F.lit("REMEDIATION.PROOF")).otherwise(F.col("last_changed_by")),
    ).withColumn("loaded_value", F.col("standard_value"))


def what_if(
    claims: DataFrame,
    members: DataFrame,
    providers: DataFrame,
    benefits: DataFrame,
    auths: DataFrame,
    fees: DataFrame,
    config: DataFrame,
    config_fix=standardize_config,
) -> DataFrame:
    """Denied and paid totals before and after ``config_fix``; nothing is stored.

    Both configurations are applied to the same gathered facts and summed together.
    """
    facts = gather_facts(claims, members, providers, benefits, auths, fees)
    both = apply_config(apply_config(facts, config, "before_"), config_fix(config), "after_")
    aggregates: list[Column] = []
    for state in ("before", "after"):
        decided, denied, allowed, standard = (
            F.col(f"{state}_{name}")
            for name in ("is_evaluated", "denying_rule_id", "allowed_loaded", "allowed_standard")
        )
        # A claim the rules cannot reach keeps the state it is stored with.
        status = F.when(decided, F.when(denied.isNotNull(), "DENIED").otherwise("PAID")).otherwise(
            F.col("adjudication_status")
        )
        expected = F.when(decided, standard).otherwise(F.col("expected_allowed_amount"))
        paid = F.when(decided, allowed).otherwise(F.col("paid_amount"))
        for metric, wanted, amount in (("denied", "DENIED", expected), ("paid", "PAID", paid)):
            hit = status == wanted
            aggregates += [
                F.coalesce(count_if(hit), F.lit(0)).alias(f"{metric}_claims_{state}"),
                F.sum(F.when(hit, amount)).cast(TOTAL).alias(f"{metric}_amount_{state}"),
            ]
    row = both.agg(*aggregates)

    def line(metric: str, label: str, amount_after: Column) -> Column:
        before, after = F.col(f"{metric}_claims_before"), F.col(f"{metric}_claims_after")
        amount_before = F.col(f"{metric}_amount_before")
        return F.struct(
            F.lit(label).alias("metric"),
            before.alias("claims_before"),
            after.alias("claims_after"),
            (after - before).alias("claims_delta"),
            amount_before.alias("amount_before"),
            amount_after.cast(TOTAL).alias("amount_after"),
            (amount_after - amount_before).cast(TOTAL).alias("amount_delta"),
        )

    return row.select(
        F.inline(
            F.array(
                # A corrected plan may deny nothing at all; that is an amount of zero.
                line("denied", "Denied claims", money_or_zero(F.col("denied_amount_after"))),
                line("paid", "Paid claims", F.col("paid_amount_after")),
            )
        )
    ).orderBy("metric")


def no_side_effects(config: DataFrame, claims: DataFrame) -> DataFrame:
    """Wrong keys and denied claims as stored, to be compared before and after a what-if."""
    wrong = config.filter("loaded_value <> standard_value").agg(F.count("*")).scalar()
    return claims.filter("adjudication_status = 'DENIED'").agg(
        F.count("*").alias("denied_claims_restored")
    ).select(wrong.alias("config_defects_still_present"), "denied_claims_restored")
