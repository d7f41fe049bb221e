"""Analysis reports.

``claims`` here means adjudicated claims that carry ``denying_rule_id``: the result of
``adjudicate_claims``, or stored claims through ``with_denials``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitlens.functions.measures import count_if, pct, sum_if, sum_money
from remitlens.operators.hierarchy import hierarchy
from remitlens.operators.ranking import rank_within
from remitlens.plans.adjudicate import FILING_DAYS_PAR
from remitlens.schemas import TOTAL
from remitlens.sources.reference import NO_DENIAL_NAME

DEFECT = "CONFIGURATION DEFECT"
CORRECT = "CORRECT DENIAL"

# Report labels of the three defects.
FILING_LABEL = "TimelyFilingDaysPar (90 vs 95)"
UNDERPAID_LABEL = "FeeSchedulePct_LTSS (80 vs 100)"
AUTH_LABEL = "AuthExempt_Transportation (0 vs 1)"
GRID_LABELS = {
    "filing": "Timely filing loaded at 90, contract 95",
    "underpaid": "LTSS priced at 80 pct, contract 100 pct",
    "auth": "Transportation auth exemption not loaded",
}


def config_register(config: DataFrame, rules: DataFrame) -> DataFrame:
    matches = F.col("loaded_value") == F.col("standard_value")
    return (
        config.join(rules.select("config_key", "rule_id", "rule_name"), "config_key", "left")
        .select(
            "config_key", "config_path", "config_scope", "loaded_value", "standard_value",
            F.when(matches, "MATCHES STANDARD").otherwise("DEFECT").alias("config_status"),
            "rule_id", "rule_name", "standard_source",
        )
        .orderBy("config_status", "config_key")
    )


def denial_mix_by_rule(fact: DataFrame, rules: DataFrame) -> DataFrame:
    c = F.col
    per_rule = fact.groupBy("rule_id").agg(
        F.sum("claim_count").alias("claims"),
        sum_if(c("verdict") == CORRECT, c("claim_count")).alias("correct_denials"),
        sum_if(c("verdict") == DEFECT, c("claim_count")).alias("defect_driven"),
        sum_if(c("verdict") == DEFECT, c("amount_at_risk")).cast(TOTAL).alias("exposure_usd"),
    )
    return (
        per_rule.join(rules.select("rule_id", "rule_name"), "rule_id", "left")
        .withColumn("rule_name", F.coalesce("rule_name", F.lit(NO_DENIAL_NAME)))
        .orderBy(F.desc("exposure_usd"))
    )


def denial_mix_by_segment(fact: DataFrame) -> DataFrame:
    c = F.col
    return (
        fact.groupBy("lob", "provider_type")
        .agg(
            F.sum("claim_count").alias("claims"),
            F.sum("denied_count").alias("denied"),
            sum_if(c("verdict") == DEFECT, c("amount_at_risk")).cast(TOTAL).alias("exposure_usd"),
        )
        .filter("claims > 0")
        .withColumn("denial_rate_pct", pct(c("denied"), c("claims")))
        .orderBy(F.desc("exposure_usd"), "lob", "provider_type")
    )


def verdict_distribution(fact: DataFrame) -> DataFrame:
    total = fact.agg(F.sum("claim_count")).scalar()
    return (
        fact.groupBy("verdict")
        .agg(
            F.sum("claim_count").alias("claims"),
            sum_money(F.col("amount_at_risk")).alias("expected_minus_paid"),
        )
        .withColumn("pct_of_claims", pct(F.col("claims"), total))
        .orderBy(F.desc("claims"))
    )


def _provider_terms(claims: DataFrame, providers: DataFrame) -> DataFrame:
    known = claims.drop("provider_type", "participating_flag")
    return known.join(
        providers.select("provider_id", "provider_type", "participating_flag"), "provider_id"
    )


def _filing_lag() -> Column:
    return F.datediff("received_date", "service_from_date")


def _late_by_config() -> Column:
    """Denied as late although filed within the participating contract's limit."""
    return (
        (F.col("denying_rule_id") == "R-060")
        & F.col("participating_flag")
        & (_filing_lag() <= FILING_DAYS_PAR)
    )


def _paid_short() -> Column:
    return (
        (F.col("provider_type") == "LTSS")
        & (F.col("adjudication_status") == "PAID")
        & (F.col("paid_amount") < F.col("expected_allowed_amount"))
    )


def _transport_auth() -> Column:
    return (F.col("denying_rule_id") == "R-050") & (F.col("provider_type") == "Transportation")


def exposure_timely_filing(claims: DataFrame, providers: DataFrame) -> DataFrame:
    hits = _provider_terms(claims, providers).filter(_late_by_config())
    return hits.agg(
        F.count("*").alias("recoverable_claims"),
        sum_money(F.col("expected_allowed_amount")).alias("exposure_usd"),
        F.min(_filing_lag()).alias("min_filing_lag"),
        F.max(_filing_lag()).alias("max_filing_lag"),
    ).withColumn("defect", F.lit(FILING_LABEL))


def exposure_underpayment(claims: DataFrame, providers: DataFrame) -> DataFrame:
    c = F.col
    hits = _provider_terms(claims, providers).filter(_paid_short())
    return hits.agg(
        F.count("*").alias("underpaid_claims"),
        F.sum("units").alias("total_units"),
        sum_money(c("paid_amount")).alias("paid_usd"),
        sum_money(c("expected_allowed_amount")).alias("should_have_paid_usd"),
        sum_money(c("expected_allowed_amount") - c("paid_amount")).alias("exposure_usd"),
    ).withColumn("defect", F.lit(UNDERPAID_LABEL))


def exposure_auth_exempt(
    claims: DataFrame, providers: DataFrame, benefits: DataFrame
) -> DataFrame:
    hits = (
        _provider_terms(claims, providers)
        .filter(_transport_auth())
        .drop("delegated_vendor")
        .join(benefits.select("provider_type", "delegated_vendor"), "provider_type")
    )
    return hits.agg(
        F.count("*").alias("recoverable_claims"),
        sum_money(F.col("expected_allowed_amount")).alias("exposure_usd"),
        F.max("delegated_vendor").alias("delegated_to"),
    ).withColumn("defect", F.lit(AUTH_LABEL))


def exposure_by_defect(claims: DataFrame, providers: DataFrame) -> DataFrame:
    """The three defects on one grid, from one pass: no claim belongs to two of them."""
    expected, paid = F.col("expected_allowed_amount"), F.col("paid_amount")
    populations = {
        "filing": (_late_by_config(), expected),
        "underpaid": (_paid_short(), expected - paid),
        "auth": (_transport_auth(), expected),
    }
    aggregates = []
    for name, (condition, amount) in populations.items():
        aggregates += [
            F.coalesce(count_if(condition), F.lit(0)).alias(f"{name}_claims"),
            sum_money(F.when(condition, amount)).alias(f"{name}_usd"),
        ]
    row = _provider_terms(claims, providers).agg(*aggregates)
    everything = sum((F.coalesce(f"{n}_usd", F.lit(0)) for n in populations), F.lit(0))
    grid = F.array(
        *[
            F.struct(
                F.lit(GRID_LABELS[n]).alias("defect"),
                F.col(f"{n}_claims").alias("claims"),
                F.col(f"{n}_usd").alias("exposure_usd"),
            )
            for n in populations
        ]
    )
    return (
        row.select(everything.alias("everything"), F.inline(grid))
        .withColumn("pct_of_total", pct(F.col("exposure_usd"), F.col("everything")))
        .drop("everything")
        .orderBy(F.desc("exposure_usd"))
    )


def denied_by_provider(claims: DataFrame) -> DataFrame:
    """Denied claims and their full expected amount per provider, correct denials included."""
    return (
        claims.filter(F.col("denying_rule_id").isNotNull())
        .groupBy("provider_id")
        .agg(
            F.count("*").alias("denied_claims"),
            sum_money(F.col("expected_allowed_amount")).alias("exposure_usd"),
        )
    )


def provider_exposure_ranked(claims: DataFrame, providers: DataFrame) -> DataFrame:
    exposure = denied_by_provider(claims).filter("exposure_usd > 0").join(providers, "provider_id")
    ranked = rank_within(
        exposure.select(
            "provider_type", "provider_id", "provider_name", "participating_flag",
            "denied_claims", "exposure_usd",
        ),
        "provider_type", "exposure_usd", "provider_id", "rank_in_type",
    )
    totals = ranked.groupBy("provider_type").agg(F.sum("exposure_usd").alias("type_usd"))
    return (
        ranked.join(totals, "provider_type")
        .select(
            "provider_type",
            "rank_in_type",
            "provider_id",
            "provider_name",
            F.when(F.col("participating_flag"), "PAR").otherwise("NON-PAR").alias("status"),
            "denied_claims",
            "exposure_usd",
            pct(F.col("exposure_usd"), F.col("type_usd")).alias("pct_of_type_exposure"),
        )
        .orderBy("provider_type", "rank_in_type")
    )


def provider_rollup(claims: DataFrame, providers: DataFrame) -> DataFrame:
    """Denied exposure of every root over its whole tree.

    Claims are summed per provider before they meet the tree.
    """
    tree = hierarchy(providers, "provider_id", "parent_provider_id")
    names = providers.select(
        F.col("provider_id").alias("root_id"), F.col("provider_name").alias("root_provider_name")
    )
    return (
        tree.join(
            denied_by_provider(claims), F.col("node_id") == F.col("provider_id")
        )
        .groupBy("root_id")
        .agg(
            F.max("depth").alias("hierarchy_depth"),
            # A provider hangs under one root and appears once per root here.
            F.count("*").alias("billing_entities"),
            F.sum("denied_claims").alias("denied_claims"),
            sum_money(F.col("exposure_usd")).alias("rolled_up_exposure"),
        )
        .filter("rolled_up_exposure > 0")
        .join(names, "root_id")
        .withColumnRenamed("root_id", "root_provider_id")
        .orderBy(F.desc("rolled_up_exposure"))
    )
