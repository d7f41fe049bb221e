"""Seven rules per claim; the first hard failure denies.

Everything that needs a join is gathered once per claim (``gather_facts``).  Applying a
configuration to the facts is arithmetic on the row plus one lookup in the small
register, so comparing two configurations costs one pass over the claims.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitlens.operators.asof import asof_rate
from remitlens.operators.coverage import flag_covered
from remitlens.operators.ranking import number_within
from remitlens.schemas import RATE, columns
from remitlens.session import materialise
from remitlens.sources.reference import PCT_PREFIX

# Hard rules in evaluation order with their denial codes.
DENIAL_CODES = {
    "R-010": "D-EL01",
    "R-020": "D-PR04",
    "R-030": "D-DU01",
    "R-040": "D-CO02",
    "R-050": "D-AU01",
    "R-060": "D-TF01",
}
SOFT_RULE = "R-070"
# Contractual filing limits in days, carved-out types, days to adjudication.
FILING_DAYS_PAR = 95
FILING_DAYS_NON_PAR = 365
CARVED_OUT_TYPES = ["Pharmacy", "Dental", "Vision"]
ADJUDICATION_DAYS = 14

SUBMISSION_KEY = ["member_id", "provider_id", "procedure_code", "service_from_date"]

EVALUATION_COLUMNS = [
    "claim_id", "member_id", "lob", "service_from_date", "received_date", "billed_amount",
    "units", "provider_type", "participating_flag", "delegated_vendor", "auth_required_flag",
    "filing_lag_days", "filing_limit", "filing_standard", "allowed_loaded", "allowed_standard",
    "price_pct_loaded", "price_pct_standard", "fail_010", "fail_020", "fail_030", "fail_040",
    "fail_050", "fail_060", "fail_070",
]


def fail_column(rule_id: str) -> str:
    return "fail_" + rule_id[-3:]


def config_pct(config: DataFrame) -> DataFrame:
    """Pricing percentages keyed by provider type."""
    return config.filter(F.col("config_key").startswith(PCT_PREFIX)).select(
        F.substr("config_key", F.lit(len(PCT_PREFIX) + 1)).alias("provider_type"),
        F.col("loaded_value").alias("price_pct_loaded"),
        F.col("standard_value").alias("price_pct_standard"),
    )


def config_settings(config: DataFrame) -> Column:
    """The single-valued settings as one scalar subquery, NULL where a key is missing."""
    keys = {
        "filing_par": "TimelyFilingDaysPar",
        "filing_non_par": "TimelyFilingDaysNonPar",
        "transport_exempt": "AuthExempt_Transportation",
    }
    return config.agg(
        F.struct(
            *[
                F.max(F.when(F.col("config_key") == key, F.col("loaded_value"))).alias(name)
                for name, key in keys.items()
            ]
        )
    ).scalar()


def price_at(pct: Column, precision=RATE) -> Column:
    """Schedule rate times units at a percentage, rounded half away from zero to cents.

    Exact until the cast: multiplying by 0.01 keeps every digit and is cheaper than dividing.
    """
    return (F.col("schedule_rate") * F.col("units") * pct * F.lit(Decimal("0.01"))).cast(precision)


def resubmitted_groups(claims: DataFrame) -> DataFrame:
    """Submission keys that occur more than once, with their first claim id."""
    return (
        claims.groupBy(*SUBMISSION_KEY)
        .agg(F.min("claim_id").alias("first_claim_id"), F.count("*").alias("submissions"))
        .filter("submissions > 1")
        .drop("submissions")
    )


def submission_seq(claims: DataFrame) -> DataFrame:
    """(claim_id, submission key, submission_seq) of the claims that share their key."""
    repeated = claims.select("claim_id", *SUBMISSION_KEY).join(
        resubmitted_groups(claims).select(*SUBMISSION_KEY), SUBMISSION_KEY, "left_semi"
    )
    return number_within(
        repeated, SUBMISSION_KEY, [F.col("claim_id")], "submission_seq"
    )


def enrich(
    claims: DataFrame, members: DataFrame, providers: DataFrame, benefits: DataFrame,
    how: str = "inner", keys: DataFrame | None = None,
) -> DataFrame:
    """Claims with the member, provider and benefit attributes the rules read.

    ``how='left'`` reads the member ids of ``keys`` (else of ``claims``) first, see ``_with_member_terms``.
    """
    # Provider and benefit are joined first: both are small next to the claims.  Written, their size is known
    # before Spark decides how the claims meet them.
    provider_terms = materialise(providers.join(
        benefits.select("provider_type", "auth_required_flag", "delegated_vendor",
                        F.lit(True).alias("has_benefit")),
        "provider_type", how,
    ).select("provider_id", "provider_type", "participating_flag", "contract_eff_date",
             "auth_required_flag", "delegated_vendor", "has_benefit"))
    if how == "left":
        covered = _with_member_terms(claims, members, claims if keys is None else keys)
    else:
        member_terms = members.select("member_id", "coverage_term_date", F.lit(True).alias("has_member"))
        covered = claims.join(member_terms, "member_id", how)
    return covered.join(provider_terms, "provider_id", how)


def _with_member_terms(claims: DataFrame, members: DataFrame, keys: DataFrame) -> DataFrame:
    """Left join with (coverage_term_date, has_member) that need not move the claims to the members.

    A member without an end of coverage only says that it exists.  So the claims' distinct member ids meet the members, and
    the claims meet the ids that no member has and the members with more to say: an end of coverage, or several rows.  Both
    are written, so that Spark knows their size; where they are many, they are shuffled like any other table.
    """
    terms = members.select("member_id", "coverage_term_date")
    repeated = terms.groupBy("member_id").agg(F.count("*").alias("_rows")).filter("_rows > 1")
    said = materialise(
        terms.join(repeated, "member_id", "left")
        .filter(F.col("coverage_term_date").isNotNull() | F.col("_rows").isNotNull())
        .drop("_rows")
    )
    asked = keys.select("member_id").filter(F.col("member_id").isNotNull()).distinct()
    unknown = materialise(asked.join(terms, "member_id", "left_anti")).withColumn("_unknown", F.lit(True))
    found = F.when(F.col("member_id").isNotNull() & F.col("_unknown").isNull(), F.lit(True))
    return (
        claims.join(unknown, "member_id", "left").join(said, "member_id", "left")
        .withColumn("has_member", found).drop("_unknown")
    )


def mark_resubmissions(claims: DataFrame) -> DataFrame:
    """Add ``is_resubmission``: another claim with the same submission key has a smaller id."""
    return claims.join(resubmitted_groups(claims), SUBMISSION_KEY, "left").withColumn(
        "is_resubmission",
        F.coalesce(F.col("claim_id") > F.col("first_claim_id"), F.lit(False)),
    ).drop("first_claim_id")


def gather_facts(
    claims: DataFrame,
    members: DataFrame,
    providers: DataFrame,
    benefits: DataFrame,
    auths: DataFrame,
    fees: DataFrame,
) -> DataFrame:
    """Every claim with all joined attributes; missing ones are NULL, no claim is lost.

    The claims may come with ``is_resubmission`` (``mark_resubmissions``) where they have been written in between.
    """
    # Repeated submissions are marked first, while the rows do not carry the joined attributes yet.
    written = "is_resubmission" in claims.columns
    numbered = claims if written else mark_resubmissions(claims)
    # Stored amounts are re-derived, so only what the rules read is carried.
    enriched = asof_rate(enrich(numbered, members, providers, benefits, how="left", keys=claims), fees)
    if not written:
        return flag_covered(enriched, auths, dates=claims)
    # Reading written claims twice is cheap, so only those that need an authorization are moved to look for one;
    # of the others no rule asks whether they have it.
    needed = F.coalesce("auth_required_flag", F.lit(False))
    return flag_covered(enriched.filter(needed), auths, dates=claims).unionByName(
        enriched.filter(~needed).withColumn("auth_on_file", F.lit(False))
    )


def apply_config(facts: DataFrame, config: DataFrame, prefix: str = "") -> DataFrame:
    """Add the seven rule flags, both prices, the denying rule and ``is_evaluated``.

    A claim lacking its member, benefit, rate or percentage is not evaluated.  With a
    ``prefix`` the added columns can stand beside those of another configuration.
    """
    pct = config_pct(config).select(
        "provider_type",
        F.col("price_pct_loaded").alias(f"{prefix}price_pct_loaded"),
        F.col("price_pct_standard").alias(f"{prefix}price_pct_standard"),
    )
    c = F.col
    par = c("participating_flag")
    lag = F.datediff("received_date", "service_from_date")
    settings = config_settings(config)
    # Whole days only: a fraction in the register is cut off.
    limit = F.when(par, settings["filing_par"].cast("int")).otherwise(
        settings["filing_non_par"].cast("int")
    )
    exempt = (c("provider_type") == "Transportation") & settings["transport_exempt"].cast("boolean")
    loaded, standard = c(f"{prefix}price_pct_loaded"), c(f"{prefix}price_pct_standard")
    failures = {
        "R-010": c("service_from_date") > c("coverage_term_date"),
        "R-020": par & (c("contract_eff_date") > c("service_from_date")),
        "R-030": c("is_resubmission"),
        "R-040": c("delegated_vendor").isNotNull() & c("provider_type").isin(CARVED_OUT_TYPES),
        "R-050": c("auth_required_flag") & ~exempt & ~c("auth_on_file"),
        "R-060": lag > limit,
        SOFT_RULE: loaded != standard,
    }
    scored = facts.join(pct, "provider_type", "left").withColumns(
        {
            f"{prefix}filing_lag_days": lag,
            f"{prefix}filing_limit": limit,
            f"{prefix}filing_standard": F.when(par, F.lit(FILING_DAYS_PAR)).otherwise(
                F.lit(FILING_DAYS_NON_PAR)
            ),
            f"{prefix}allowed_loaded": price_at(loaded),
            f"{prefix}allowed_standard": price_at(standard),
            f"{prefix}is_evaluated": c("has_member").isNotNull()
            & c("has_benefit").isNotNull()
            & c("schedule_rate").isNotNull()
            & loaded.isNotNull(),
            # An unknown comparison is not a failure.
            **{
                prefix + fail_column(rule): F.coalesce(failed, F.lit(False)).cast("int")
                for rule, failed in failures.items()
            },
        }
    )
    denying = F.coalesce(
        *[F.when(c(prefix + fail_column(rule)) == 1, F.lit(rule)) for rule in DENIAL_CODES]
    )
    return scored.withColumn(
        f"{prefix}denying_rule_id", F.when(c(f"{prefix}is_evaluated"), denying)
    )


def evaluate_rules(
    claims: DataFrame,
    members: DataFrame,
    providers: DataFrame,
    benefits: DataFrame,
    auths: DataFrame,
    fees: DataFrame,
    config: DataFrame,
) -> DataFrame:
    """Rule flags and prices of every claim that can be evaluated."""
    facts = gather_facts(claims, members, providers, benefits, auths, fees)
    return apply_config(facts, config).filter("is_evaluated").select(*EVALUATION_COLUMNS)


def first_failure(evaluation: DataFrame) -> DataFrame:
    """Add the first failing hard rule and its denial code, both NULL for a paid claim."""
    rule = F.coalesce(
        *[F.when(F.col(fail_column(r)) == 1, F.lit(r)) for r in DENIAL_CODES]
    )
    return evaluation.withColumn("denying_rule_id", rule).withColumn(
        "denial_code", denial_code(F.col("denying_rule_id"))
    )


def denial_code(rule_id: Column) -> Column:
    return F.coalesce(*[F.when(rule_id == r, F.lit(code)) for r, code in DENIAL_CODES.items()])


def denials(outcome: DataFrame) -> DataFrame:
    return outcome.filter(F.col("denying_rule_id").isNotNull()).select(
        "claim_id",
        F.col("denying_rule_id").alias("rule_id"),
        "denial_code",
        F.current_timestamp().alias("denied_utc"),
    )


def _result_columns(decided: Column, rule: Column, loaded: Column, standard: Column) -> dict:
    """New values of the written-back claim columns where a decision exists."""
    paid = F.when(rule.isNotNull(), F.lit(Decimal("0.00"))).otherwise(loaded)
    status = F.when(rule.isNotNull(), F.lit("DENIED")).otherwise(F.lit("PAID"))
    due = F.date_add("received_date", ADJUDICATION_DAYS)
    keep = F.col
    return {
        "adjudication_status": F.when(decided, status).otherwise(keep("adjudication_status")),
        "expected_allowed_amount": F.when(decided, standard)
        .otherwise(keep("expected_allowed_amount")).cast(RATE),
        "paid_amount": F.when(decided, paid).otherwise(keep("paid_amount")).cast(RATE),
        "adjudicated_date": F.when(decided, due).otherwise(keep("adjudicated_date")),
    }


def apply_outcome(claims: DataFrame, outcome: DataFrame) -> DataFrame:
    """Write a stored outcome back onto the claims; claims without one stay as they are."""
    decided = outcome.select(
        "claim_id", "denying_rule_id", "allowed_loaded", "allowed_standard",
        F.lit(True).alias("decided"),
    )
    c = F.col
    return (
        claims.join(decided, "claim_id", "left")
        .withColumns(
            _result_columns(
                c("decided").isNotNull(), c("denying_rule_id"), c("allowed_loaded"),
                c("allowed_standard"),
            )
        )
        .select(*columns("claim"))
    )


def adjudicate_claims(
    claims: DataFrame,
    members: DataFrame,
    providers: DataFrame,
    benefits: DataFrame,
    auths: DataFrame,
    fees: DataFrame,
    config: DataFrame,
) -> DataFrame:
    """All claims with their new status and amounts, plus the evaluation, in one pass.

    The claim columns come first.  The others are NULL or unused where ``is_evaluated``
    is false; ``denial_rule_id`` is the denying rule.
    """
    c = F.col
    scored = apply_config(
        gather_facts(claims, members, providers, benefits, auths, fees), config
    )
    evaluation = [e for e in EVALUATION_COLUMNS if e not in columns("claim")]
    return scored.withColumns(
        _result_columns(
            c("is_evaluated"), c("denying_rule_id"), c("allowed_loaded"), c("allowed_standard")
        )
    ).select(
        *columns("claim"),
        *evaluation,
        "is_evaluated",
        "denying_rule_id",
        denial_code(c("denying_rule_id")).alias("denial_code"),
    )


def rule_trace(outcome: DataFrame, rules: DataFrame, carried: tuple[str, ...] = ()) -> DataFrame:
    """One row per claim and rule: PASS, FAIL, or SKIP after the denying rule; ``carried`` columns of the outcome come along."""
    chain = rules.agg(
        F.sort_array(F.collect_list(F.struct("rule_sequence", "rule_id")))
    ).scalar()
    denied_at = rules.select(
        F.col("rule_id").alias("denying_rule_id"), F.col("rule_sequence").alias("denied_at")
    )
    c = F.col
    rows = (
        outcome.join(denied_at, "denying_rule_id", "left")
        .withColumn("rule", F.explode(chain))
        .withColumn("rule_id", c("rule.rule_id"))
    )
    failed = F.coalesce(
        *[F.when(c("rule_id") == r, c(fail_column(r)) == 1) for r in [*DENIAL_CODES, SOFT_RULE]],
        F.lit(False),
    )
    result = (
        F.when(c("rule.rule_sequence") > c("denied_at"), F.lit("SKIP"))
        .when(failed, F.lit("FAIL"))
        .otherwise(F.lit("PASS"))
    )
    return rows.select(
        "claim_id", "rule_id", result.alias("rule_result"), _evidence().alias("evidence"), *carried
    )


def _evidence() -> Column:
    """Fixed texts; a missing part prints as nothing."""

    def text(*parts: Column | str) -> Column:
        return F.concat_ws("", *[F.lit(p) if isinstance(p, str) else p for p in parts])

    c = F.col
    vendor = F.concat(F.lit(" delegated to "), c("delegated_vendor"))
    return (
        F.when(c("rule_id") == "R-010",
               text("Member ", c("member_id"), ", DOS ",
                    F.date_format("service_from_date", "yyyy-MM-dd")))
        .when(c("rule_id") == "R-050", text("Category ", c("provider_type"), vendor))
        .when(c("rule_id") == "R-060",
              text("Filing lag ", c("filing_lag_days").cast("string"), " days against a ",
                   c("filing_limit").cast("string"), " day limit; contractual limit is ",
                   c("filing_standard").cast("string"), " days"))
        .when(c("rule_id") == SOFT_RULE,
              text("Priced at ", c("price_pct_loaded").cast("string"),
                   " pct against a contracted ", c("price_pct_standard").cast("string"),
                   " pct; allowed ", c("allowed_loaded").cast("string"),
                   " versus ", c("allowed_standard").cast("string")))
    )
