"""Assertions over the built tables, key checks and row-count expectations.

Every group of related checks is one aggregate over one pass, unfolded into rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitlens.functions.measures import count_if
from remitlens.operators.merge import LOADED
from remitlens.plans.adjudicate import SOFT_RULE
from remitlens.schemas import FOREIGN_KEYS, NULLABLE, PRIMARY_KEYS, TOTAL, columns
from remitlens.session import materialise


@dataclass
class BuiltTables:
    """What the pipeline has stored; ``claims`` are the adjudicated claims.

    ``denied_trace`` holds the trace rows of claims with a denial and its ``denial_sequence`` (``meet_denials``), where they
    can be had apart from the trace.
    """

    claims: DataFrame
    denials: DataFrame
    trace: DataFrame
    fact: DataFrame
    log: DataFrame
    members: DataFrame
    providers: DataFrame
    rules: DataFrame
    config: DataFrame
    denied_trace: DataFrame | None = None


def union_labelled(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _count(condition: Column) -> Column:
    return F.coalesce(count_if(condition), F.lit(0))


def _grid(row: DataFrame, tests: list[tuple[int, str, Column | str, Column]]) -> DataFrame:
    """Unfold a one-row aggregate into (test_num, test_name, expected, actual)."""

    def text(value: Column | str) -> Column:
        return F.lit(value) if isinstance(value, str) else value.cast("string")

    return row.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(number).alias("test_num"),
                        F.lit(name).alias("test_name"),
                        text(expected).alias("expected"),
                        text(actual).alias("actual"),
                    )
                    for number, name, expected, actual in tests
                ]
            )
        )
    )


def denied_without_denial(claims: DataFrame, denials: DataFrame) -> DataFrame:
    """DENIED claims that have no denial row."""
    return claims.filter("adjudication_status = 'DENIED'").join(
        denials.select("claim_id"), "claim_id", "left_anti"
    )


DENIAL_SEQUENCE = "denial_sequence"


def _denied(denials: DataFrame, rules: DataFrame) -> DataFrame:
    """(claim_id, denying_rule_id, place of that rule) of every denial."""
    return denials.select("claim_id", F.col("rule_id").alias("denying_rule_id")).join(
        rules.select(
            F.col("rule_id").alias("denying_rule_id"), F.col("rule_sequence").alias(DENIAL_SEQUENCE)
        ),
        "denying_rule_id",
    )


def meet_denials(outcome: DataFrame, denials: DataFrame, rules: DataFrame) -> DataFrame:
    """Outcomes of claims with a denial and its ``denial_sequence``, once for each of their denials.

    A trace made of these rows needs no join with the denials, which would move a row per claim and rule.
    """
    return outcome.join(_denied(denials, rules).drop("denying_rule_id"), "claim_id")


def rule_sequence_violations(trace: DataFrame, denials: DataFrame, rules: DataFrame) -> DataFrame:
    """Trace rows of denied claims that are not SKIP after, or FAIL before, the denying rule.

    A trace with ``denial_sequence`` has met the denials already (``meet_denials``).
    """
    c = F.col
    # No SKIP breaks the sequence, so the rows that are one stay out of the join.
    rows = trace.filter(c("rule_result") != "SKIP").join(rules.select("rule_id", "rule_sequence"), "rule_id")
    if DENIAL_SEQUENCE not in trace.columns:
        rows = rows.join(_denied(denials, rules), "claim_id")
    return rows.filter(
        ((c("rule_sequence") > c(DENIAL_SEQUENCE)) & (c("rule_result") != "SKIP"))
        | ((c("rule_sequence") < c(DENIAL_SEQUENCE)) & (c("rule_result") == "FAIL"))
    )


def _claim_tests(t: BuiltTables, expected_claims: Column | str) -> DataFrame:
    per_claim = t.denials.groupBy("claim_id").agg(
        F.count("*").alias("denial_rows"),
        count_if(F.col("rule_id") == SOFT_RULE).alias("soft_rows"),
    )
    c = F.col
    rows = F.coalesce("denial_rows", F.lit(0))
    row = (
        t.claims.select(
            "claim_id", "provider_id", "adjudication_status",
            # Compared here, so that the joins do not carry the amounts.
            ((c("adjudication_status") == "PAID")
             & (c("paid_amount") < c("expected_allowed_amount"))).alias("short"),
        )
        .join(per_claim, "claim_id", "full_outer")
        .join(
            t.providers.select("provider_id", F.col("provider_type").alias("kind")),
            "provider_id", "left",
        )
        .agg(
            F.count("adjudication_status").alias("claims"),
            _count(c("adjudication_status") == "PENDING").alias("pending"),
            _count((c("adjudication_status") == "DENIED") & (rows == 0)).alias("no_denial"),
            F.coalesce(
                F.sum(F.when(c("adjudication_status") != "DENIED", rows)), F.lit(0)
            ).alias("not_denied"),
            _count(rows > 1).alias("many"),
            F.coalesce(F.sum("soft_rows"), F.lit(0)).alias("soft"),
            F.countDistinct(F.when(c("short") & (c("kind") != "LTSS"), c("kind"))).alias("short_types"),
        )
    )
    return _grid(materialise(row), [
        (1, "Claim count", expected_claims, c("claims")),
        (2, "Claims still PENDING after adjudication", "0", c("pending")),
        (3, "DENIED claims without a ClaimDenial row", "0", c("no_denial")),
        (4, "ClaimDenial rows on a non-DENIED claim", "0", c("not_denied")),
        (5, "Claims with more than one denial row", "0", c("many")),
        (13, "R-070 pricing failures that denied a claim", "0", c("soft")),
        (14, "Non-LTSS provider types paid below expected", "0", c("short_types")),
    ])


def _trace_tests(t: BuiltTables) -> DataFrame:
    incomplete = (
        t.trace.groupBy("claim_id").count().agg(_count(F.col("count") != 7).alias("n"))
    )
    trace = t.trace if t.denied_trace is None else t.denied_trace
    violations = rule_sequence_violations(trace, t.denials, t.rules).agg(F.count("*").alias("n"))
    n = F.col("n")
    return union_labelled([
        _grid(materialise(incomplete), [(6, "Claims without a full 7-rule trace", "0", n)]),
        _grid(materialise(violations), [(7, "Rule-sequence violations in the trace", "0", n)]),
    ])


def _warehouse_tests(t: BuiltTables) -> DataFrame:
    source = t.claims.agg(
        F.struct(F.count("*").alias("claims"), F.sum("billed_amount").cast(TOTAL).alias("billed"))
    ).scalar()
    fact = t.fact.agg(
        F.coalesce(F.sum("claim_count"), F.lit(0)).alias("claims"),
        F.sum("billed_amount").cast(TOTAL).alias("billed"),
    )
    good = t.log.filter(F.col("load_status").isin(LOADED)).select(
        F.col("partition_date").alias("service_from_date")
    )
    missing = (
        t.claims.select("service_from_date").distinct()
        .join(good, "service_from_date", "left_anti")
        .agg(F.count("*").alias("n"))
    )
    failed = t.log.agg(_count(F.col("load_status") == "FAILED").alias("n"))
    n = F.col("n")
    return union_labelled([
        _grid(fact, [
            (8, "dw claim count reconciles to dbo.Claim", source["claims"], F.col("claims")),
            (9, "dw billed amount reconciles to dbo.Claim", source["billed"], F.col("billed")),
        ]),
        _grid(missing, [(10, "Service dates with no partition log row", "0", n)]),
        _grid(failed, [(11, "Failed partitions", "0", n)]),
    ])


def assertions(
    t: BuiltTables, expected_claims: Column | str, expected_defects: int = 3
) -> DataFrame:
    """Fourteen statements about the pipeline with their result, failures first.

    The counts that need large joins are written one after the other, so that only one join's shuffle files lie on disk.
    """
    wrong = t.config.agg(
        _count(F.col("loaded_value") != F.col("standard_value")).alias("n")
    )
    config_test = _grid(wrong, [
        (12, "Configuration keys where loaded <> standard", str(expected_defects), F.col("n")),
    ])
    grid = union_labelled([
        _claim_tests(t, expected_claims), _trace_tests(t), _warehouse_tests(t), config_test,
    ])
    same = F.col("expected") == F.col("actual")
    return grid.withColumn("result", F.when(same, "PASS").otherwise("FAIL")).orderBy(
        "result", "test_num"
    )


def assertion_summary(grid: DataFrame) -> DataFrame:
    passed = _count(F.col("result") == "PASS")
    return grid.agg(
        F.concat(
            passed.cast("string"), F.lit(" of "), F.count("*").cast("string"),
            F.lit(" tests passed"),
        ).alias("test_summary")
    )


def key_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows breaking a declared key, mandatory column or reference, per table and check."""
    checks = []
    for name, df in tables.items():
        key = PRIMARY_KEYS[name]
        repeated = df.groupBy(*key).count().agg(_count(F.col("count") > 1).alias("violations"))
        checks.append(_check(repeated, name, "unique " + ", ".join(key)))

        required = [c for c in columns(name) if c not in NULLABLE.get(name, ()) and c in df.columns]
        nulls = df.agg(*[_count(F.col(c).isNull()).alias(c) for c in required])
        checks.append(
            nulls.select(
                F.inline(
                    F.array(
                        *[
                            F.struct(
                                F.lit(name).alias("table_name"),
                                F.lit(f"not null {c}").alias("check_name"),
                                F.col(c).alias("violations"),
                            )
                            for c in required
                        ]
                    )
                )
            )
        )
    for child, column, parent, target in FOREIGN_KEYS:
        if child in tables and parent in tables:
            orphans = (
                tables[child].filter(F.col(column).isNotNull()).select(F.col(column).alias("k"))
                .join(tables[parent].select(F.col(target).alias("k")), "k", "left_anti")
                .agg(F.count("*").alias("violations"))
            )
            checks.append(_check(orphans, child, f"{column} references {parent}"))
    return union_labelled(checks)


def _check(row: DataFrame, table: str, check: str) -> DataFrame:
    return row.select(
        F.lit(table).alias("table_name"), F.lit(check).alias("check_name"), "violations"
    )


def row_count_expectations(t: BuiltTables, expected: dict[str, Column | int]) -> DataFrame:
    """Metric, actual and expected count, and OK / CHECK / INFO where nothing is expected.

    ``expected`` gives the counts of Members, Providers and Claims.
    """
    c = F.col
    claims = t.claims.agg(
        F.count("*").alias("Claims"), _count(c("adjudication_status") == "PENDING").alias("Claims PENDING")
    )
    log = t.log.agg(
        _count(c("load_status").isin(LOADED)).alias("Partitions loaded"),
        _count(c("load_status") == "FAILED").alias("Partitions FAILED"),
    )

    def size(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count("*").alias(name))

    wanted = {**expected, "Claims PENDING": 0, "Partitions FAILED": 0}
    frames = [
        size(t.members, "Members"),
        size(t.providers, "Providers"),
        claims,
        size(t.denials, "Denied claims"),
        size(t.trace, "Rule trace rows"),
        size(t.fact, "Warehouse rows"),
        log,
    ]

    def lines(row: DataFrame) -> DataFrame:
        structs = []
        for metric in row.columns:
            target = wanted.get(metric)
            target = (target if isinstance(target, Column) else F.lit(target)).cast("bigint")
            status = (
                F.when(target.isNull(), "INFO")
                .when(c(f"`{metric}`") == target, "OK")
                .otherwise("CHECK")
            )
            structs.append(
                F.struct(
                    F.lit(metric).alias("metric"),
                    c(f"`{metric}`").alias("actual"),
                    target.alias("expected"),
                    status.alias("status"),
                )
            )
        return row.select(F.inline(F.array(*structs)))

    return union_labelled([lines(f) for f in frames])
