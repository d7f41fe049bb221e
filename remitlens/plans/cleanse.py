"""From raw staging text to claims, modifiers and named rejects."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitlens.functions.parsing import (
    clean_id,
    clean_modifiers,
    parse_currency,
    parse_date,
    parse_units,
)
from remitlens.operators.dedupe import mark_latest
from remitlens.operators.ledger import append_rejects, not_in_ledger
from remitlens.operators.merge import merge_claims
from remitlens.operators.modifiers import replace_modifiers
from remitlens.session import materialise


@dataclass
class CleanseResult:
    claims: DataFrame
    rejects: DataFrame
    modifiers: DataFrame


def normalize(staging: DataFrame) -> DataFrame:
    """Typed columns; whatever cannot be read becomes NULL."""
    return staging.select(
        "raw_row_num",
        clean_id(F.col("claim_id")).alias("claim_id"),
        clean_id(F.col("member_id")).alias("member_id"),
        clean_id(F.col("provider_id")).alias("provider_id"),
        clean_id(F.col("lob")).alias("lob"),
        clean_id(F.col("procedure_code")).alias("procedure_code"),
        clean_modifiers(F.col("modifier_list")).alias("modifier_list"),
        parse_units(F.col("units")).alias("units"),
        parse_date(F.col("service_from_raw")).alias("service_from_date"),
        parse_date(F.col("service_thru_raw")).alias("service_thru_date"),
        parse_date(F.col("received_raw")).alias("received_date"),
        parse_currency(F.col("billed_raw")).alias("billed_amount"),
        "source_file_name",
    )


def _first_true(cases: list[tuple[Column, str]]) -> Column:
    (condition, label), *rest = cases
    chain = F.when(condition, F.lit(label))
    for condition, label in rest:
        chain = chain.when(condition, F.lit(label))
    return chain


def reject_reason(as_of: dt.date | str) -> Column:
    """Name of the first check a row fails, NULL for a good row.

    Expects the flags ``is_latest``, ``member_known`` and ``provider_known``.  The order
    and the texts are fixed values.
    """
    today = F.lit(as_of).cast("date")
    c = F.col
    return _first_true([
        (c("claim_id").isNull(), "Missing claim identifier"),
        (~c("is_latest"), "Superseded duplicate within source file"),
        (c("service_from_date").isNull(), "Unparseable service from date"),
        (c("service_thru_date").isNull(), "Unparseable service thru date"),
        (c("received_date").isNull(), "Unparseable received date"),
        (c("billed_amount").isNull(), "Unparseable billed amount"),
        (c("billed_amount") <= 0, "Non-positive billed amount"),
        (c("received_date") < c("service_from_date"), "Received date precedes date of service"),
        (c("service_thru_date") < c("service_from_date"), "Service thru precedes service from"),
        (c("service_from_date") > today, "Service date in the future"),
        (c("member_id").isNull(), "Missing member identifier"),
        (c("provider_id").isNull(), "Missing provider identifier"),
        (c("member_known").isNull(), "Member not found in eligibility"),
        (c("provider_known").isNull(), "Provider not found in network file"),
        (c("units").isNull() | (c("units") < 1), "Invalid unit count"),
    ])


def label_rows(
    normalized: DataFrame, members: DataFrame, providers: DataFrame, as_of: dt.date | str
) -> DataFrame:
    """Decide the fate of every raw row of one file.

    Keys of the masters are read as the raw ones are, and repeated ones count once.  The rows do not meet the masters: their
    distinct keys do, and the keys that no master has, mostly few, are written so that Spark knows their size before it
    decides how the rows meet them.
    """

    def known(rows: DataFrame, master: DataFrame, key: str, flag: str) -> DataFrame:
        held = master.select(clean_id(F.col(key)).alias(key))
        keys = normalized.select(key).filter(F.col(key).isNotNull()).distinct()
        unknown = materialise(keys.join(held, key, "left_anti")).withColumn("_unknown", F.lit(True))
        found = F.when(F.col(key).isNotNull() & F.col("_unknown").isNull(), F.lit(True))
        return rows.join(unknown, key, "left").withColumn(flag, found).drop("_unknown")

    rows = mark_latest(normalized, "claim_id", "raw_row_num")
    rows = known(rows, members, "member_id", "member_known")
    rows = known(rows, providers, "provider_id", "provider_known")
    return rows.withColumn("reject_reason", reject_reason(as_of)).drop("member_known", "provider_known")


def rejected_rows(labelled: DataFrame) -> DataFrame:
    """Ledger rows; the service date is kept so a reject counts for the day it belongs to."""
    return labelled.filter(F.col("reject_reason").isNotNull()).select(
        "source_file_name",
        "raw_row_num",
        "claim_id",
        F.col("service_from_date").alias("service_date"),
        "reject_reason",
        F.current_timestamp().alias("rejected_utc"),
    )


def accepted_rows(labelled: DataFrame, ledger: DataFrame) -> DataFrame:
    """Good rows.  A row once in the ledger stays out, even if it would pass today."""
    good = labelled.filter(F.col("reject_reason").isNull())
    return not_in_ledger(good, ledger).drop("is_latest", "reject_reason")


def cleanse_and_load(
    staging: DataFrame,
    claims: DataFrame,
    members: DataFrame,
    providers: DataFrame,
    rejects: DataFrame,
    modifiers: DataFrame,
    source_file: str,
    as_of: dt.date | str,
) -> CleanseResult:
    """Cleanse one source file against the current snapshots and return the next ones.

    The labelled rows feed all three results, so they are written once in between.  They all
    are of one file, and told so as a literal, Spark reads only that file's rows of the ledger.
    """
    raw = staging.filter(F.col("source_file_name") == source_file)
    labelled = materialise(label_rows(normalize(raw), members, providers, as_of)).withColumn(
        "source_file_name", F.lit(source_file)
    )
    accepted = accepted_rows(labelled, rejects)
    return CleanseResult(
        claims=merge_claims(claims, accepted),
        rejects=append_rejects(rejected_rows(labelled), rejects),
        modifiers=replace_modifiers(modifiers, labelled.filter("is_latest"), accepted),
    )
