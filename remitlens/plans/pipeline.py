"""The stored pipeline: cleanse a file, adjudicate, load dates, check health."""

from __future__ import annotations

import datetime as dt
import logging
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitlens.operators.ledger import not_in_ledger
from remitlens.operators.modifiers import replace_modifiers
from remitlens.plans import adjudicate as adj
from remitlens.plans.cleanse import accepted_rows, label_rows, normalize, rejected_rows
from remitlens.plans.health import health_gate, pipeline_health
from remitlens.plans.warehouse import (
    backfill_dates,
    build_fact,
    failed_result,
    load_results,
    with_denials,
)
from remitlens.session import materialise
from remitlens.sources.store import ClaimStore, dates_of, on_dates

LOG = logging.getLogger(__name__)


@dataclass
class BackfillCount:
    loaded: int
    failed: int


def run_cleanse(store: ClaimStore, source_file: str, as_of: dt.date) -> None:
    """Cleanse the staged rows of one file into claims, rejects and modifiers."""
    staged = store.read("claim_import").filter(F.col("source_file_name") == source_file)
    ledger = store.read("claim_reject")
    labelled = materialise(
        label_rows(normalize(staged), store.read("member"), store.read("provider"), as_of)
    )
    accepted = materialise(accepted_rows(labelled, ledger))
    modifiers = materialise(
        replace_modifiers(store.read("claim_modifier"), labelled.filter("is_latest"), accepted)
    )
    store.append("claim_reject", not_in_ledger(rejected_rows(labelled), ledger))
    store.upsert_claims(accepted)
    store.replace("claim_modifier", modifiers)


def run_adjudication(store: ClaimStore) -> None:
    """Adjudicate every stored claim under the stored configuration."""
    claims = store.read("claim")
    result = materialise(
        adj.adjudicate_claims(
            claims, store.read("member"), store.read("provider"), store.read("benefit_category"),
            store.read("prior_auth"), store.read("fee_schedule"), store.read("plan_config"),
        )
    )
    outcome = result.filter("is_evaluated")
    store.replace("claim_denial", adj.denials(outcome))
    store.replace("claim_rule_result", adj.rule_trace(outcome, store.read("adjudication_rule")))
    store.replace("claim", result)


def _load(store: ClaimStore, dates: DataFrame) -> None:
    """Load ``dates`` (partition_date, one row per date) and log them.

    The dates become literals, so that only their partitions are read; a semi-join
    with another stored table would read them all.  The log row is made after the fact
    is written, and so its load time holds the write.
    """
    started = dt.datetime.now(dt.timezone.utc)
    days = dates_of(dates)
    claims = with_denials(store.read_dates("claim", days), store.read("claim_denial"))
    fact = materialise(
        build_fact(
            claims, store.read("provider"), store.read("fee_schedule"),
            store.read("adjudication_rule"), store.read("plan_config"),
        )
    )
    store.replace_dates("fact_claim_denial_daily", fact, dates)
    rejects = on_dates(store.read("claim_reject"), "service_date", days)
    store.update_log(materialise(load_results(dates, fact, claims, rejects, started)))


def _load_one_by_one(store: ClaimStore, dates: DataFrame) -> BackfillCount:
    """One job per date: a failing date is logged and the others still load."""
    count = BackfillCount(0, 0)
    for day in dates_of(dates):
        one = store.spark.range(1).select(F.lit(day).alias("partition_date"))
        started = dt.datetime.now(dt.timezone.utc)
        try:
            _load(store, one)
            count.loaded += 1
        except AnalysisException:  # a missing table or column is no date's fault
            raise
        except Exception as error:  # every failure belongs in the log
            LOG.exception("load of %s failed", day)
            store.update_log(failed_result(one, started, str(error)))
            count.failed += 1
    return count


def backfill(
    store: ClaimStore,
    start: dt.date | str,
    end: dt.date | str,
    reload: bool = False,
    isolate: bool = False,
) -> BackfillCount:
    """Load every date of the range that has no good load yet, or all of them for a reload.

    All dates go through one job.  When that job fails, or with ``isolate``, each date gets
    its own, so that one bad date does not keep the others out.
    """
    dates = materialise(backfill_dates(store.read("partition_log"), start, end, reload))
    if not isolate:
        try:
            _load(store, dates)
            return BackfillCount(dates.count(), 0)
        except AnalysisException:
            raise
        except Exception:  # narrowed down to the failing dates below
            LOG.exception("load of %s to %s failed; loading date by date", start, end)
    return _load_one_by_one(store, dates)


def nightly(store: ClaimStore, as_of: dt.date, lookback: int = 7) -> BackfillCount:
    """Catch up to yesterday, then fail if a recent date is unhealthy."""
    yesterday = as_of - dt.timedelta(days=1)
    count = backfill(store, yesterday - dt.timedelta(days=lookback), yesterday)
    health_gate(pipeline_health(store.read("claim"), store.read("partition_log")), as_of)
    return count
