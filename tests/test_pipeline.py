"""The stored pipeline end to end in a temporary folder."""

import datetime as dt
import shutil

import pytest
from pyspark.sql import functions as F

from remitlens.plans import analysis, health, pipeline, quality, warehouse
from remitlens.plans.whatif import standardize_config
from remitlens.sources.reference import reference_data
from remitlens.sources.store import ClaimStore, on_dates, read_staging
from tests.helpers import day, frame, members, money, providers, raw, rows

AS_OF = dt.date(2026, 6, 1)
LTSS = {"provider_id": "PL", "provider_type": "LTSS"}
FIRST_FILE = [
    {"raw_row_num": 1, "claim_id": "C1", "modifier_list": "25"},
    {"raw_row_num": 2, "claim_id": "C2", "service_from_raw": "2026-01-11", "service_thru_raw": "2026-01-11",
     "received_raw": "04/20/2026"},
    {"raw_row_num": 3, "claim_id": "C3", "provider_id": "PL", "procedure_code": "T1019", "units": "10",
     "service_from_raw": "20260113", "service_thru_raw": "20260113"},
    {"raw_row_num": 4, "claim_id": "C4", "billed_raw": "abc", "service_from_raw": "2026-01-11"},
]


@pytest.fixture(scope="module")
def built_root(spark, tmp_path_factory):
    """One cleansed and adjudicated store, copied for every test."""
    root = tmp_path_factory.mktemp("store")
    s = ClaimStore(spark, str(root))
    for name, df in reference_data(spark).items():
        s.replace(name, df)
    s.replace("member", members(spark))
    s.replace("provider", providers(spark, {}, LTSS))
    s.replace("prior_auth", frame(spark, "prior_auth", dict(
        auth_id=1, member_id="M1", provider_type="LTSS", auth_eff_date=day("2026-01-01"),
        auth_thru_date=day("2026-01-31"), auth_status="APPROVED")))
    s.append("claim_import", raw(spark, *FIRST_FILE))
    pipeline.run_cleanse(s, "f1", AS_OF)
    pipeline.run_adjudication(s)
    return root


@pytest.fixture
def store(spark, built_root, tmp_path):
    shutil.copytree(built_root, tmp_path, dirs_exist_ok=True)
    return ClaimStore(spark, str(tmp_path))


def fact(store):
    return rows(store.read("fact_claim_denial_daily"), "service_date", "rule_id", "verdict", "claim_count")


def test_cleansed_and_adjudicated_tables(store):
    assert rows(store.read("claim"), "claim_id", "adjudication_status", "paid_amount") == [
        ("C1", "PAID", money("102.30")), ("C2", "DENIED", money("0.00")), ("C3", "PAID", money("208.32"))]
    assert rows(store.read("claim_reject"), "raw_row_num", "service_date") == [(4, day("2026-01-11"))]
    assert rows(store.read("claim_modifier"), "*") == [("C1", 1, "25")]
    assert rows(store.read("claim_denial"), "claim_id", "rule_id", "denial_code") == [
        ("C2", "R-060", "D-TF01")]
    assert store.read("claim_rule_result").count() == 21


def test_backfill_is_incremental_and_repeatable(store):
    assert pipeline.backfill(store, "2026-01-10", "2026-01-13") == pipeline.BackfillCount(4, 0)
    first = fact(store)
    assert first == [
        (day("2026-01-10"), "R-000", "CLEAN", 1),
        (day("2026-01-11"), "R-060", "CONFIGURATION DEFECT", 1),
        (day("2026-01-13"), "R-000", "CONFIGURATION DEFECT", 1)]
    log = ["partition_date", "load_status", "rows_written", "source_rows_read", "rejected_rows"]
    assert [r[1:] for r in rows(store.read("partition_log"), *log)] == [
        ("SUCCESS", 1, 1, 0), ("SUCCESS", 1, 1, 1), ("SUCCESS", 0, 0, 0), ("SUCCESS", 1, 1, 0)]
    # Nothing is left to do.
    assert pipeline.backfill(store, "2026-01-10", "2026-01-13") == pipeline.BackfillCount(0, 0)
    assert pipeline.backfill(store, "2026-01-11", "2026-01-11", reload=True).loaded == 1
    assert fact(store) == first
    assert [s for _, s in rows(store.read("partition_log"), "partition_date", "load_status")] == [
        "SUCCESS", "RELOADED", "SUCCESS", "SUCCESS"]
    with pytest.raises(ValueError):
        pipeline.backfill(store, "2026-01-13", "2026-01-10")


def test_a_corrected_configuration_reaches_the_fact(store):
    pipeline.backfill(store, "2026-01-10", "2026-01-13")
    fixed = standardize_config(store.read("plan_config"))
    from remitlens.session import materialise

    store.replace("plan_config", materialise(fixed))
    pipeline.run_adjudication(store)
    pipeline.backfill(store, "2026-01-10", "2026-01-13", reload=True)
    # 99 days late is late under the contract too.
    assert {v for _, _, v, _ in fact(store)} == {"CLEAN", "CORRECT DENIAL"}


def test_a_resubmission_moves_a_claim_to_another_date(store):
    pipeline.backfill(store, "2026-01-10", "2026-01-13")
    store.append("claim_import", raw(
        store.spark, {"raw_row_num": 1, "claim_id": "C1", "source_file_name": "f2",
                      "service_from_raw": "2026-01-12", "service_thru_raw": "2026-01-12"}))
    pipeline.run_cleanse(store, "f2", AS_OF)
    assert rows(store.read("claim"), "claim_id", "service_from_date", "adjudication_status") == [
        ("C1", day("2026-01-12"), "PENDING"), ("C2", day("2026-01-11"), "DENIED"),
        ("C3", day("2026-01-13"), "PAID")]
    assert rows(store.read("claim_modifier"), "*") == []
    pipeline.backfill(store, "2026-01-10", "2026-01-12", reload=True)
    # The date the claim left is empty now.
    assert fact(store) == [
        (day("2026-01-11"), "R-060", "CONFIGURATION DEFECT", 1),
        (day("2026-01-12"), "R-000", "PENDING ADJUDICATION", 1),
        (day("2026-01-13"), "R-000", "CONFIGURATION DEFECT", 1)]


def test_a_failing_date_is_logged_and_the_others_load(store, monkeypatch):
    real = pipeline.build_fact

    def broken(claims, *args):
        # Raises in the job that holds the bad date.
        bad = F.raise_error(F.lit("bad date"))
        guard = F.when(F.col("service_from_date") == F.lit(day("2026-01-11")), bad).otherwise(F.col("lob"))
        return real(claims.withColumn("lob", guard), *args)

    monkeypatch.setattr(pipeline, "build_fact", broken)
    assert pipeline.backfill(store, "2026-01-10", "2026-01-13") == pipeline.BackfillCount(3, 1)
    log = store.read("partition_log")
    assert [s for _, s in rows(log, "partition_date", "load_status")] == [
        "SUCCESS", "FAILED", "SUCCESS", "SUCCESS"]
    assert "bad date" in log.filter("load_status = 'FAILED'").first().load_message
    monkeypatch.undo()
    # The retry is a first success, not a reload.
    assert pipeline.backfill(store, "2026-01-10", "2026-01-13") == pipeline.BackfillCount(1, 0)
    assert {s for (s,) in rows(store.read("partition_log"), "load_status")} == {"SUCCESS"}


def test_dates_loaded_one_by_one_have_their_own_clock(store):
    assert pipeline.backfill(store, "2026-01-10", "2026-01-11", isolate=True) == pipeline.BackfillCount(2, 0)
    first, second = rows(store.read("partition_log"), "load_start_utc", "load_end_utc")
    assert first[0] < first[1] <= second[0] < second[1]


def test_a_load_reads_only_its_partitions(store):
    claims = on_dates(store.read("claim"), "service_from_date", [day("2026-01-11"), day("2026-01-13")])
    assert sorted({r[0] for r in rows(claims, "service_from_date")}) == [day("2026-01-11"), day("2026-01-13")]
    # The tree text is cut off; the scan's own list of filters is not.
    scan = claims._jdf.queryExecution().sparkPlan().collectLeaves().head()
    pruned = scan.partitionFilters().mkString(" ")
    assert "2026-01-11" in pruned and "2026-01-13" in pruned and "IN (" in pruned
    assert on_dates(store.read("claim"), "service_from_date", []).count() == 0


def test_nightly_catches_up_and_gates(store):
    # One of the two rows that came for the 11th was rejected.
    with pytest.raises(health.PipelineUnhealthy, match="1 partition.*2026-01-11 REJECT RATE"):
        pipeline.nightly(store, dt.date(2026, 1, 14))
    assert store.read("partition_log").count() == 8
    store.update_log(frame(store.spark, "partition_log", dict(
        partition_date=day("2026-01-13"), rows_written=0, source_rows_read=0, rejected_rows=0,
        load_start_utc=dt.datetime(2026, 1, 14), load_end_utc=dt.datetime(2026, 1, 14),
        load_status="FAILED", load_message="x")))
    view = health.pipeline_health(store.read("claim"), store.read("partition_log"))
    with pytest.raises(health.PipelineUnhealthy, match="2026-01-13 LOAD FAILED"):
        health.health_gate(view, dt.date(2026, 1, 14))


def test_assertions_hold_after_a_full_run(store):
    pipeline.backfill(store, "2026-01-10", "2026-01-13")
    built = quality.BuiltTables(
        claims=store.read("claim"), denials=store.read("claim_denial"),
        trace=store.read("claim_rule_result"), fact=store.read("fact_claim_denial_daily"),
        log=store.read("partition_log"), members=store.read("member"), providers=store.read("provider"),
        rules=store.read("adjudication_rule"), config=store.read("plan_config"))
    grid = quality.assertions(built, "3")
    assert [tuple(r) for r in grid.filter("result <> 'PASS'").collect()] == []
    assert quality.assertion_summary(grid).first()[0] == "14 of 14 tests passed"
    counts = {r.metric: r.status for r in quality.row_count_expectations(
        built, {"Members": 1, "Providers": 2, "Claims": 4}).collect()}
    assert counts["Members"] == counts["Providers"] == counts["Claims PENDING"] == "OK"
    assert counts["Claims"] == "CHECK" and counts["Rule trace rows"] == "INFO"

    # A lost denial, an extra one and a tampered trace are found.
    broken = quality.BuiltTables(**{
        **built.__dict__,
        "denials": frame(store.spark, "claim_denial", dict(claim_id="C1", rule_id="R-070"),
                         dict(claim_id="C1", rule_id="R-010")),
        "trace": built.trace.filter("rule_id <> 'R-010'"),
        "fact": built.fact.filter("rule_id = 'R-060'"),
    })
    failed = {r.test_num: r.actual for r in quality.assertions(broken, "3").collect() if r.result == "FAIL"}
    assert failed == {3: "1", 4: "2", 5: "1", 6: "3", 7: failed[7], 8: "1", 9: "200.00", 13: "1"}
    with_rule = warehouse.with_denials(built.claims, built.denials)
    assert analysis.exposure_by_defect(with_rule, built.providers).count() == 3


def test_staging_is_read_as_text(spark, tmp_path):
    path = str(tmp_path / "in")
    raw(spark, {"units": " 7 ", "billed_raw": "$1,240.00 "}, {"source_file_name": "f2"}).write.csv(
        path, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    got = read_staging(spark, path, "f1", "csv")
    assert rows(got, "units", "billed_raw") == [(" 7 ", "$1,240.00 ")]


def test_a_write_that_stops_before_the_switch_leaves_the_old_rows(store, monkeypatch):
    pipeline.backfill(store, "2026-01-10", "2026-01-13")
    before = fact(store)
    dates = store.spark.createDataFrame([(day("2026-01-11"),)], "partition_date date")

    def stopped(table, entries):
        raise RuntimeError("executor lost before the switch")

    monkeypatch.setattr(store, "_switch", stopped)
    changed = store.read("fact_claim_denial_daily").withColumn("claim_count", F.col("claim_count") + 100)
    with pytest.raises(RuntimeError):
        store.replace_dates("fact_claim_denial_daily", changed, dates)
    assert fact(store) == before
    monkeypatch.undo()
    store.replace_dates("fact_claim_denial_daily", changed.filter(F.col("service_date") == day("2026-01-11")), dates)
    after = {r for r in fact(store)}
    assert after != set(before) and all(r[3] > 100 for r in after if r[0] == day("2026-01-11"))


def test_readers_list_only_the_current_version_of_their_dates(store):
    pipeline.backfill(store, "2026-01-10", "2026-01-13")
    pipeline.backfill(store, "2026-01-11", "2026-01-11", reload=True)
    live = store.live("fact_claim_denial_daily")
    assert len(set(live.values())) == 2
    one = store.read_dates("fact_claim_denial_daily", [day("2026-01-11")])
    roots = one._jdf.queryExecution().sparkPlan().collectLeaves().head().relation().location().rootPaths().mkString(" ")
    assert f"version={live[day('2026-01-11')]}/service_date=2026-01-11" in roots and roots.count("version=") == 1


def test_vacuum_removes_only_unread_versions(store):
    pipeline.backfill(store, "2026-01-11", "2026-01-11")
    pipeline.backfill(store, "2026-01-11", "2026-01-11", reload=True)
    whole, live = fact(store), set(store.live("fact_claim_denial_daily").values())
    gone = store.vacuum("fact_claim_denial_daily")
    assert gone and not (set(gone) & live) and fact(store) == whole
