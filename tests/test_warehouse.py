import datetime as dt

import pytest

from remitlens.operators.merge import merge_partition_log
from remitlens.plans import analysis, health, quality, report, warehouse
from remitlens.sources.reference import reference_data
from tests.helpers import claims, day, frame, money, providers, rows


@pytest.fixture(scope="module")
def ref(spark):
    return reference_data(spark)


PAID = {"adjudication_status": "PAID", "paid_amount": money("102.30")}
DENIED = {"adjudication_status": "DENIED", "paid_amount": money("0.00")}


def verdict(spark, ref, claim, rule=None):
    stored = claims(spark, claim)
    denials = frame(spark, "claim_denial", *([dict(claim_id="C1", rule_id=rule)] if rule else []))
    priced = warehouse.price(
        warehouse.with_denials(stored, denials), providers(spark), ref["fee_schedule"],
        ref["plan_config"])
    got = warehouse.classify(priced, ref["adjudication_rule"], ref["plan_config"])
    return rows(got, "rule_id", "verdict")


@pytest.mark.parametrize("claim, rule, want", [
    (PAID, None, ("R-000", "CLEAN")),
    ({**PAID, "paid_amount": money("102.29")}, None, ("R-000", "CONFIGURATION DEFECT")),
    ({**PAID, "paid_amount": None}, None, ("R-000", "CONFIGURATION DEFECT")),
    ({**PAID, "procedure_code": "NOPE"}, None, ("R-000", "UNPRICED")),
    ({}, None, ("R-000", "PENDING ADJUDICATION")),
    # A stale denial stays visible on a claim that is pending again.
    ({}, "R-060", ("R-060", "PENDING ADJUDICATION")),
    (DENIED, "R-010", ("R-010", "CORRECT DENIAL")),
    (DENIED, "R-060", ("R-060", "CONFIGURATION DEFECT")),
    (DENIED, "R-050", ("R-050", "CONFIGURATION DEFECT")),
    ({**DENIED, "procedure_code": "NOPE"}, "R-010", ("R-010", "CORRECT DENIAL")),
])
def test_verdicts(spark, ref, claim, rule, want):
    assert verdict(spark, ref, claim, rule) == [want]


@pytest.fixture(scope="module")
def fact(spark, ref):
    stored = claims(
        spark,
        {"claim_id": "A", **PAID}, {"claim_id": "B", **PAID, "paid_amount": money("2.30")},
        {"claim_id": "C", **DENIED}, {"claim_id": "D", **DENIED},
        {"claim_id": "E", "service_from_date": day("2026-02-01")},
    )
    denials = frame(spark, "claim_denial", dict(claim_id="C", rule_id="R-060"),
                    dict(claim_id="D", rule_id="R-010"))
    return warehouse.build_fact(
        warehouse.with_denials(stored, denials), providers(spark), ref["fee_schedule"],
        ref["adjudication_rule"], ref["plan_config"])


def test_fact_rows(fact):
    got = rows(fact, "rule_id", "verdict", "claim_count", "denied_count", "amount_at_risk")
    assert got == [
        ("R-000", "CLEAN", 1, 0, money("0.00")),
        ("R-000", "CONFIGURATION DEFECT", 1, 0, money("100.00")),
        ("R-000", "PENDING ADJUDICATION", 1, 0, money("102.30")),
        ("R-010", "CORRECT DENIAL", 1, 1, money("102.30")),
        ("R-060", "CONFIGURATION DEFECT", 1, 1, money("102.30")),
    ]


def test_mixes_and_measures(fact, ref):
    mix = rows(analysis.denial_mix_by_rule(fact, ref["adjudication_rule"]), "rule_id", "rule_name",
               "claims", "correct_denials", "defect_driven", "exposure_usd")
    assert mix == [
        ("R-000", "No denial — claim paid", 3, 0, 1, money("100.00")),
        ("R-010", "Member eligibility on date of service", 1, 1, 0, money("0.00")),
        ("R-060", "Timely filing", 1, 0, 1, money("102.30")),
    ]
    segment = rows(analysis.denial_mix_by_segment(fact), "claims", "denied", "denial_rate_pct",
                   "exposure_usd")
    assert segment == [(5, 2, money("40.00"), money("202.30"))]
    verdicts = {v: p for v, p in rows(analysis.verdict_distribution(fact), "verdict", "pct_of_claims")}
    assert verdicts["CONFIGURATION DEFECT"] == money("40.00") and sum(verdicts.values()) == 100
    kpi = report.kpi_measures(fact).first()
    assert (kpi.total_claims, kpi.denied_claims, kpi.exposure) == (5, 2, money("202.30"))
    assert (kpi.correct_denials, kpi.defect_driven_denials) == (1, 1)
    assert (kpi.denial_rate, kpi.pct_denials_from_defects) == (money("0.400000"), money("0.500000"))


def test_slicers_and_empty_measures(fact):
    only = report.kpi_measures(fact, month="2026-02").first()
    assert (only.total_claims, only.denied_claims, only.pct_denials_from_defects) == (1, 0, None)
    assert report.kpi_measures(fact, lob="NONE").first().total_claims is None
    assert rows(report.exposure_by_month(fact, provider_type="Physician"), "month_name", "exposure") == [
        ("Feb 2026", money("0.00")), ("Jan 2026", money("202.30"))]


def test_dim_date_weeks_start_on_monday(fact):
    dates = report.dim_date(fact)
    assert dates.count() == 23
    first = dates.orderBy("date").first()
    assert first.asDict() == dict(date=day("2026-01-10"), year=2026, month_num=1, month_name="Jan 2026",
                                  quarter_name="Q1 2026", week_start=day("2026-01-05"))


def test_reload_clears_a_date_that_came_back_empty(fact, spark):
    dates = spark.createDataFrame([(day("2026-02-01"),)], "partition_date date")
    after = warehouse.replace_fact_dates(fact, fact.filter("false"), dates)
    assert rows(after.select("service_date").distinct(), "service_date") == [(day("2026-01-10"),)]
    assert rows(warehouse.stale_dates(dates, fact.filter("false")), "*") == [(day("2026-02-01"),)]


T0 = dt.datetime(2026, 1, 1)


def log_row(date, status, written=10, **more):
    return dict(partition_date=day(date), rows_written=written, source_rows_read=30, rejected_rows=0,
                load_start_utc=T0, load_end_utc=T0 + dt.timedelta(seconds=5), load_status=status, **more)


def test_log_state_machine(spark):
    log = frame(spark, "partition_log", log_row("2026-01-01", "SUCCESS"), log_row("2026-01-02", "FAILED", 7),
                log_row("2026-01-03", "RELOADED"), log_row("2026-01-04", "SUCCESS", 8))
    results = frame(
        spark, "partition_log", log_row("2026-01-01", "SUCCESS", 1), log_row("2026-01-02", "SUCCESS", 2),
        log_row("2026-01-03", "FAILED", 0, load_message="broken"), log_row("2026-01-05", "FAILED", 0),
        log_row("2026-01-06", "SUCCESS", 6))
    got = rows(merge_partition_log(log, results), "partition_date", "load_status", "rows_written",
               "load_message")
    assert [r[1:] for r in got] == [
        ("RELOADED", 1, None),       # a good load over a good load
        ("SUCCESS", 2, None),        # first success after a failure
        ("FAILED", 10, "broken"),    # counts of the earlier load are kept
        ("SUCCESS", 8, None),        # not touched
        ("FAILED", 0, None),
        ("SUCCESS", 6, None),
    ]


def test_pending_dates(spark):
    log = frame(spark, "partition_log", log_row("2026-01-01", "SUCCESS"), log_row("2026-01-02", "FAILED"),
                log_row("2026-01-03", "RELOADED"))
    todo = warehouse.backfill_dates(log, "2026-01-01", "2026-01-04")
    assert [str(d) for (d,) in rows(todo, "*")] == ["2026-01-02", "2026-01-04"]
    assert warehouse.backfill_dates(log, "2026-01-01", "2026-01-04", reload=True).count() == 4
    nightly = warehouse.catch_up_dates(log, dt.date(2026, 1, 9))
    assert [d.day for (d,) in rows(nightly, "*")] == [2, 4, 5, 6, 7, 8]


def test_health_flags(spark):
    """Ten quiet days, then one fault per day with quiet days between."""
    days = {d: log_row(str(dt.date(2026, 1, 1) + dt.timedelta(days=d)), "SUCCESS", 100) for d in range(40)}
    days[10]["load_status"] = "FAILED"
    days[15]["rows_written"] = 0
    days[20]["rows_written"] = 20
    days[25]["rows_written"] = 500
    days[33]["rejected_rows"] = 1
    del days[36]
    log = frame(spark, "partition_log", *days.values())
    source = claims(spark, {"service_from_date": day("2026-01-01")},
                    {"service_from_date": day("2026-02-09")})
    flags = {d.toordinal() - dt.date(2026, 1, 1).toordinal(): f
             for d, f in rows(health.pipeline_health(source, log), "partition_date", "health_flag")}
    assert len(flags) == 40
    assert {d: f for d, f in flags.items() if f != "OK"} == {
        10: "LOAD FAILED", 15: "EMPTY PARTITION", 20: "VOLUME DROP OVER 50 PCT",
        25: "VOLUME SPIKE OVER 100 PCT", 33: "REJECT RATE OVER THRESHOLD", 36: "MISSING PARTITION"}
    view = health.pipeline_health(source, log)
    with pytest.raises(health.PipelineUnhealthy, match=r"3 partition.*2026-01-21 VOLUME DROP.*; 2026-01-26.*; 2026-02-03"):
        health.health_gate(view, dt.date(2026, 1, 27))
    # Missing and empty days do not stop the run.
    health.health_gate(view, dt.date(2026, 2, 20))
    assert report.unhealthy_count(view).first()[0] == 6
    assert health.unhealthy_partitions(view).count() == 6


def exposure_claims(spark):
    rows_ = [
        # participating and within 95 days, participating and too late, not participating
        dict(claim_id="A", received_date=day("2026-04-12"), provider_id="P1", **DENIED, rule="R-060"),
        dict(claim_id="B", received_date=day("2026-09-01"), provider_id="P1", **DENIED, rule="R-060"),
        dict(claim_id="C", received_date=day("2026-04-12"), provider_id="PN", **DENIED, rule="R-060"),
        dict(claim_id="D", provider_id="PL", units=3, **PAID, rule=None),
        dict(claim_id="E", provider_id="PT", **DENIED, rule="R-050"),
        dict(claim_id="F", provider_id="PL", **DENIED, rule="R-050"),
    ]
    rules = {r["claim_id"]: r.pop("rule") for r in rows_}
    df = claims(spark, *[{"expected_allowed_amount": money("150.00"), **r} for r in rows_])
    denials = frame(spark, "claim_denial", *[dict(claim_id=c, rule_id=r) for c, r in rules.items() if r])
    return warehouse.with_denials(df, denials)


def exposure_providers(spark):
    return providers(
        spark, {}, {"provider_id": "PN", "participating_flag": False, "parent_provider_id": "P1"},
        {"provider_id": "PL", "provider_type": "LTSS", "parent_provider_id": "PN"},
        {"provider_id": "PT", "provider_type": "Transportation"},
    )


def test_exposures(spark, ref):
    df, net = exposure_claims(spark), exposure_providers(spark)
    assert rows(analysis.exposure_timely_filing(df, net), "recoverable_claims", "exposure_usd",
                "min_filing_lag", "max_filing_lag") == [(1, money("150.00"), 92, 92)]
    assert rows(analysis.exposure_underpayment(df, net), "underpaid_claims", "total_units",
                "exposure_usd") == [(1, 3, money("47.70"))]
    assert rows(analysis.exposure_auth_exempt(df, net, ref["benefit_category"]), "recoverable_claims",
                "exposure_usd", "delegated_to") == [(1, money("150.00"), "MTM")]
    grid = analysis.exposure_by_defect(df, net).collect()
    assert sorted((r.claims, r.exposure_usd, r.pct_of_total) for r in grid) == [
        (1, money("47.70"), money("13.72")), (1, money("150.00"), money("43.14")),
        (1, money("150.00"), money("43.14"))]


def test_no_exposure_still_shows_three_lines(spark):
    grid = analysis.exposure_by_defect(exposure_claims(spark).filter("false"), exposure_providers(spark))
    assert [(r.claims, r.exposure_usd, r.pct_of_total) for r in grid.collect()] == [(0, None, None)] * 3


def test_provider_reports(spark):
    df, net = exposure_claims(spark), exposure_providers(spark)
    ranked = rows(analysis.provider_exposure_ranked(df, net), "provider_type", "rank_in_type",
                  "provider_id", "status", "denied_claims", "pct_of_type_exposure")
    assert ranked == [
        ("LTSS", 1, "PL", "PAR", 1, money("100.00")),
        ("Physician", 1, "P1", "PAR", 2, money("66.67")),
        ("Physician", 2, "PN", "NON-PAR", 1, money("33.33")),
        ("Transportation", 1, "PT", "PAR", 1, money("100.00")),
    ]
    tree = rows(analysis.provider_rollup(df, net), "root_provider_id", "hierarchy_depth",
                "billing_entities", "denied_claims", "rolled_up_exposure")
    assert tree == [("P1", 2, 3, 4, money("600.00")), ("PT", 0, 1, 1, money("150.00"))]


def test_config_reports(spark, ref):
    register = analysis.config_register(ref["plan_config"], ref["adjudication_rule"]).collect()
    assert len(register) == 12
    assert [(r.config_key, r.rule_id) for r in register if r.config_status == "DEFECT"] == [
        ("AuthExempt_Transportation", "R-050"), ("FeeSchedulePct_LTSS", "R-070"),
        ("TimelyFilingDaysPar", "R-060")]
    assert report.config_status(ref["plan_config"]).filter("config_status = 'DEFECT'").count() == 3
    assert report.rule_dimension(ref["adjudication_rule"]).count() == 8


def test_key_violations(spark):
    bad = quality.key_violations({
        "claim": claims(spark, {}, {}, {"claim_id": "C2", "lob": None, "member_id": "M9"}),
        "member": frame(spark, "member", dict(member_id="M1", lob="X", coverage_eff_date=day("2026-01-01"),
                                              county_code="1")),
    }).filter("violations > 0")
    assert rows(bad, "check_name", "violations") == [
        ("member_id references member", 1), ("not null lob", 1), ("unique claim_id", 1)]
