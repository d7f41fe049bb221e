import datetime as dt

import pytest
from pyspark.sql import functions as F

from remitlens.operators.dedupe import dedupe_latest
from remitlens.operators.merge import merge_claims
from remitlens.operators.modifiers import explode_modifiers
from remitlens.plans.cleanse import cleanse_and_load, label_rows, normalize
from tests.helpers import claims, day, frame, members, money, providers, raw, rows

AS_OF = dt.date(2026, 6, 1)


def reasons(spark, *changes):
    df = label_rows(normalize(raw(spark, *changes)), members(spark), providers(spark), AS_OF)
    return [r[1] for r in rows(df, "raw_row_num", "reject_reason")]


@pytest.mark.parametrize("change, reason", [
    ({}, None),
    ({"claim_id": None}, "Missing claim identifier"),
    ({"service_from_raw": "x"}, "Unparseable service from date"),
    ({"service_thru_raw": ""}, "Unparseable service thru date"),
    ({"received_raw": "n/a"}, "Unparseable received date"),
    ({"billed_raw": "abc"}, "Unparseable billed amount"),
    ({"billed_raw": "(85.00)"}, "Non-positive billed amount"),
    ({"billed_raw": "0"}, "Non-positive billed amount"),
    ({"received_raw": "2026-01-09"}, "Received date precedes date of service"),
    ({"service_thru_raw": "2026-01-09"}, "Service thru precedes service from"),
    ({"service_from_raw": "2026-06-02", "service_thru_raw": "2026-06-02",
      "received_raw": "2026-06-03"}, "Service date in the future"),
    ({"member_id": None}, "Missing member identifier"),
    ({"provider_id": None}, "Missing provider identifier"),
    ({"member_id": "M9"}, "Member not found in eligibility"),
    # A blank id is an id, it is just not known.
    ({"member_id": " "}, "Member not found in eligibility"),
    ({"provider_id": "P9"}, "Provider not found in network file"),
    ({"units": "0"}, "Invalid unit count"),
    ({"units": "x"}, "Invalid unit count"),
    # The first failing check names the row.
    ({"service_from_raw": "x", "billed_raw": "abc"}, "Unparseable service from date"),
    ({"member_id": None, "billed_raw": "-1"}, "Non-positive billed amount"),
])
def test_every_reject_reason(spark, change, reason):
    assert reasons(spark, change) == [reason]


def test_only_the_last_row_of_a_claim_survives(spark):
    superseded = "Superseded duplicate within source file"
    got = reasons(spark, {"raw_row_num": 1}, {"raw_row_num": 2, "claim_id": "C1"},
                  {"raw_row_num": 3, "claim_id": "C2"}, {"raw_row_num": 4, "claim_id": " c1"})
    assert got == [superseded, superseded, None, None]


def test_a_bad_last_row_does_not_revive_an_older_one(spark):
    got = reasons(spark, {"raw_row_num": 1}, {"raw_row_num": 2, "billed_raw": "abc"})
    assert got == ["Superseded duplicate within source file", "Unparseable billed amount"]


def test_dedupe_of_one_hot_key_matches_brute_force(spark):
    """A third of the rows share one id, among them the last one."""
    data = [(("HOT" if i % 3 == 0 else f"K{i % 50}"), i) for i in range(1, 3001)]
    df = spark.createDataFrame(data, "claim_id string, raw_row_num bigint")
    want = {}
    for key, position in data:
        want[key] = max(position, want.get(key, 0))
    got = dict(rows(dedupe_latest(df, "claim_id", "raw_row_num"), "claim_id", "raw_row_num"))
    assert got == want


def test_merge_inserts_updates_and_leaves_alone(spark):
    current = claims(
        spark,
        {"claim_id": "SAME", "adjudication_status": "PAID", "paid_amount": money("10.00"),
         "modifier_list": "25"},
        {"claim_id": "CHANGED", "adjudication_status": "PAID", "paid_amount": money("10.00"),
         "expected_allowed_amount": money("10.00"), "adjudicated_date": day("2026-02-01")},
        {"claim_id": "ABSENT", "adjudication_status": "DENIED"},
    )
    incoming = claims(
        spark,
        # A new modifier list, line of business or member is not a price change.
        {"claim_id": "SAME", "modifier_list": "59", "lob": "CHIP"},
        {"claim_id": "CHANGED", "units": 2, "lob": "CHIP", "modifier_list": "59"},
        {"claim_id": "NEW"},
    )
    got = rows(merge_claims(current, incoming), "claim_id", "adjudication_status", "lob", "units",
               "modifier_list", "paid_amount", "expected_allowed_amount", "adjudicated_date")
    assert got == [
        ("ABSENT", "DENIED", "STAR", 1, None, None, None, None),
        ("CHANGED", "PENDING", "STAR", 2, "59", None, None, None),
        ("NEW", "PENDING", "STAR", 1, None, None, None, None),
        ("SAME", "PAID", "STAR", 1, "25", money("10.00"), None, None),
    ]


def test_modifiers_keep_their_place_in_the_list(spark):
    df = claims(spark, {"claim_id": "A", "modifier_list": "GT||X|59"},
                {"claim_id": "B", "modifier_list": None}, {"claim_id": "C", "modifier_list": "25"})
    assert rows(explode_modifiers(df), "claim_id", "modifier_seq", "modifier_code") == [
        ("A", 1, "GT"), ("A", 4, "59"), ("C", 1, "25")]


def load(spark, staging, state, file="f1"):
    return cleanse_and_load(staging, state.claims, members(spark), providers(spark),
                            state.rejects, state.modifiers, file, AS_OF)


@pytest.fixture
def nothing(spark):
    from remitlens.plans.cleanse import CleanseResult

    return CleanseResult(frame(spark, "claim"), frame(spark, "claim_reject"),
                         frame(spark, "claim_modifier"))


def test_loading_a_file_twice_changes_nothing(spark, nothing):
    staging = raw(spark, {"raw_row_num": 1, "modifier_list": "25|59"},
                  {"raw_row_num": 2, "claim_id": "C2", "billed_raw": "abc"},
                  {"raw_row_num": 3, "claim_id": "C3", "source_file_name": "other"})
    once = load(spark, staging, nothing)
    twice = load(spark, staging, once)
    assert rows(twice.claims, "*") == rows(once.claims, "*") and once.claims.count() == 1
    assert rows(twice.rejects, "raw_row_num", "reject_reason") == [(2, "Unparseable billed amount")]
    assert rows(twice.modifiers, "*") == [("C1", 1, "25"), ("C1", 2, "59")]


def test_a_rejected_row_stays_out_after_its_cause_is_gone(spark, nothing):
    staging = raw(spark, {"member_id": "M9"})
    first = load(spark, staging, nothing)
    known = members(spark, {"member_id": "M9"})
    again = cleanse_and_load(staging, first.claims, known, providers(spark), first.rejects,
                             first.modifiers, "f1", AS_OF)
    assert again.claims.count() == 0 and again.rejects.count() == 1


def test_a_rejected_resubmission_drops_the_modifiers(spark, nothing):
    first = load(spark, raw(spark, {"modifier_list": "25"}), nothing)
    assert first.modifiers.count() == 1
    second = load(spark, raw(spark, {"raw_row_num": 9, "billed_raw": "abc", "source_file_name": "f2"}),
                  first, "f2")
    assert second.claims.count() == 1 and second.modifiers.count() == 0


def test_master_keys_are_read_like_raw_ones_and_count_once(spark):
    known = members(spark).unionByName(members(spark).withColumn("member_id", F.lit(" m1 ")))
    lower = providers(spark).withColumn("provider_id", F.lower("provider_id"))
    df = label_rows(normalize(raw(spark, {})), known, lower, AS_OF)
    assert [r[0] for r in rows(df, "reject_reason")] == [None]


def test_rows_do_not_meet_the_masters(spark):
    """Masters above the broadcast limit: only the unknown keys, measured and few, go to the rows."""
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    master = members(spark).select("member_id").unionByName(spark.range(5000).select(F.concat(F.lit("X"), "id").alias("member_id")))
    rows_in = normalize(raw(spark, {}, {"raw_row_num": 2, "claim_id": "C2", "member_id": "M9"}, {"raw_row_num": 3, "claim_id": "C3", "member_id": None}))
    spark.conf.set(limit, "20000")
    try:
        labelled = label_rows(rows_in, master, providers(spark), AS_OF)
        plan = labelled._jdf.queryExecution().executedPlan().toString()
        joins = [line for line in plan.splitlines() if "Join " in line and "member_id" in line]
        assert joins and all("BroadcastHashJoin" in line for line in joins), plan
        got = rows(labelled, "raw_row_num", "reject_reason")
    finally:
        spark.conf.set(limit, before)
    assert got == [(1, None), (2, "Member not found in eligibility"), (3, "Missing member identifier")]
