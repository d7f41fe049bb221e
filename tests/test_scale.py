"""What a step reads, shuffles or runs twice: seen in its plan or counted, on a few rows."""

import time

import pytest
from pyspark.sql import functions as F

from remitlens.plans import adjudicate as adj
from remitlens.plans import quality
from samplemap import queries
from remitlens.operators.merge import merge_claims
from remitlens.plans.cleanse import cleanse_and_load
from remitlens.schemas import SCHEMAS
from remitlens.session import FREE_SHUFFLES, METHOD_LIMIT, SETTINGS, materialise, no_rows
from remitlens.sources.store import ClaimStore
from samplemap.queries import Run
from tests.helpers import claims, day, members, providers, raw, rows


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_an_empty_table_costs_its_joins_nothing(spark):
    incoming = materialise(claims(spark, {"claim_id": "C1"}, {"claim_id": None}, {"claim_id": "C1"}))
    merged = merge_claims(no_rows(spark, SCHEMAS["claim"]), incoming)
    assert "Join" not in plan(merged)
    assert rows(merged, "claim_id", "adjudication_status") == rows(
        merge_claims(spark.createDataFrame([], SCHEMAS["claim"]), incoming), "claim_id", "adjudication_status"
    )
    for table, schema in SCHEMAS.items():
        assert no_rows(spark, schema).dtypes == spark.createDataFrame([], schema).dtypes, table


def test_a_file_meets_only_its_own_rows_of_the_ledger(spark):
    staged = materialise(raw(
        spark, {"raw_row_num": 1, "units": "x"}, {"raw_row_num": 2, "claim_id": "C2"},
        {"raw_row_num": 1, "claim_id": "C3", "source_file_name": "f2"},
        {"raw_row_num": 2, "claim_id": "C4", "units": "x", "source_file_name": "f2"},
    ))
    state = [no_rows(spark, SCHEMAS[t]) for t in ("claim", "claim_reject", "claim_modifier")]
    for file in ("f1", "f2"):
        result = cleanse_and_load(
            staged, state[0], members(spark), providers(spark), state[1], state[2], file, day("2026-06-01")
        )
        state = [result.claims, result.rejects, result.modifiers]
    assert "LeftAnti" not in plan(result.claims)
    assert rows(result.claims, "claim_id") == [("C2",), ("C3",)]
    assert rows(result.rejects, "source_file_name", "raw_row_num") == [("f1", 1), ("f2", 2)]
    # The same file again: its rejects stay in the ledger once.
    again = cleanse_and_load(
        staged, state[0], members(spark), providers(spark), state[1], state[2], "f2", day("2026-06-01")
    )
    assert rows(again.rejects, "source_file_name", "raw_row_num") == [("f1", 1), ("f2", 2)]


def test_a_date_split_write_runs_its_rows_once(spark, tmp_path):
    ran = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            ran.add(batch.num_rows)
            yield batch

    few = claims(spark, {"claim_id": "C1"}, {"claim_id": "C2"}, {"claim_id": "C3", "service_from_date": day("2026-01-11")})
    store = ClaimStore(spark, str(tmp_path))
    store.replace("claim", few.mapInArrow(counted, few.schema))
    assert ran.value == 3
    assert {r["day"]: r["rows"] for r in store._manifest("claim").collect()} == {day("2026-01-10"): 2, day("2026-01-11"): 1}


@pytest.fixture(scope="module")
def sample(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sample"))
    tables = {
        "customer": "select 1L c_custkey, 'AUTO' c_mktsegment, 1 c_nationkey union all select 2L, null, 2",
        "supplier": "select id s_suppkey, concat('S', id) s_name from range(8)",
        "orders": "select id o_orderkey, id % 4 o_custkey, date '1996-01-01' o_orderdate from range(9)",
        "lineitem": """select id % 10 l_orderkey, cast(1 + id % 3 as int) l_linenumber, id l_partkey, id % 8 l_suppkey,
                              10.5D * id l_extendedprice from range(40)""",
    }
    for name, sql in tables.items():
        spark.sql(sql).write.parquet(f"{path}/{name}.parquet")
    return path


def test_an_adjudication_derives_its_claims_once(spark, sample):
    adjudicated = plan(Run(spark, sample).adjudicated)
    # The authorizations are the only other thing made from the lines.
    assert "l_linenumber" in adjudicated and "max(l_extendedprice" not in adjudicated


def test_lines_meet_their_customers_through_the_orders(spark, sample):
    lines = Run(spark, sample).claims
    text = plan(lines)
    # The join with the customers stands below the one with the lines.
    joins = [line for line in text.splitlines() if "Join " in line]
    assert "l_orderkey" in joins[0] and "o_custkey" in joins[-1]
    # Orders 1, 2, 5 and 6 have a customer; the third key of a line repeats.
    assert {r[0] for r in lines.select("member_id").distinct().collect()} == {"M60000001", "M60000002"}


def test_written_stages_use_the_method_limit_and_give_it_back(spark):
    spark.conf.set(METHOD_LIMIT, "65535")
    try:
        materialise(spark.range(1))
        assert spark.conf.get(METHOD_LIMIT) == "65535"
        with pytest.raises(Exception):
            materialise(spark.range(1).select(F.raise_error(F.lit("stop")).alias("x")))
        assert spark.conf.get(METHOD_LIMIT) == "65535"
    finally:
        spark.conf.set(METHOD_LIMIT, SETTINGS[METHOD_LIMIT])


def test_repeated_submissions_are_marked_before_the_joins(spark, sample):
    r = Run(spark, sample)
    text = plan(adj.gather_facts(*r.engine_inputs[:6]))
    joins = [line for line in text.splitlines() if "Join LeftOuter" in line]
    repeated = [k for k, line in enumerate(joins) if "procedure_code" in line and "provider_id" in line]
    member = [k for k, line in enumerate(joins) if "member_id" in line and "provider" not in line and "block" not in line]
    assert repeated and member and min(repeated) > max(member), joins


def test_skipped_rules_stay_out_of_the_sequence_check(spark):
    trace = spark.createDataFrame([("C1", "R-010", "FAIL"), ("C1", "R-020", "SKIP"), ("C1", "R-030", "PASS"), ("C2", "R-010", "PASS")], "claim_id string, rule_id string, rule_result string")
    denials = spark.createDataFrame([("C1", "R-010")], "claim_id string, rule_id string")
    rules = spark.createDataFrame([("R-010", 10), ("R-020", 20), ("R-030", 30)], "rule_id string, rule_sequence int")
    found = quality.rule_sequence_violations(trace, denials, rules)
    assert [(r.claim_id, r.rule_id) for r in found.collect()] == [("C1", "R-030")]
    filters = [line for line in found._jdf.queryExecution().analyzed().toString().splitlines() if "SKIP" in line]
    assert len(filters) == 2 and "= SKIP" in filters[-1] and "FAIL" not in filters[-1]


def test_denied_without_denial_writes_the_decisions_alone(spark, sample, monkeypatch):
    written = []

    def noted(df):
        written.append(df.columns)
        return materialise(df)

    monkeypatch.setattr(queries, "materialise", noted)
    queries.QUERIES["denied_without_denial"](spark, sample)
    assert len(written) == 2 and "billed_amount" not in written[-1] and "adjudication_status" in written[-1]


def shuffles_on_disk(spark) -> set:
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().iterator()
    names = []
    while files.hasNext():
        names.append(files.next().getName())
    return {name for name in names if name.startswith("shuffle_") and name.endswith(".data")}


def test_a_write_leaves_no_shuffle_files(spark):
    before = shuffles_on_disk(spark)
    kept = spark.conf.get(FREE_SHUFFLES)
    written = materialise(spark.range(100).groupBy(F.col("id") % 7).count())
    assert written.count() == 7 and spark.conf.get(FREE_SHUFFLES) == kept
    # The files go in the background; those of the count may stay.
    for _ in range(50):
        left = shuffles_on_disk(spark) - before
        if len(left) <= 1:
            break
        time.sleep(0.2)
    assert len(left) <= 1, left


def test_claims_do_not_move_to_the_members(spark, sample):
    r = Run(spark, sample)
    # The table of all members is no part of the joins, only what they say beyond being there.
    assert "c_custkey" not in plan(adj.gather_facts(*r.engine_inputs[:6]))


def test_member_terms_are_those_of_a_plain_join(spark):
    ended = day("2026-01-05")
    known = members(
        spark, {"member_id": "M1"}, {"member_id": "M2", "coverage_term_date": ended}, {"member_id": "M3"}, {"member_id": "M3"},
        {"member_id": "M4"}, {"member_id": "M4", "coverage_term_date": ended}, {"member_id": None}, {"member_id": None, "coverage_term_date": ended},
    )
    asked = claims(spark, *[{"claim_id": f"C{k}", "member_id": m} for k, m in enumerate(["M1", "M2", "M3", "M4", "M9", None])])
    benefits = spark.createDataFrame([("Physician", True, None)], "provider_type string, auth_required_flag boolean, delegated_vendor string")
    got = adj.enrich(asked, known, providers(spark), benefits, how="left")
    names = ["claim_id", "member_id", "coverage_term_date", "has_member", "provider_type", "has_benefit"]
    terms = known.select("member_id", "coverage_term_date", F.lit(True).alias("has_member"))
    wanted = asked.join(terms, "member_id", "left").selectExpr(*names[:4], "'Physician' provider_type", "true has_benefit")
    assert rows(got, *names) == rows(wanted, *names) and got.count() == 8


def test_marked_claims_adjudicate_alike(spark, sample):
    r = Run(spark, sample)
    names = queries.columns("claim") + ["denying_rule_id", "fail_030", "fail_050", "is_evaluated"]
    marked, plain = adj.adjudicate_claims(*r.staged_inputs), r.adjudicated
    assert "is_resubmission" in r.staged_inputs[0].columns and rows(marked, *names) == rows(plain, *names)
    # Only claims whose type needs an authorization are moved to look for one.
    assert "Union" in plan(marked)


def test_new_claims_are_written_without_what_is_alike_in_all(spark, sample, monkeypatch):
    written = []

    def noted(df):
        written.append(df.columns)
        return materialise(df)

    monkeypatch.setattr(queries, "materialise", noted)
    r = Run(spark, sample)
    names = queries.columns("claim")
    assert rows(r.booked, *names) == rows(r.claims, *names) and r.booked.dtypes == r.claims.dtypes
    assert "paid_amount" not in written[0] and "billed_amount" in written[0]


def test_a_stored_outcome_meets_written_claims(spark, sample):
    # Neither the claims nor the authorizations are derived again beside the stored outcome.
    assert "l_orderkey" not in plan(queries.QUERIES["outcome_write_back"](spark, sample))


def test_a_merge_joins_two_written_tables(spark, sample):
    text = plan(queries.QUERIES["merge_claims"](spark, sample))
    assert text.count("Join") == 1 and "l_orderkey" not in text


def test_denials_meet_the_claims_before_the_trace_unfolds(spark, sample):
    lines = plan(queries.QUERIES["rule_sequence_violations"](spark, sample)).splitlines()
    unfold = next(k for k, line in enumerate(lines) if "Generate" in line)
    meet = [k for k, line in enumerate(lines) if "Join Inner" in line and "claim_id" in line]
    assert meet and min(meet) > unfold


def test_a_trace_that_met_its_denials_breaks_alike(spark):
    outcome = spark.createDataFrame(
        [("C1", "R-020", 1, 1), ("C1", "R-020", 1, 1), ("C2", None, 0, 0), (None, "R-020", 1, 1), ("C3", "R-010", 1, 0)],
        "claim_id string, denying_rule_id string, fail_010 int, fail_020 int",
    )
    for name in ["fail_030", "fail_040", "fail_050", "fail_060", "fail_070", "filing_lag_days", "filing_limit", "filing_standard",
                 "price_pct_loaded", "price_pct_standard", "allowed_loaded", "allowed_standard"]:
        outcome = outcome.withColumn(name, F.lit(0))
    for name in ["member_id", "provider_type", "delegated_vendor"]:
        outcome = outcome.withColumn(name, F.lit("x"))
    outcome = outcome.withColumn("service_from_date", F.lit("2026-01-01").cast("date"))
    rules = spark.createDataFrame([("R-010", 10), ("R-020", 20), ("R-030", 30)], "rule_id string, rule_sequence int")
    denials = spark.createDataFrame([("C1", "R-020"), ("C3", "R-010"), ("C3", "R-030"), (None, "R-010")], "claim_id string, rule_id string")
    names = ["claim_id", "rule_id", "rule_result"]
    plain = quality.rule_sequence_violations(adj.rule_trace(outcome, rules), denials, rules)
    met = adj.rule_trace(quality.meet_denials(outcome, denials, rules), rules, carried=(quality.DENIAL_SEQUENCE,))
    found = rows(quality.rule_sequence_violations(met, denials, rules), *names)
    assert found == rows(plain, *names) and len(found) == 3


def test_the_assertions_write_each_large_count_by_itself(spark, sample):
    lines = plan(queries.QUERIES["assertion_grid"](spark, sample)).splitlines()
    assert not [line for line in lines if "Join" in line and ("claim_id" in line or "FullOuter" in line)]
