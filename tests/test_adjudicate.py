import pytest

from remitlens.plans import adjudicate as adj
from remitlens.plans import whatif
from remitlens.sources.reference import reference_data
from tests.helpers import claims, day, frame, members, money, providers, rows


@pytest.fixture(scope="module")
def ref(spark):
    return reference_data(spark)


TRANSPORT = {"provider_id": "PT", "provider_type": "Transportation"}
LTSS = {"provider_id": "PL", "provider_type": "LTSS"}
PHARMACY = {"provider_id": "PX", "provider_type": "Pharmacy"}
NON_PAR = {"provider_id": "PN", "participating_flag": False}
NEW_PAR = {"provider_id": "PF", "contract_eff_date": day("2026-06-01")}
NEW_NON_PAR = {"provider_id": "PG", "participating_flag": False, "contract_eff_date": day("2026-06-01")}


def run(spark, ref, *changes, auths=(), config=None):
    return adj.adjudicate_claims(
        claims(spark, *changes),
        members(spark, {}, {"member_id": "ENDED", "coverage_term_date": day("2026-01-09")},
                {"member_id": "LAST", "coverage_term_date": day("2026-01-10")}),
        providers(spark, {}, TRANSPORT, LTSS, PHARMACY, NON_PAR, NEW_PAR, NEW_NON_PAR),
        ref["benefit_category"],
        frame(spark, "prior_auth", *auths),
        ref["fee_schedule"],
        config if config is not None else ref["plan_config"],
    )


def verdict(spark, ref, change, **kwargs):
    return rows(run(spark, ref, change, **kwargs), "adjudication_status", "denying_rule_id",
                "denial_code")[0]


AUTH = dict(auth_id=1, member_id="M1", provider_type="LTSS", auth_eff_date=day("2026-01-01"),
            auth_thru_date=day("2026-01-31"), auth_status="APPROVED")
LTSS_CLAIM = {"provider_id": "PL", "procedure_code": "T1019", "units": 10}


@pytest.mark.parametrize("change, rule, code", [
    ({}, None, None),
    ({"member_id": "ENDED"}, "R-010", "D-EL01"),
    ({"member_id": "LAST"}, None, None),
    ({"provider_id": "PF"}, "R-020", "D-PR04"),
    ({"provider_id": "PG"}, None, None),
    ({"received_date": day("2026-04-10")}, None, None),            # 90 days
    ({"received_date": day("2026-04-11")}, "R-060", "D-TF01"),     # 91 days
    ({"provider_id": "PN", "received_date": day("2027-01-10")}, None, None),          # 365
    ({"provider_id": "PN", "received_date": day("2027-01-11")}, "R-060", "D-TF01"),   # 366
    (LTSS_CLAIM, "R-050", "D-AU01"),
    ({"provider_id": "PT", "procedure_code": "A0120"}, "R-050", "D-AU01"),
    # The first rule in order wins.
    ({"member_id": "ENDED", "provider_id": "PF"}, "R-010", "D-EL01"),
    ({**LTSS_CLAIM, "received_date": day("2026-09-01")}, "R-050", "D-AU01"),
])
def test_each_rule(spark, ref, change, rule, code):
    assert verdict(spark, ref, change) == ("DENIED" if rule else "PAID", rule, code)


@pytest.mark.parametrize("auth, on_file", [
    ({}, True),
    ({"auth_thru_date": day("2026-01-10")}, True),
    ({"auth_eff_date": day("2026-01-10")}, True),
    ({"auth_thru_date": day("2026-01-09")}, False),
    ({"auth_eff_date": day("2026-01-11")}, False),
    ({"auth_status": "REFUSED"}, False),
    ({"provider_type": "DME"}, False),
    ({"member_id": "M2"}, False),
])
def test_authorization_on_file(spark, ref, auth, on_file):
    status = verdict(spark, ref, LTSS_CLAIM, auths=[{**AUTH, **auth}])[0]
    assert status == ("PAID" if on_file else "DENIED")


def test_transportation_is_paid_once_the_exemption_is_loaded(spark, ref):
    fixed = whatif.standardize_config(ref["plan_config"])
    change = {"provider_id": "PT", "procedure_code": "A0120"}
    assert verdict(spark, ref, change, config=fixed)[0] == "PAID"


def test_second_submission_is_a_duplicate(spark, ref):
    got = rows(run(spark, ref, {"claim_id": "C2"}, {"claim_id": "C1"}), "claim_id", "denying_rule_id")
    assert got == [("C1", None), ("C2", "R-030")]


def test_carved_out_type_needs_a_pricing_key_to_be_denied(spark, ref):
    """Without its percentage the claim is not evaluated at all and stays pending."""
    change = {"provider_id": "PX"}
    assert verdict(spark, ref, change)[0] == "PENDING"
    key = frame(spark, "plan_config", dict(
        config_key="FeeSchedulePct_Pharmacy", loaded_value=money("100.00"),
        standard_value=money("100.00")))
    assert verdict(spark, ref, change, config=ref["plan_config"].unionByName(key)) == (
        "DENIED", "R-040", "D-CO02")


@pytest.mark.parametrize("change", [
    {"procedure_code": "NOPE"}, {"service_from_date": day("2024-12-31")}, {"member_id": "M404"},
    {"provider_id": "P404"},
])
def test_claims_outside_the_lookups_stay_pending(spark, ref, change):
    got = run(spark, ref, change)
    assert rows(got, "adjudication_status", "paid_amount", "expected_allowed_amount") == [
        ("PENDING", None, None)]


def test_amounts_and_dates(spark, ref):
    paid = run(spark, ref, LTSS_CLAIM, auths=[AUTH])
    # 26.04 x 10 units, paid at 80 percent
    assert rows(paid, "paid_amount", "expected_allowed_amount", "adjudicated_date") == [
        (money("208.32"), money("260.40"), day("2026-02-03"))]
    denied = run(spark, ref, LTSS_CLAIM)
    assert rows(denied, "paid_amount", "expected_allowed_amount") == [
        (money("0.00"), money("260.40"))]


def test_write_back_agrees_with_the_single_pass(spark, ref):
    changes = [{}, {"claim_id": "C2"}, {"claim_id": "C3", **LTSS_CLAIM},
               {"claim_id": "C4", "procedure_code": "NOPE"}]
    result = run(spark, ref, *changes)
    outcome = adj.first_failure(
        result.filter("is_evaluated").select(*adj.EVALUATION_COLUMNS))
    stored = adj.apply_outcome(claims(spark, *changes), outcome)
    assert rows(stored, *stored.columns) == rows(result, *stored.columns)


def test_trace_skips_after_the_denial_and_reports_the_soft_rule(spark, ref):
    result = run(spark, ref, {"claim_id": "A", **LTSS_CLAIM}, {"claim_id": "B", **LTSS_CLAIM, "member_id": "LAST"},
                 auths=[{**AUTH, "member_id": "LAST"}])
    trace = adj.rule_trace(result.filter("is_evaluated"), ref["adjudication_rule"])
    by_claim = {}
    for claim, rule, outcome in rows(trace, "claim_id", "rule_id", "rule_result"):
        by_claim.setdefault(claim, {})[rule] = outcome
    assert by_claim["A"] == {"R-010": "PASS", "R-020": "PASS", "R-030": "PASS", "R-040": "PASS",
                             "R-050": "FAIL", "R-060": "SKIP", "R-070": "SKIP"}
    assert by_claim["B"] == {**dict.fromkeys(by_claim["A"], "PASS"), "R-070": "FAIL"}
    texts = {(c, r): e for c, r, e in rows(trace, "claim_id", "rule_id", "evidence")}
    assert texts["A", "R-010"] == "Member M1, DOS 2026-01-10"
    assert texts["A", "R-050"] == "Category LTSS"
    assert texts["A", "R-060"] == "Filing lag 10 days against a 90 day limit; contractual limit is 95 days"
    assert texts["A", "R-070"] == (
        "Priced at 80.00 pct against a contracted 100.00 pct; allowed 208.32 versus 260.40")
    assert texts["A", "R-020"] is None


def test_trace_names_the_vendor(spark, ref):
    result = run(spark, ref, {"provider_id": "PT", "procedure_code": "A0120"})
    trace = adj.rule_trace(result.filter("is_evaluated"), ref["adjudication_rule"])
    assert rows(trace.filter("rule_id = 'R-050'"), "evidence") == [
        ("Category Transportation delegated to MTM",)]


def test_what_if_moves_denials_to_paid_and_changes_nothing(spark, ref):
    late = {"received_date": day("2026-04-12")}
    inputs = (
        claims(spark, {}, {"claim_id": "C2", "procedure_code": "99214", **late},
               {"claim_id": "C3", **LTSS_CLAIM, "units": 1}),
        members(spark), providers(spark, {}, LTSS), ref["benefit_category"],
        frame(spark, "prior_auth", AUTH), ref["fee_schedule"], ref["plan_config"],
    )
    got = rows(whatif.what_if(*inputs), "metric", "claims_before", "claims_after", "claims_delta",
               "amount_before", "amount_after", "amount_delta")
    assert got == [
        ("Denied claims", 1, 0, -1, money("143.84"), money("0.00"), money("-143.84")),
        ("Paid claims", 2, 3, 1, money("123.13"), money("272.18"), money("149.05")),
    ]
    assert rows(whatif.no_side_effects(ref["plan_config"], inputs[0]), "*") == [(3, 0)]
