"""Operators against brute force on small inputs, including hot groups."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from remitlens.operators.asof import asof_rate
from remitlens.operators.coverage import flag_covered
from remitlens.operators.hierarchy import hierarchy, unreachable
from remitlens.operators.ledger import append_rejects
from remitlens.operators.ranking import number_within, rank_within
from remitlens.operators.spine import calendar_from_bounds, date_spine, number_spine
from remitlens.plans.adjudicate import submission_seq
from remitlens.plans.health import trailing_mean
from tests.helpers import claims, day, frame, money, rows

START = dt.date(2026, 1, 1)


def plus(days):
    return START + dt.timedelta(days=days)


def test_asof_takes_the_latest_version_in_force(spark):
    """Random overlapping, ended and open versions; every day is looked up."""
    rng = random.Random(7)
    versions = []
    for code in "AB":
        for eff in rng.sample(range(0, 120), 12):
            term = None if rng.random() < 0.3 else plus(eff + rng.randint(0, 40))
            versions.append((code, plus(eff), term, Decimal(len(versions)).quantize(Decimal("0.01"))))
    fees = frame(spark, "fee_schedule", *[
        dict(procedure_code=c, effective_date=e, term_date=t, schedule_rate=r)
        for c, e, t, r in versions
    ])
    looked_up = [(code, plus(d)) for code in "ABC" for d in range(-3, 170)]
    df = spark.createDataFrame(looked_up, "procedure_code string, service_from_date date")

    def brute(code, on):
        hits = [(e, r) for c, e, t, r in versions if c == code and e <= on and (t is None or on <= t)]
        return max(hits)[1] if hits else None

    want = {(c, d): brute(c, d) for c, d in looked_up}
    got = rows(asof_rate(df, fees), "*")
    assert len(got) == len(looked_up) and {(c, d): r for c, d, r in got} == want
    inner = rows(asof_rate(df, fees, "inner"), "*")
    assert {(c, d): r for c, d, r in inner} == {k: v for k, v in want.items() if v is not None}


def test_an_ended_newer_version_gives_way_to_the_older_open_one(spark):
    fees = frame(
        spark, "fee_schedule",
        dict(procedure_code="A", effective_date=plus(0), schedule_rate=money("1.00")),
        dict(procedure_code="A", effective_date=plus(10), term_date=plus(20), schedule_rate=money("2.00")),
    )
    df = spark.createDataFrame([("A", plus(d)) for d in (5, 15, 25)],
                               "procedure_code string, service_from_date date")
    assert [r for _, r in rows(asof_rate(df, fees), "service_from_date", "schedule_rate")] == [
        money("1.00"), money("2.00"), money("1.00")]


def test_coverage_matches_comparing_all_pairs(spark):
    """Windows of every length, across block borders, open-ended and refused ones."""
    rng = random.Random(3)
    auths = []
    for i in range(60):
        lo = rng.randint(-400, 400)
        hi = 3_000_000 if i % 20 == 0 else lo + rng.choice([-1, 0, 1, 59, 60, 61, 130])
        thru = dt.date(9999, 12, 31) if hi == 3_000_000 else plus(hi)
        # One member owns a third of the authorizations.
        member = "HOT" if i % 3 == 0 else f"M{i % 5}"
        auths.append((member, rng.choice(["DME", "LTSS"]), plus(lo), thru,
                      rng.choice(["APPROVED", "APPROVED", "REFUSED"])))
    df = spark.createDataFrame(
        [(m, t, plus(d)) for m in ["HOT", "M1", "M2", "M9"] for t in ["DME", "LTSS"]
         for d in range(-450, 600, 7)],
        "member_id string, provider_type string, service_from_date date",
    )
    auth_frame = frame(spark, "prior_auth", *[
        dict(auth_id=i, member_id=m, provider_type=t, auth_eff_date=a, auth_thru_date=b, auth_status=s)
        for i, (m, t, a, b, s) in enumerate(auths)
    ])
    for member, kind, on, flag in rows(flag_covered(df, auth_frame, dates=df), "*"):
        want = any(m == member and t == kind and s == "APPROVED" and a <= on <= b
                   for m, t, a, b, s in auths)
        assert flag == want, (member, kind, on)


def test_numbers_in_a_hot_group(spark):
    data = [("HOT" if i % 3 else f"G{i % 4}", f"C{i:05d}") for i in range(3000)]
    random.Random(1).shuffle(data)
    df = spark.createDataFrame(data, "g string, c string").repartition(4)
    got = rows(number_within(df, ["g"], [F.col("c")], "n"), "g", "c", "n")
    want, seen = {}, {}
    for g, c in sorted(data):
        seen[g] = seen.get(g, 0) + 1
        want[g, c] = seen[g]
    assert {(g, c): n for g, c, n in got} == want


def test_numbers_have_one_type_for_groups_of_any_size(spark):
    for n in (2, 5000):
        df = spark.range(n).select(F.lit("g").alias("g"), F.col("id").alias("c"))
        assert dict(number_within(df, ["g"], [F.col("c")], "n").dtypes)["n"] == "int"
        assert dict(rank_within(df, "g", "c", "c", "k").dtypes)["k"] == "int"


def test_authorizations_without_dates_cover_nothing(spark):
    df = frame(spark, "claim", dict(claim_id="C1", member_id="M", service_from_date=dt.date(2026, 3, 1)))
    df = df.select("claim_id", "member_id", "service_from_date", F.lit("T").alias("provider_type"))
    auth = dict(auth_id=1, member_id="M", provider_type="T", auth_status="APPROVED")
    for dates in (dict(auth_eff_date=dt.date(2026, 1, 1)), dict(auth_thru_date=dt.date(2027, 1, 1)), {}):
        auths = frame(spark, "prior_auth", {**auth, **dates})
        assert [r[0] for r in rows(flag_covered(df, auths, dates=df), "auth_on_file")] == [False]
        assert flag_covered(df.limit(0), auths, dates=df.limit(0)).count() == 0


def test_rank_keeps_ties(spark):
    data = [("A", f"P{i}", i // 3) for i in range(30)] + [("B", "P99", 1)]
    df = spark.createDataFrame(data, "g string, p string, v int")
    got = rows(rank_within(df, "g", "v", "p", "k"), "g", "p", "k")
    want = {(g, p): 1 + sum(1 for g2, _, v2 in data if g2 == g and v2 > v) for g, p, v in data}
    assert {(g, p): k for g, p, k in got} == want


def test_submission_seq_orders_by_claim_id(spark):
    df = claims(spark, {"claim_id": "C3"}, {"claim_id": "C1"}, {"claim_id": "C2"},
                {"claim_id": "C4", "member_id": "M2"}, {"claim_id": "C5", "procedure_code": "X"})
    assert rows(submission_seq(df), "claim_id", "submission_seq") == [("C1", 1), ("C2", 2), ("C3", 3)]


def test_trailing_mean_leaves_the_day_itself_out_and_skips_missing_days(spark):
    values = {0: 10, 1: 20, 2: None, 3: 1000, 10: 5}
    df = spark.createDataFrame([(plus(d), values.get(d)) for d in range(12)], "d date, v bigint")
    got = {d: m for d, m in rows(trailing_mean(df, "d", "v", "m"), "d", "m")}
    for d in range(12):
        window = [values[k] for k in range(d - 7, d) if values.get(k) is not None]
        want = round(Decimal(sum(window)) / len(window), 6) if window else None
        assert got[plus(d)] == want


def test_spines(spark):
    assert rows(date_spine(spark, "2026-02-27", "2026-03-01"), "*") == [
        (day("2026-02-27"),), (day("2026-02-28"),), (day("2026-03-01"),)]
    with pytest.raises(ValueError, match="precedes"):
        date_spine(spark, "2026-02-02", "2026-02-01")
    assert [n for (n,) in rows(number_spine(spark, 5), "n")] == [1, 2, 3, 4, 5]
    gapped = spark.createDataFrame([(plus(0),), (plus(3),)], "d date")
    assert calendar_from_bounds(gapped, "d").count() == 4
    assert calendar_from_bounds(gapped.filter("false"), "d").count() == 0


def chain(spark, length):
    return spark.createDataFrame(
        [(f"N{i}", f"N{i - 1}" if i else None) for i in range(length + 1)], "id string, parent string"
    )


def test_hierarchy_depth_limit_and_loops(spark):
    assert max(d for _, _, d in rows(hierarchy(chain(spark, 25), "id", "parent"), "*")) == 25
    with pytest.raises(Exception, match="RECURSION_LEVEL_LIMIT_EXCEEDED"):
        hierarchy(chain(spark, 26), "id", "parent").collect()
    # A loop is never reached from a root.
    looped = spark.createDataFrame([("A", None), ("B", "C"), ("C", "B")], "id string, parent string")
    assert rows(hierarchy(looped, "id", "parent"), "*") == [("A", "A", 0)]


def walked(pairs):
    """The walk over the rows one level at a time, as a recursive query does it."""
    level = [(n, n, 0) for n, p in pairs if p is None]
    out = list(level)
    while level:
        level = [(n, r, d + 1) for n, p in pairs for m, r, d in level if p == m]
        out += level
    return sorted(out)


def test_hierarchy_by_doubling_equals_a_walk(spark):
    import random

    rnd = random.Random(7)
    for size in (1, 9, 60, 300):
        pairs = [(f"N{i}", None if i == 0 or rnd.random() < 0.1 else f"N{rnd.randrange(i)}") for i in range(size)]
        pairs += [("L1", "L2"), ("L2", "L1"), ("U", "L1"), ("D", "GONE"), ("E", "D"), pairs[-1]]
        df = spark.createDataFrame(pairs, "id string, parent string")
        assert rows(hierarchy(df, "id", "parent", max_depth=400), "*") == walked(pairs)
        lost = {(n, r, m) for n, r, m in rows(unreachable(df, "id", "parent"), "*")}
        assert lost == {("L1", "loop", None), ("L2", "loop", None), ("U", "loop", None), ("D", "dangling", "GONE"), ("E", "dangling", "GONE")}
    assert hierarchy(chain(spark, 3).limit(0), "id", "parent").count() == 0


def test_hierarchy_takes_log_passes(spark, monkeypatch):
    from remitlens.operators import hierarchy as module

    jumps = []
    real = module._jump
    monkeypatch.setattr(module, "_jump", lambda state: jumps.append(1) or real(state))
    assert max(d for _, _, d in rows(module.hierarchy(chain(spark, 25), "id", "parent"), "*")) == 25
    assert len(jumps) == 5


def test_ledger_takes_each_row_once(spark):
    old = frame(spark, "claim_reject", dict(source_file_name="f", raw_row_num=1, reject_reason="old"))
    new = frame(spark, "claim_reject",
                dict(source_file_name="f", raw_row_num=1, reject_reason="new"),
                dict(source_file_name="g", raw_row_num=1, reject_reason="new"))
    assert rows(append_rejects(new, old), "source_file_name", "reject_reason") == [
        ("f", "old"), ("g", "new")]
