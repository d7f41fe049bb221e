"""Tiny frames for the tests."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from remitlens.schemas import SCHEMAS, columns


def day(text: str | None) -> dt.date | None:
    return dt.date.fromisoformat(text) if text else None


def money(text: str | None) -> Decimal | None:
    return Decimal(text) if text is not None else None


def frame(spark: SparkSession, table: str, *rows: dict) -> DataFrame:
    """Rows of a stored table; columns not given are NULL."""
    names = columns(table)
    unknown = {k for row in rows for k in row} - set(names)
    assert not unknown, unknown
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], SCHEMAS[table])


CLAIM = dict(
    claim_id="C1", member_id="M1", provider_id="P1", lob="STAR", procedure_code="99213",
    units=1, service_from_date=day("2026-01-10"), service_thru_date=day("2026-01-10"),
    received_date=day("2026-01-20"), billed_amount=money("200.00"), adjudication_status="PENDING",
)
MEMBER = dict(member_id="M1", lob="STAR", coverage_eff_date=day("2025-01-01"), county_code="101")
PROVIDER = dict(
    provider_id="P1", provider_name="One", npi="1000000001", provider_type="Physician",
    participating_flag=True, contract_eff_date=day("2023-01-01"),
)
RAW = dict(
    raw_row_num=1, claim_id="c1 ", member_id="M1", provider_id="P1", lob="star",
    procedure_code="99213", units="1", service_from_raw="2026-01-10",
    service_thru_raw="2026-01-10", received_raw="2026-01-20", billed_raw="200.00",
    source_file_name="f1",
)


def claims(spark, *changes: dict) -> DataFrame:
    return frame(spark, "claim", *[{**CLAIM, **c} for c in changes])


def members(spark, *changes: dict) -> DataFrame:
    return frame(spark, "member", *[{**MEMBER, **c} for c in (changes or ({},))])


def providers(spark, *changes: dict) -> DataFrame:
    return frame(spark, "provider", *[{**PROVIDER, **c} for c in (changes or ({},))])


def raw(spark, *changes: dict) -> DataFrame:
    return frame(spark, "claim_import", *[{**RAW, **c} for c in changes])


def rows(df: DataFrame, *names: str) -> list[tuple]:
    """Selected values in a fixed order, NULLs first."""
    got = [tuple(r) for r in df.select(*names).collect()]
    return sorted(got, key=lambda r: [(v is not None, str(v)) for v in r])
