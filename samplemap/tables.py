"""The driver's tables read as the claim model (see FIXTURES.md).

Only integer arithmetic and string formatting, so that any engine derives the same rows.
"""

from __future__ import annotations

from functools import cache, cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from remitlens.schemas import columns
from remitlens.sources.reference import (
    FULL_RATE_TYPES,
    adjudication_rules,
    base_config,
    benefit_categories,
    full_rate_config,
    literal_rows,
    table_rows,
)

PRIME = 2147483647
STEP = 1000003
PROVIDER_TYPES = [
    "Physician", "Hospital-Based", "Ancillary", "Facility", "LTSS",
    "DME", "Transportation", "BehavioralHealth", "Pharmacy", "Dental",
]
FULL_RATE = [*FULL_RATE_TYPES, "Pharmacy"]
FILES = ["claims_a", "claims_b"]
AS_OF = "2026-01-01"


def h(n: str, salt: int, size: int | str) -> str:
    """Spread an integer over 0..size-1, the same way in every engine."""
    return f"((cast({n} as bigint) + 1) % {PRIME} * {salt * STEP}L % {PRIME} % {size})"


def padded(prefix: str, number: str, width: int) -> str:
    """Prefix and zero-padded number; a number wider than the padding keeps all its digits."""
    text = f"cast({number} as string)"
    return f"concat('{prefix}', lpad({text}, greatest(length({text}), {width}), '0'))"


def provider_type(suppkey: str) -> str:
    names = ", ".join(f"'{t}'" for t in PROVIDER_TYPES)
    return f"element_at(array({names}), cast({suppkey} % 10 + 1 as int))"


CENTS = "cast({0} as decimal(12,2))"
CLAIM_VALUES = {
    "claim_id": padded("CLM-", "n", 9),
    "member_id": padded("M6", "o_custkey", 7),
    "provider_id": padded("P8", "suppkey", 5),
    "procedure_code": f"concat('C', lpad(cast(suppkey % 10 * 3 + {h('n', 113, 3)} as string), 3, '0'))",
    "units": f"cast(if(suppkey % 10 = 4, 8 + {h('n', 127, 33)}, 1) as smallint)",
    "service_from_date": f"date_add(order_day, cast({h('n', 107, 4)} as int))",
    "roll": h("n", 109, 1000),
}
LAG_DAYS = """cast(case when roll < 40 then 91 + roll % 5
                        when roll < 70 then 100 + roll * 5
                        else 2 + roll % 80 end as int)"""
#: Columns that are the same in every new claim.
NEW_CLAIM = {
    "modifier_list": "cast(null as string)",
    "adjudicated_date": "cast(null as date)",
    "expected_allowed_amount": "cast(null as decimal(12,2))",
    "paid_amount": "cast(null as decimal(12,2))",
    "adjudication_status": "'PENDING'",
}


class Sample:
    """Lazy views over one directory of driver tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.raw = cache(self._read)

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # ---- dimensions

    @cached_property
    def members(self) -> DataFrame:
        return self.raw("customer").selectExpr(
            f"{padded('M6', 'c_custkey', 7)} as member_id",
            "c_mktsegment as lob",
            "date '1990-01-01' as coverage_eff_date",
            f"""case when {h('c_custkey', 23, 1000)} < 22
                     then date_add(date '1996-01-01', cast({h('c_custkey', 29, 1500)} as int))
                end as coverage_term_date""",
            f"{padded('', 'c_nationkey + 101', 3)} as county_code",
        )

    @cached_property
    def providers(self) -> DataFrame:
        return self.raw("supplier").selectExpr(
            f"{padded('P8', 's_suppkey', 5)} as provider_id",
            f"if(s_suppkey >= 4, {padded('P8', 's_suppkey div 4', 5)}, null) as parent_provider_id",
            "s_name as provider_name",
            f"{padded('', 's_suppkey + 1000000000', 10)} as npi",
            f"{provider_type('s_suppkey')} as provider_type",
            f"{h('s_suppkey', 61, 100)} >= 16 as participating_flag",
            f"""if({h('s_suppkey', 67, 1000)} < 60, date '1998-01-01', date '1990-01-01')
                as contract_eff_date""",
            "cast(null as date) as contract_term_date",
        )

    @cached_property
    def config(self) -> DataFrame:
        """The listed keys plus one full-rate key for every other type but Dental."""
        listed = base_config(self.spark)
        types = literal_rows(
            self.spark, listed.select(F.lit("").alias("provider_type")).schema,
            [(t,) for t in FULL_RATE],
        )
        return listed.unionByName(full_rate_config(types))

    @cached_property
    def config_in_use(self) -> DataFrame:
        """The same register, with the full-rate keys of the types the providers have."""
        names = ", ".join(f"'{t}'" for t in FULL_RATE)
        types = (
            self.raw("supplier").selectExpr(f"{provider_type('s_suppkey')} as provider_type")
            .filter(f"provider_type in ({names})")
            .distinct()
        )
        return base_config(self.spark).unionByName(full_rate_config(types))

    @cached_property
    def rules(self) -> DataFrame:
        return adjudication_rules(self.spark)

    @cached_property
    def benefits(self) -> DataFrame:
        return benefit_categories(self.spark)

    @cached_property
    def fees(self) -> DataFrame:
        """Two open-ended versions per code; code 2 has one version that ends in 1998."""
        rows = []
        for k in range(30):
            first, second = 2000 + 3750 * k, 2200 + 4125 * k
            rows.append((f"C{k:03d}", "1990-01-01", "1998-12-31" if k == 2 else None, first / 100))
            if k != 2:
                rows.append((f"C{k:03d}", "1999-01-01", None, second / 100))
        return table_rows(self.spark, "fee_schedule", rows)

    # ---- claims

    @cached_property
    def _orders(self) -> DataFrame:
        """Order with the numbers of its member and provider; their ids are spelled out after the last shuffle, as text is wide."""
        provider = h("o_orderkey", 103, "(SELECT count(*) FROM {suppliers})")
        return self.spark.sql(
            f"SELECT o_orderkey AS l_orderkey, o_custkey, to_date(o_orderdate) AS order_day, "
            f"{provider} AS suppkey FROM {{orders}}",
            orders=self.raw("orders"),
            suppliers=self.raw("supplier"),
        )

    @cached_property
    def _booked_orders(self) -> DataFrame:
        """Orders with their customer's line of business, joined while they are still fewer and narrower than the lines."""
        lobs = self.raw("customer").selectExpr("c_custkey as o_custkey", "c_mktsegment as lob")
        return self._orders.join(lobs, "o_custkey")

    def _claim_lines(self, lines: DataFrame, orders: DataFrame) -> DataFrame:
        """Derive the clean values of claim lines (l_orderkey, l_linenumber) with the columns of their orders."""
        carried = [c for c in lines.columns if c not in ("l_orderkey", "l_linenumber")]
        ordered = [c for c in orders.columns if c not in ("l_orderkey", "order_day")]
        return (
            lines.selectExpr("*", "l_orderkey * 8 + l_linenumber as n")
            .join(orders, "l_orderkey")
            .selectExpr(
                "l_orderkey", "l_linenumber", "n", *ordered,
                *carried, *[f"{value} as {name}" for name, value in CLAIM_VALUES.items()],
            )
            .selectExpr("*", f"date_add(service_from_date, {LAG_DAYS}) as received_date")
        )

    @cached_property
    def claims(self) -> DataFrame:
        """One PENDING claim per (order, line); repeated lines keep the highest price."""
        lines = (
            self.raw("lineitem").groupBy("l_orderkey", "l_linenumber").max("l_extendedprice")
            .toDF("l_orderkey", "l_linenumber", "price")
            .selectExpr("l_orderkey", "l_linenumber", f"{CENTS.format('price')} as billed_amount")
        )
        claims = self._claim_lines(lines, self._booked_orders).selectExpr(
            "*",
            "service_from_date as service_thru_date",
            *[f"{value} as {name}" for name, value in NEW_CLAIM.items()],
        )
        return claims.select(*columns("claim"))

    @cached_property
    def auths(self) -> DataFrame:
        """Authorizations for most claims that need one; some are refused or end too early."""
        lines = self.raw("lineitem").select("l_orderkey", "l_linenumber").distinct()
        needed = self.benefits.filter("auth_required_flag").select("provider_type")
        return (
            self._claim_lines(lines, self._orders)
            .selectExpr("*", f"{provider_type('suppkey')} as provider_type")
            .join(needed, "provider_type", "left_semi")
            .filter(f"{h('n', 137, 100)} >= if(provider_type = 'Transportation', 88, 8)")
            .selectExpr(
                "n as auth_id",
                "member_id",
                "provider_type",
                "date_sub(service_from_date, 30) as auth_eff_date",
                f"""date_add(service_from_date, if({h('n', 151, 16)} = 0, -5, 30))
                    as auth_thru_date""",
                f"if({h('n', 149, 20)} = 0, 'REFUSED', 'APPROVED') as auth_status",
            )
        )

    # ---- staging

    @cached_property
    def staging(self) -> DataFrame:
        """Raw submissions: every line item is one row of text in one of two files."""
        # Copies of a line are numbered inside 64 slices, so no slice holds all copies of one.
        lines = (
            self.raw("lineitem")
            .selectExpr(
                "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                f"{CENTS.format('l_extendedprice')} as billed_amount",
                "(l_partkey + l_suppkey * 31) % 64 as slice",
            )
            .selectExpr(
                "l_orderkey", "l_linenumber", "billed_amount",
                """row_number() over (partition by l_orderkey, l_linenumber, slice
                                      order by l_partkey, l_suppkey, billed_amount)
                   * 64L + slice as v""",
            )
        )
        rows = self._claim_lines(lines, self._booked_orders).selectExpr(
            "*",
            "n * 16777216 + v as raw_row_num",
            # Decides what is wrong with the row.
            "l_orderkey * 7 + l_linenumber * 13 + v as z",
            "cast(service_from_date as string) as service_text",
            "cast(received_date as string) as received_text",
            "cast(date_sub(service_from_date, 1) as string) as day_before",
            "cast(date_sub(service_from_date, 3) as string) as three_before",
        )
        return rows.selectExpr(*[f"{text} as {name}" for name, text in _dirt().items()]).select(
            *columns("claim_import")
        )

    @cached_property
    def partition_log(self) -> DataFrame:
        return self.log_of(self.claims)

    @staticmethod
    def log_of(claims: DataFrame) -> DataFrame:
        """A log with every kind of fault, over the dates that have claims."""
        return (
            claims.groupBy("service_from_date").count()
            .selectExpr(
                "service_from_date as partition_date",
                "count as seen",
                "datediff(service_from_date, date '1995-01-01') as i",
                "cast(service_from_date as timestamp) as load_start_utc",
            )
            .filter("i % 97 <> 0")
            .selectExpr(
                "partition_date",
                """cast(case when i % 83 = 0 then 0
                             when i % 79 = 0 then seen * 3 + 3
                             when i % 73 = 0 then seen div 5
                             else seen end as bigint) as rows_written""",
                "seen as source_rows_read",
                "cast(if(i % 71 = 0, seen div 4, 0) as bigint) as rejected_rows",
                "load_start_utc",
                "timestamp_seconds(unix_timestamp(load_start_utc) + 3 + i % 5) as load_end_utc",
                """case when i % 89 = 0 then 'FAILED' when i % 67 = 0 then 'RELOADED'
                        else 'SUCCESS' end as load_status""",
                "if(i % 89 = 0, 'load error', null) as load_message",
            )
        )


def _dirt() -> dict[str, str]:
    """The text a partner file would hold in place of each clean value, with its errors."""

    def dated(day: str) -> str:
        """``day`` is an ISO text; one of three layouts of it."""
        return (
            f"case z % 3 when 0 then {day} when 1 then concat_ws('/', substr({day}, 6, 2), "
            f"substr({day}, 9, 2), substr({day}, 1, 4)) else replace({day}, '-', '') end"
        )

    def spoilt(clean: str, *errors: tuple[int, str]) -> str:
        cases = " ".join(f"when z % {k} = 0 then {text}" for k, text in errors)
        return f"case {cases} else {clean} end"

    service, received = dated("service_text"), dated("received_text")
    return {
        "raw_row_num": "raw_row_num",
        "claim_id": spoilt("claim_id", (997, "null"), (5, "concat('  ', lower(claim_id), ' ')")),
        "member_id": spoilt("member_id", (503, "null"), (499, "'M69999999'")),
        "provider_id": spoilt("provider_id", (491, "null"), (487, "'P899999X'")),
        "lob": "concat(' ', lower(lob))",
        "procedure_code": "procedure_code",
        "modifier_list": f"""element_at(array(null, '25', ' 25|59 | GT ', 'GT||X|59'),
                                        cast({h('n', 139, 4)} + 1 as int))""",
        "units": spoilt("concat(' ', cast(units as string), ' ')", (257, "'0'"), (263, "'x'")),
        "service_from_raw": spoilt(service, (211, "'2026-13-45'"), (251, "'2099-01-01'")),
        "service_thru_raw": spoilt(
            service, (223, "''"), (227, dated("day_before")),
            (251, "'2099-01-01'"),
        ),
        "received_raw": spoilt(
            received, (229, "'n/a'"), (233, dated("three_before")),
            (251, "'2099-02-01'"),
        ),
        "billed_raw": spoilt(
            "cast(billed_amount as string)", (239, "'abc'"), (241, "'(85.00)'"),
            (2, "concat('$', format_number(billed_amount, 2), ' ')"),
        ),
        "source_file_name": f"if(z % 4 = 0, '{FILES[1]}', '{FILES[0]}')",
        "loaded_utc": "timestamp '2026-01-01 00:00:00'",
    }
