"""Reference rows the engine ships with, and literal rows in general."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from remitlens.schemas import SCHEMAS

# Configuration register (key, path, scope, loaded, standard, source).
CONFIG_ROWS = [
    ("TimelyFilingDaysPar", "dbo.PlanConfig / TimelyFilingDaysPar", "ALL", 90, 95,
     "Participating provider agreement, claims submission article"),
    ("TimelyFilingDaysNonPar", "dbo.PlanConfig / TimelyFilingDaysNonPar", "ALL", 365, 365,
     "Provider manual, out-of-network claims submission"),
    ("FeeSchedulePct_LTSS", "dbo.FeeScheduleConfig / LtssPct", "STAR+PLUS", 80, 100,
     "LTSS reimbursed at 100 percent of the state fee schedule"),
    ("FeeSchedulePct_DME", "dbo.FeeScheduleConfig / DmePct", "ALL", 80, 80,
     "DME reimbursed at 80 percent of the state fee schedule"),
    ("AuthExempt_Transportation", "dbo.AuthRuleConfig / ExemptCategories", "ALL", 0, 1,
     "Transportation delegated to vendor; exempt from plan prior auth"),
    ("AuthExempt_Meal", "dbo.AuthRuleConfig / ExemptCategories", "D-SNP", 1, 1,
     "Post-discharge meal benefit exempt from prior authorization"),
]
FULL_RATE_TYPES = [
    "Physician", "Hospital-Based", "Ancillary", "Facility", "Transportation", "BehavioralHealth",
]
FULL_RATE_SOURCE = "Contracted at 100 percent of the state fee schedule"
CONFIG_EFFECTIVE = "2025-01-01"
CONFIG_LOADER = "CONFIG.LOAD"
PCT_PREFIX = "FeeSchedulePct_"

# Rules in evaluation order (id, name, sequence, configuration key).
RULE_ROWS = [
    ("R-010", "Member eligibility on date of service", 10, None),
    ("R-020", "Provider contract effective on date of service", 20, None),
    ("R-030", "Duplicate submission", 30, None),
    ("R-040", "Delegated vendor benefit routing", 40, None),
    ("R-050", "Prior authorization on file", 50, "AuthExempt_Transportation"),
    ("R-060", "Timely filing", 60, "TimelyFilingDaysPar"),
    ("R-070", "Fee schedule pricing", 70, "FeeSchedulePct_LTSS"),
]
NO_DENIAL_RULE = "R-000"
NO_DENIAL_NAME = "No denial — claim paid"

# Benefit per provider type (type, category, auth required, vendor, auth exempt).
BENEFIT_ROWS = [
    ("Physician", "Medical", False, None, False),
    ("Hospital-Based", "Medical", False, None, False),
    ("Ancillary", "Medical", False, None, False),
    ("Facility", "Medical", True, None, False),
    ("LTSS", "LTSS", True, None, False),
    ("DME", "DME", True, None, False),
    ("Transportation", "Transportation", True, "MTM", True),
    ("BehavioralHealth", "Behavioral", True, None, False),
    ("Pharmacy", "Pharmacy", False, "Navitus", False),
    ("Dental", "Dental", False, "FCL Dental", False),
    ("Vision", "Vision", False, "Envolve Vision", False),
]

# Fee schedule rates, all effective 2025-01-01 and open-ended.
FEE_RATES = {
    "99213": "102.30", "99214": "143.84", "99395": "153.76", "99283": "396.80",
    "99285": "917.60", "00790": "694.40", "70553": "1171.80", "80053": "48.36",
    "93306": "706.80", "45378": "1457.00", "29881": "3658.00", "59400": "2926.40",
    "T1019": "26.04", "S5150": "23.56", "S5102": "59.52", "E0601": "781.20",
    "K0001": "322.40", "E1390": "440.20", "A0120": "42.16", "A0130": "58.90",
    "90837": "130.20", "90792": "244.90", "H0015": "297.60",
}


def _sql_literal(value, data_type: str) -> str:
    if value is None:
        return f"CAST(NULL AS {data_type})"
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"CAST('{text}' AS {data_type})"


def literal_rows(spark: SparkSession, schema: T.StructType, rows: list[tuple]) -> DataFrame:
    """Rows as an inline table: unlike rows shipped from Python, Spark knows their size."""
    if not rows:
        return spark.createDataFrame([], schema)
    values = ", ".join(
        "("
        + ", ".join(_sql_literal(v, f.dataType.simpleString()) for v, f in zip(row, schema.fields))
        + ")"
        for row in rows
    )
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(schema.fieldNames())})")


def table_rows(spark: SparkSession, table: str, rows: list[tuple]) -> DataFrame:
    """Literal rows of one of the stored tables."""
    return literal_rows(spark, SCHEMAS[table], rows)


def full_rate_config(provider_types: DataFrame) -> DataFrame:
    """One 100-percent pricing key for each ``provider_type``."""
    return provider_types.select(
        F.concat(F.lit(PCT_PREFIX), "provider_type").alias("config_key"),
        F.concat(F.lit("dbo.FeeScheduleConfig / Pct_"), "provider_type").alias("config_path"),
        F.lit("ALL").alias("config_scope"),
        F.lit(Decimal("100.00")).cast("decimal(10,2)").alias("loaded_value"),
        F.lit(Decimal("100.00")).cast("decimal(10,2)").alias("standard_value"),
        F.lit(FULL_RATE_SOURCE).alias("standard_source"),
        F.lit(dt.date.fromisoformat(CONFIG_EFFECTIVE)).alias("effective_date"),
        F.lit(CONFIG_LOADER).alias("last_changed_by"),
        F.current_timestamp().alias("last_changed_utc"),
    )


def base_config(spark: SparkSession) -> DataFrame:
    """The keys listed one by one."""
    rows = [
        (key, path, scope, loaded, standard, source, CONFIG_EFFECTIVE, CONFIG_LOADER, None)
        for key, path, scope, loaded, standard, source in CONFIG_ROWS
    ]
    return table_rows(spark, "plan_config", rows).withColumn(
        "last_changed_utc", F.current_timestamp()
    )


def plan_config(spark: SparkSession) -> DataFrame:
    schema = T.StructType([T.StructField("provider_type", T.StringType())])
    types = literal_rows(spark, schema, [(t,) for t in FULL_RATE_TYPES])
    return base_config(spark).unionByName(full_rate_config(types))


def adjudication_rules(spark: SparkSession) -> DataFrame:
    return table_rows(spark, "adjudication_rule", RULE_ROWS)


def benefit_categories(spark: SparkSession) -> DataFrame:
    rows = [
        (kind, category, str(required).lower(), vendor, str(exempt).lower())
        for kind, category, required, vendor, exempt in BENEFIT_ROWS
    ]
    return table_rows(spark, "benefit_category", rows)


def fee_schedule(spark: SparkSession) -> DataFrame:
    rows = [(code, "2025-01-01", None, rate) for code, rate in FEE_RATES.items()]
    return table_rows(spark, "fee_schedule", rows)


def reference_data(spark: SparkSession) -> dict[str, DataFrame]:
    return {
        "plan_config": plan_config(spark),
        "adjudication_rule": adjudication_rules(spark),
        "benefit_category": benefit_categories(spark),
        "fee_schedule": fee_schedule(spark),
    }
