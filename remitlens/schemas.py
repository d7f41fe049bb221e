"""Column types of every stored table.  Nothing is ever inferred from the data."""

from __future__ import annotations

from pyspark.sql import types as T

RATE = T.DecimalType(12, 2)
PERCENT = T.DecimalType(10, 2)
# Sums run over the whole claim history, so totals get a wider type than single amounts.
TOTAL = T.DecimalType(20, 2)
SHARE = T.DecimalType(5, 2)


_TYPES = {
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "smallint": T.ShortType(),
    "bigint": T.LongType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "amount": RATE,
    "percent": PERCENT,
    "total": TOTAL,
}


def _schema(spec: str) -> T.StructType:
    """``name type, name type, ...``; every stored column is nullable in the file."""
    pairs = [part.split() for part in spec.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


SCHEMAS: dict[str, T.StructType] = {
    "plan_config": _schema(
        "config_key string, config_path string, config_scope string, "
        "loaded_value percent, standard_value percent, standard_source string, "
        "effective_date date, last_changed_by string, last_changed_utc timestamp"
    ),
    "member": _schema(
        "member_id string, lob string, coverage_eff_date date, coverage_term_date date, "
        "county_code string"
    ),
    "provider": _schema(
        "provider_id string, parent_provider_id string, provider_name string, npi string, "
        "provider_type string, participating_flag boolean, contract_eff_date date, "
        "contract_term_date date"
    ),
    "adjudication_rule": _schema(
        "rule_id string, rule_name string, rule_sequence smallint, config_key string"
    ),
    "benefit_category": _schema(
        "provider_type string, benefit_category string, auth_required_flag boolean, "
        "delegated_vendor string, auth_exempt_flag boolean"
    ),
    "fee_schedule": _schema(
        "procedure_code string, effective_date date, term_date date, schedule_rate amount"
    ),
    "claim": _schema(
        "claim_id string, member_id string, provider_id string, lob string, "
        "procedure_code string, modifier_list string, units smallint, "
        "service_from_date date, service_thru_date date, received_date date, "
        "adjudicated_date date, billed_amount amount, "
        "expected_allowed_amount amount, paid_amount amount, "
        "adjudication_status string"
    ),
    "prior_auth": _schema(
        "auth_id bigint, member_id string, provider_type string, auth_eff_date date, "
        "auth_thru_date date, auth_status string"
    ),
    "claim_denial": _schema(
        "claim_id string, rule_id string, denial_code string, denied_utc timestamp"
    ),
    "claim_rule_result": _schema(
        "claim_id string, rule_id string, rule_result string, evidence string"
    ),
    "claim_modifier": _schema("claim_id string, modifier_seq smallint, modifier_code string"),
    "claim_import": _schema(
        "raw_row_num bigint, claim_id string, member_id string, provider_id string, lob string, "
        "procedure_code string, modifier_list string, units string, service_from_raw string, "
        "service_thru_raw string, received_raw string, billed_raw string, "
        "source_file_name string, loaded_utc timestamp"
    ),
    "claim_reject": _schema(
        "source_file_name string, raw_row_num bigint, claim_id string, service_date date, "
        "reject_reason string, rejected_utc timestamp"
    ),
    "fact_claim_denial_daily": _schema(
        "service_date date, lob string, provider_type string, rule_id string, verdict string, "
        "claim_count bigint, denied_count bigint, billed_amount total, "
        "expected_allowed_amount total, paid_amount total, "
        "amount_at_risk total, partition_loaded_utc timestamp"
    ),
    "partition_log": _schema(
        "partition_date date, rows_written bigint, source_rows_read bigint, "
        "rejected_rows bigint, load_start_utc timestamp, load_end_utc timestamp, "
        "load_status string, load_message string"
    ),
}

#: Declared keys; see ``plans.quality.key_violations``.
PRIMARY_KEYS: dict[str, list[str]] = {
    "plan_config": ["config_key"],
    "member": ["member_id"],
    "provider": ["provider_id"],
    "adjudication_rule": ["rule_id"],
    "benefit_category": ["provider_type"],
    "fee_schedule": ["procedure_code", "effective_date"],
    "claim": ["claim_id"],
    "prior_auth": ["auth_id"],
    "claim_denial": ["claim_id"],
    "claim_rule_result": ["claim_id", "rule_id"],
    "claim_modifier": ["claim_id", "modifier_seq"],
    "claim_reject": ["source_file_name", "raw_row_num"],
    "fact_claim_denial_daily": ["service_date", "lob", "provider_type", "rule_id", "verdict"],
    "partition_log": ["partition_date"],
}

#: Columns that may be NULL; every other column is mandatory.
NULLABLE: dict[str, set[str]] = {
    "member": {"coverage_term_date"},
    "provider": {"parent_provider_id", "contract_term_date"},
    "adjudication_rule": {"config_key"},
    "benefit_category": {"delegated_vendor"},
    "fee_schedule": {"term_date"},
    "claim": {"modifier_list", "adjudicated_date", "expected_allowed_amount", "paid_amount"},
    "claim_rule_result": {"evidence"},
    "claim_reject": {"claim_id", "service_date"},
    "partition_log": {"load_message"},
}

#: (table, column) -> (parent table, parent column)
FOREIGN_KEYS: list[tuple[str, str, str, str]] = [
    ("provider", "parent_provider_id", "provider", "provider_id"),
    ("adjudication_rule", "config_key", "plan_config", "config_key"),
    ("claim", "member_id", "member", "member_id"),
    ("claim", "provider_id", "provider", "provider_id"),
    ("claim_denial", "claim_id", "claim", "claim_id"),
    ("claim_denial", "rule_id", "adjudication_rule", "rule_id"),
]


def columns(table: str) -> list[str]:
    return SCHEMAS[table].fieldNames()
