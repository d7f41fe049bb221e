"""Final SELECT per query key, over the definitions in ``oracle``."""

from __future__ import annotations

from samplemap.oracle import (
    AUTH_LABEL, CLAIM_COLUMNS, FILING_LABEL, GRID_LABELS, MONEY, UNDERPAID_LABEL,
    merged, pct, quoted, with_ctes,
)
from samplemap.queries import BACKFILL, CATCH_UP_DAY, GATE_DAY, GATE_DAYS

NUMBER = "CAST(substr(claim_id, 5) AS BIGINT)"
INDEX = "date_diff('day', DATE '1995-01-01', {0})"
FACT = (
    "service_date, lob, provider_type, rule_id, verdict, claim_count, denied_count, billed_amount, "
    "expected_allowed_amount, paid_amount, amount_at_risk"
)
LOG = "partition_date, rows_written, source_rows_read, rejected_rows, load_status, load_message"
HEALTH = (
    "partition_date, load_status, rows_written, source_rows_read, rejected_rows, reject_rate_pct, "
    "load_seconds, rolling_avg_rows, health_flag"
)
FAULTS = (
    "('LOAD FAILED', 'VOLUME DROP OVER 50 PCT', 'VOLUME SPIKE OVER 100 PCT', 'REJECT RATE OVER THRESHOLD')"
)
DEFECT = "'CONFIGURATION DEFECT'"
EXPOSURE = f"CAST(sum(CASE WHEN verdict = {DEFECT} THEN amount_at_risk ELSE 0 END) AS {MONEY})"
LAG = "date_diff('day', c.service_from_date, c.received_date)"
FILING = (
    f"c.denying_rule_id = 'R-060' AND p.participating_flag AND {LAG} <= 95"
)
SHORT = "p.provider_type = 'LTSS' AND c.adjudication_status = 'PAID' AND c.paid_amount < c.expected_allowed_amount"
RIDE = "c.denying_rule_id = 'R-050' AND p.provider_type = 'Transportation'"
CLAIM_PROVIDER = "e_claim AS c JOIN m_provider AS p ON p.provider_id = c.provider_id"
def measures(group: str = "", where: str = "true") -> str:
    def verdict(v: str) -> str:
        return f"sum(CASE WHEN verdict = {v} THEN denied_count ELSE 0 END)"

    correct, wrong = verdict("'CORRECT DENIAL'"), verdict(DEFECT)
    return f"""
        SELECT {group + ',' if group else ''} CAST(sum(claim_count) AS BIGINT) AS total_claims,
               CAST(sum(denied_count) AS BIGINT) AS denied_claims,
               CAST(sum(billed_amount) AS {MONEY}) AS billed, CAST(sum(paid_amount) AS {MONEY}) AS paid,
               CAST(sum(expected_allowed_amount) AS {MONEY}) AS expected_allowed, {EXPOSURE} AS exposure,
               CAST({correct} AS BIGINT) AS correct_denials, CAST({wrong} AS BIGINT) AS defect_driven_denials,
               {pct('sum(denied_count)', 'sum(claim_count)', 6)} AS denial_rate,
               {pct(wrong, 'sum(denied_count)', 6)} AS pct_denials_from_defects
        FROM w_fact WHERE {where} {'GROUP BY ' + group if group else ''}"""


def tests() -> str:
    """test number, name, expected, actual"""
    count = "(SELECT count(*) FROM {0})".format
    rows = [
        (1, "Claim count", "(SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem))",
         count("e_claim")),
        (2, "Claims still PENDING after adjudication", "0",
         count("e_claim WHERE adjudication_status = 'PENDING'")),
        (3, "DENIED claims without a ClaimDenial row", "0",
         count("e_claim WHERE adjudication_status = 'DENIED' "
               "AND claim_id NOT IN (SELECT claim_id FROM e_denial)")),
        (4, "ClaimDenial rows on a non-DENIED claim", "0",
         count("e_denial JOIN e_claim USING (claim_id) WHERE adjudication_status <> 'DENIED'")),
        (5, "Claims with more than one denial row", "0",
         count("(SELECT claim_id FROM e_denial GROUP BY claim_id HAVING count(*) > 1)")),
        (6, "Claims without a full 7-rule trace", "0",
         count("(SELECT claim_id FROM e_trace GROUP BY claim_id HAVING count(*) <> 7)")),
        (7, "Rule-sequence violations in the trace", "0",
         count("e_trace AS t JOIN m_rule AS r USING (rule_id) JOIN e_denial AS d ON d.claim_id = t.claim_id "
               "JOIN m_rule AS e ON e.rule_id = d.rule_id "
               "WHERE (r.rule_sequence > e.rule_sequence AND rule_result <> 'SKIP') "
               "OR (r.rule_sequence < e.rule_sequence AND rule_result = 'FAIL')")),
        (8, "dw claim count reconciles to dbo.Claim", count("e_claim"),
         "(SELECT CAST(coalesce(sum(claim_count), 0) AS BIGINT) FROM w_fact)"),
        (9, "dw billed amount reconciles to dbo.Claim",
         f"(SELECT CAST(sum(billed_amount) AS {MONEY}) FROM e_claim)",
         f"(SELECT CAST(sum(billed_amount) AS {MONEY}) FROM w_fact)"),
        (10, "Service dates with no partition log row", "0",
         count("(SELECT DISTINCT service_from_date FROM e_claim WHERE service_from_date NOT IN "
               "(SELECT partition_date FROM w_log WHERE load_status IN ('SUCCESS', 'RELOADED')))")),
        (11, "Failed partitions", "0", count("w_log WHERE load_status = 'FAILED'")),
        (12, "Configuration keys where loaded <> standard", "3",
         count("m_config WHERE loaded_value <> standard_value")),
        (13, "R-070 pricing failures that denied a claim", "0", count("e_denial WHERE rule_id = 'R-070'")),
        (14, "Non-LTSS provider types paid below expected", "0",
         "(SELECT count(DISTINCT p.provider_type) FROM e_claim AS c JOIN m_provider AS p "
         "ON p.provider_id = c.provider_id WHERE adjudication_status = 'PAID' "
         "AND paid_amount < expected_allowed_amount AND p.provider_type <> 'LTSS')"),
    ]
    return " UNION ALL ".join(
        f"SELECT {number} AS test_num, {quoted(name)} AS test_name, CAST({expected} AS VARCHAR) AS expected, "
        f"CAST({actual} AS VARCHAR) AS actual"
        for number, name, expected, actual in rows
    )


GRID = f"SELECT *, CASE WHEN expected = actual THEN 'PASS' ELSE 'FAIL' END AS result FROM ({tests()})"


def key_checks() -> str:
    tables = {
        "claim": ("s_after_b", ["claim_id"],
                  ["claim_id", "member_id", "provider_id", "lob", "procedure_code", "units",
                   "service_from_date", "service_thru_date", "received_date", "billed_amount",
                   "adjudication_status"]),
        "claim_modifier": ("s_modifier", ["claim_id", "modifier_seq"],
                           ["claim_id", "modifier_seq", "modifier_code"]),
        "claim_reject": ("s_reject", ["source_file_name", "raw_row_num"],
                         ["source_file_name", "raw_row_num", "reject_reason"]),
        "member": ("m_member", ["member_id"], ["member_id", "lob", "coverage_eff_date", "county_code"]),
        "provider": ("m_provider", ["provider_id"],
                     ["provider_id", "provider_name", "npi", "provider_type", "participating_flag",
                      "contract_eff_date"]),
    }
    line = "SELECT {0} AS table_name, {1} AS check_name, (SELECT count(*) FROM {2}) AS violations".format
    parts = []
    for name, (source, key, required) in tables.items():
        keys = ", ".join(key)
        parts.append(line(quoted(name), quoted(f"unique {keys}"),
                          f"(SELECT 1 FROM {source} GROUP BY {keys} HAVING count(*) > 1)"))
        parts += [
            line(quoted(name), quoted(f"not null {c}"), f"{source} WHERE {c} IS NULL") for c in required
        ]
    # The stamp of a reject is set by the engine and never NULL.
    parts.append("SELECT 'claim_reject', 'not null rejected_utc', 0")
    for child, source, column, parent, target in [
        ("provider", "m_provider", "parent_provider_id", "provider", "provider_id"),
        ("claim", "s_after_b", "member_id", "member", "member_id"),
        ("claim", "s_after_b", "provider_id", "provider", "provider_id"),
    ]:
        parts.append(line(
            quoted(child), quoted(f"{column} references {parent}"),
            f"{source} WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT {target} FROM m_{parent})"))
    return " UNION ALL ".join(parts)


MODIFIERS = """
    SELECT claim_id, CAST(place AS SMALLINT) AS modifier_seq, trim(entry) AS modifier_code
    FROM (SELECT claim_id, unnest(string_split(coalesce(modifier_list, ''), '|')) AS entry,
                 generate_subscripts(string_split(coalesce(modifier_list, ''), '|'), 1) AS place
          FROM {0})
    WHERE length(trim(entry)) = 2"""
# Modifiers of a claim that came again in the second file are replaced, even by nothing.
ALL_MODIFIERS = f"""
    SELECT * FROM ({MODIFIERS.format('s_good_a')})
    WHERE claim_id NOT IN (SELECT claim_id FROM s_label_b WHERE claim_id IS NOT NULL)
    UNION ALL {MODIFIERS.format('s_good_b')}"""

_SELECTS: dict[str, str] = {
    "staging_scan": "SELECT * FROM s_raw WHERE source_file_name = 'claims_a'",
    "normalize_ids": "SELECT raw_row_num, claim_id, member_id, provider_id, lob, procedure_code, modifier_list "
                     "FROM s_normalized",
    "parse_units": "SELECT raw_row_num, units FROM s_normalized",
    "parse_dates": "SELECT raw_row_num, service_from_date, service_thru_date, received_date FROM s_normalized",
    "parse_currency": "SELECT raw_row_num, billed_amount FROM s_normalized",
    "dedupe_latest": """
        SELECT 'claims_a' AS source_file_name, claim_id, raw_row_num FROM s_label_a WHERE claim_id IS NOT NULL AND arrival_rank = 1
        UNION ALL
        SELECT 'claims_b', claim_id, raw_row_num FROM s_label_b WHERE claim_id IS NOT NULL AND arrival_rank = 1""",
    "validate_rejects": """
        SELECT 'claims_a' AS source_file_name, raw_row_num, claim_id, reject_reason FROM s_label_a
        UNION ALL SELECT 'claims_b', raw_row_num, claim_id, reject_reason FROM s_label_b""",
    "reject_append_once": """
        SELECT source_file_name, raw_row_num, claim_id, service_from_date AS service_date,
               CASE WHEN raw_row_num % 2 = 0 THEN 'EARLIER RUN' ELSE reject_reason END AS reject_reason
        FROM s_label_a WHERE reject_reason IS NOT NULL
        UNION ALL
        SELECT source_file_name, raw_row_num, claim_id, service_from_date AS service_date,
               CASE WHEN raw_row_num % 2 = 0 THEN 'EARLIER RUN' ELSE reject_reason END AS reject_reason
        FROM s_label_b WHERE reject_reason IS NOT NULL""",
    "merge_claims": merged("e_claim", "s_good_b"),
    "modifier_explode": f"""
        SELECT 'claims_a' AS source_file_name, * FROM ({MODIFIERS.format("s_good_a")})
        UNION ALL SELECT 'claims_b', * FROM ({MODIFIERS.format("s_good_b")})""",
    "cleanse_accepted": f"SELECT {CLAIM_COLUMNS} FROM s_after_b",
    "cleanse_rejects": "SELECT * FROM s_reject",
    "cleanse_modifiers": ALL_MODIFIERS,
    "config_reference": "SELECT * FROM m_config",
    "claim_enrich": """
        SELECT c.claim_id, c.lob, m.coverage_term_date, p.provider_type, p.participating_flag,
               p.contract_eff_date, b.auth_required_flag, b.delegated_vendor
        FROM m_claim AS c, m_member AS m, m_provider AS p, m_benefit AS b
        WHERE m.member_id = c.member_id AND p.provider_id = c.provider_id AND b.provider_type = p.provider_type""",
    "config_pct_lookup": """
        SELECT c.claim_id, 'FeeSchedulePct_' || p.provider_type AS config_key,
               k.loaded_value AS price_pct_loaded, k.standard_value AS price_pct_standard
        FROM m_claim AS c JOIN m_provider AS p USING (provider_id)
        LEFT JOIN m_config AS k ON k.config_key = 'FeeSchedulePct_' || p.provider_type""",
    "asof_fee_outer": "SELECT claim_id, procedure_code, service_from_date, schedule_rate FROM e_rated",
    "asof_fee_inner": "SELECT claim_id, procedure_code, service_from_date, schedule_rate FROM e_rated "
                      "WHERE schedule_rate IS NOT NULL",
    "auth_missing_flag": """
        SELECT c.claim_id, p.provider_type, NOT EXISTS (
                   SELECT 1 FROM m_auth AS a WHERE a.member_id = c.member_id AND a.provider_type = p.provider_type
                   AND a.auth_status = 'APPROVED' AND a.auth_eff_date <= c.service_from_date
                   AND a.auth_thru_date >= c.service_from_date) AS auth_missing
        FROM m_claim AS c JOIN m_provider AS p USING (provider_id)
        JOIN m_benefit AS b ON b.provider_type = p.provider_type AND b.auth_required_flag""",
    "duplicate_submissions": """
        SELECT claim_id, member_id, provider_id, procedure_code, service_from_date, submission_seq FROM (
            SELECT *, CAST(row_number() OVER (w ORDER BY claim_id) AS INTEGER) AS submission_seq,
                   count(*) OVER w AS copies
            FROM m_claim WINDOW w AS (PARTITION BY member_id, provider_id, procedure_code, service_from_date))
        WHERE copies > 1""",
    "rule_evaluation": "SELECT * FROM e_eval",
    "claim_outcome": "SELECT claim_id, denying_rule_id, denial_code, allowed_loaded, allowed_standard FROM e_outcome",
    "claim_denials": "SELECT * FROM e_denial",
    "rule_trace": "SELECT * FROM e_trace",
    "adjudicated_claims": f"SELECT {CLAIM_COLUMNS} FROM e_claim",
    "outcome_write_back": f"SELECT {CLAIM_COLUMNS} FROM e_claim",
    "priced_claims": "SELECT claim_id, provider_type, expected_allowed FROM w_priced",
    "classified_claims": "SELECT claim_id, provider_type, rule_id, verdict FROM w_classified",
    "daily_fact": f"SELECT {FACT} FROM w_fact",
    "stored_daily_fact": f"SELECT {FACT} FROM w_fact",
    "fact_partition_reload": f"""
        SELECT * REPLACE (claim_count + CASE WHEN {INDEX.format('service_date')} % 7 = 0 THEN 1 ELSE 0 END
                          AS claim_count)
        FROM w_fact WHERE {INDEX.format('service_date')} % 14 <> 0""",
    "partition_log_merge": f"""
        SELECT coalesce(l.partition_date, n.d) AS partition_date,
               CASE WHEN n.d IS NULL OR (n.failed AND l.partition_date IS NOT NULL) THEN l.rows_written
                    ELSE n.seen * 2 END AS rows_written,
               CASE WHEN n.d IS NULL OR (n.failed AND l.partition_date IS NOT NULL) THEN l.source_rows_read
                    ELSE n.seen END AS source_rows_read,
               CASE WHEN n.d IS NULL OR (n.failed AND l.partition_date IS NOT NULL) THEN l.rejected_rows
                    ELSE 1 END AS rejected_rows,
               CASE WHEN n.d IS NULL THEN l.load_status WHEN n.failed THEN 'FAILED'
                    WHEN l.load_status IN ('SUCCESS', 'RELOADED') THEN 'RELOADED' ELSE 'SUCCESS' END AS load_status,
               CASE WHEN n.d IS NULL THEN l.load_message WHEN n.failed THEN 'second run' END AS load_message
        FROM w_log AS l FULL OUTER JOIN (
            SELECT service_from_date AS d, count(*) AS seen, {INDEX.format('service_from_date')} % 3 = 0 AS failed
            FROM m_claim WHERE {INDEX.format('service_from_date')} % 5 = 0 GROUP BY service_from_date) AS n
          ON n.d = l.partition_date""",
    "load_dates_results": f"""
        SELECT partition_date, (SELECT count(*) FROM w_fact WHERE service_date = partition_date) AS rows_written,
               (SELECT count(*) FROM m_claim WHERE service_from_date = partition_date) AS source_rows_read,
               (SELECT count(*) FROM s_reject WHERE service_date = partition_date) AS rejected_rows,
               'SUCCESS' AS load_status, CAST(NULL AS VARCHAR) AS load_message
        FROM w_calendar WHERE {INDEX.format('partition_date')} % 3 = 0""",
    "backfill_pending_dates": f"""
        SELECT d AS partition_date FROM (
            SELECT CAST(unnest(generate_series(DATE '{BACKFILL[0]}', DATE '{BACKFILL[1]}', INTERVAL 1 DAY)) AS DATE)
                   AS d)
        WHERE d NOT IN (SELECT partition_date FROM w_log WHERE load_status IN ('SUCCESS', 'RELOADED'))""",
    "catch_up_dates": f"""
        SELECT d AS partition_date FROM (
            SELECT CAST(DATE '{CATCH_UP_DAY}' - CAST(unnest(range(1, 9)) AS INTEGER) AS DATE) AS d)
        WHERE d NOT IN (SELECT partition_date FROM w_log WHERE load_status IN ('SUCCESS', 'RELOADED'))""",
    "date_spine": """
        SELECT CAST(unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)),
               INTERVAL 1 DAY)) AS DATE) AS partition_date FROM orders""",
    "calendar_from_bounds": "SELECT partition_date FROM w_calendar",
    "number_spine": "SELECT unnest(range(1, (SELECT count(*) FROM orders) + 1)) AS n",
    "pipeline_health": f"SELECT {HEALTH} FROM w_health",
    "rolling_volume_baseline": "SELECT partition_date, rows_written, rolling_avg_rows FROM w_health",
    "unhealthy_partitions": f"SELECT {HEALTH} FROM w_health WHERE health_flag <> 'OK'",
    "health_summary": """
        SELECT health_flag, count(*) AS partition_count, min(partition_date) AS first_date,
               max(partition_date) AS last_date FROM w_health GROUP BY health_flag""",
    "health_gate_detail": f"""
        SELECT count(*) AS bad_partitions, coalesce(string_agg(
                   strftime(partition_date, '%Y-%m-%d') || ' ' || health_flag || '; ', ''
                   ORDER BY partition_date), '') AS detail
        FROM w_health WHERE partition_date >= DATE '{GATE_DAY}' - {GATE_DAYS} AND health_flag IN {FAULTS}""",
    "config_register": """
        SELECT config_key, config_path, config_scope, loaded_value, standard_value,
               CASE WHEN loaded_value = standard_value THEN 'MATCHES STANDARD' ELSE 'DEFECT' END AS config_status,
               rule_id, rule_name, standard_source
        FROM m_config LEFT JOIN m_rule USING (config_key)""",
    "denial_mix_by_rule": f"""
        SELECT f.rule_id, coalesce(r.rule_name, 'No denial — claim paid') AS rule_name,
               CAST(sum(claim_count) AS BIGINT) AS claims,
               CAST(sum(CASE WHEN verdict = 'CORRECT DENIAL' THEN claim_count ELSE 0 END) AS BIGINT)
                   AS correct_denials,
               CAST(sum(CASE WHEN verdict = {DEFECT} THEN claim_count ELSE 0 END) AS BIGINT) AS defect_driven,
               {EXPOSURE} AS exposure_usd
        FROM w_fact AS f LEFT JOIN m_rule AS r USING (rule_id) GROUP BY ALL""",
    "denial_mix_by_segment": f"""
        SELECT lob, provider_type, CAST(sum(claim_count) AS BIGINT) AS claims,
               CAST(sum(denied_count) AS BIGINT) AS denied,
               {pct('sum(denied_count)', 'sum(claim_count)')} AS denial_rate_pct, {EXPOSURE} AS exposure_usd
        FROM w_fact GROUP BY lob, provider_type HAVING sum(claim_count) > 0""",
    "verdict_distribution": f"""
        SELECT verdict, CAST(claims AS BIGINT) AS claims,
               {pct('claims', '(SELECT sum(claim_count) FROM w_fact)')} AS pct_of_claims, expected_minus_paid
        FROM (SELECT verdict, sum(claim_count) AS claims, CAST(sum(amount_at_risk) AS {MONEY}) AS expected_minus_paid
              FROM w_fact GROUP BY verdict)""",
    "exposure_timely_filing": f"""
        SELECT '{FILING_LABEL}' AS defect, count(*) AS recoverable_claims,
               CAST(sum(c.expected_allowed_amount) AS {MONEY}) AS exposure_usd,
               CAST(min({LAG}) AS INTEGER) AS min_filing_lag, CAST(max({LAG}) AS INTEGER) AS max_filing_lag
        FROM {CLAIM_PROVIDER} WHERE {FILING}""",
    "exposure_underpayment": f"""
        SELECT '{UNDERPAID_LABEL}' AS defect, count(*) AS underpaid_claims, CAST(sum(c.units) AS BIGINT) AS total_units,
               CAST(sum(c.paid_amount) AS {MONEY}) AS paid_usd,
               CAST(sum(c.expected_allowed_amount) AS {MONEY}) AS should_have_paid_usd,
               CAST(sum(c.expected_allowed_amount - c.paid_amount) AS {MONEY}) AS exposure_usd
        FROM {CLAIM_PROVIDER} WHERE {SHORT}""",
    "exposure_auth_exempt": f"""
        SELECT '{AUTH_LABEL}' AS defect, count(*) AS recoverable_claims,
               CAST(sum(c.expected_allowed_amount) AS {MONEY}) AS exposure_usd,
               max(b.delegated_vendor) AS delegated_to
        FROM {CLAIM_PROVIDER} JOIN m_benefit AS b ON b.provider_type = p.provider_type WHERE {RIDE}""",
    "exposure_by_defect": f"""
        SELECT defect, claims, CAST(usd AS {MONEY}) AS exposure_usd,
               {pct('usd', 'sum(usd) OVER ()')} AS pct_of_total
        FROM (SELECT {quoted(GRID_LABELS['filing'])} AS defect, count(*) AS claims,
                     sum(c.expected_allowed_amount) AS usd FROM {CLAIM_PROVIDER} WHERE {FILING}
              UNION ALL
              SELECT {quoted(GRID_LABELS['underpaid'])}, count(*), sum(c.expected_allowed_amount - c.paid_amount)
              FROM {CLAIM_PROVIDER} WHERE {SHORT}
              UNION ALL
              SELECT {quoted(GRID_LABELS['auth'])}, count(*), sum(c.expected_allowed_amount)
              FROM {CLAIM_PROVIDER} WHERE {RIDE})""",
    "provider_exposure_ranked": f"""
        SELECT provider_type, CAST(rank() OVER (PARTITION BY provider_type ORDER BY usd DESC) AS INTEGER)
                   AS rank_in_type,
               provider_id, provider_name, CASE WHEN participating_flag THEN 'PAR' ELSE 'NON-PAR' END AS status,
               denied_claims, CAST(usd AS {MONEY}) AS exposure_usd,
               {pct('usd', 'sum(usd) OVER (PARTITION BY provider_type)')} AS pct_of_type_exposure
        FROM (SELECT p.provider_type, p.provider_id, p.provider_name, p.participating_flag,
                     count(*) AS denied_claims, sum(c.expected_allowed_amount) AS usd
              FROM {CLAIM_PROVIDER} WHERE c.denying_rule_id IS NOT NULL GROUP BY ALL)
        WHERE usd > 0""",
    "provider_hierarchy": "SELECT node_id, root_id, depth FROM m_tree",
    "provider_rollup": f"""
        SELECT t.root_id AS root_provider_id, r.provider_name AS root_provider_name,
               max(t.depth) AS hierarchy_depth, count(DISTINCT t.node_id) AS billing_entities,
               count(*) AS denied_claims, CAST(sum(c.expected_allowed_amount) AS {MONEY}) AS rolled_up_exposure
        FROM m_tree AS t JOIN m_provider AS r ON r.provider_id = t.root_id
        JOIN e_claim AS c ON c.provider_id = t.node_id
        WHERE c.denying_rule_id IS NOT NULL GROUP BY t.root_id, r.provider_name
        HAVING sum(c.expected_allowed_amount) > 0""",
    "what_if_delta": f"""
        SELECT metric, b_n AS claims_before, a_n AS claims_after, a_n - b_n AS claims_delta,
               CAST(b_usd AS {MONEY}) AS amount_before, CAST(a_usd AS {MONEY}) AS amount_after,
               CAST(a_usd - b_usd AS {MONEY}) AS amount_delta
        FROM (SELECT 'Denied claims' AS metric, count(*) AS b_n, sum(expected_allowed_amount) AS b_usd
              FROM e_claim WHERE adjudication_status = 'DENIED'
              UNION ALL SELECT 'Paid claims', count(*), sum(paid_amount)
              FROM e_claim WHERE adjudication_status = 'PAID')
        JOIN (SELECT 'Denied claims' AS metric, count(*) AS a_n, coalesce(sum(expected_allowed_amount), 0) AS a_usd
              FROM e_fixed_claim WHERE adjudication_status = 'DENIED'
              UNION ALL SELECT 'Paid claims', count(*), sum(paid_amount)
              FROM e_fixed_claim WHERE adjudication_status = 'PAID') USING (metric)""",
    "what_if_no_side_effects": """
        SELECT (SELECT count(*) FROM m_config WHERE loaded_value <> standard_value) AS config_defects_still_present,
               (SELECT count(*) FROM e_claim WHERE adjudication_status = 'DENIED') AS denied_claims_restored""",
    "denied_without_denial": f"""
        SELECT claim_id FROM e_claim WHERE adjudication_status = 'DENIED' AND claim_id NOT IN (
            SELECT claim_id FROM e_denial WHERE {NUMBER} % 50 <> 0)""",
    "rule_sequence_violations": """
        SELECT claim_id, rule_id, 'PASS' AS rule_result FROM e_trace
        WHERE rule_result = 'SKIP' AND CAST(substr(claim_id, 5) AS BIGINT) % 10 = 0""",
    "assertion_grid": GRID,
    "assertion_summary": f"""
        SELECT CAST(count(*) FILTER (result = 'PASS') AS VARCHAR) || ' of ' || CAST(count(*) AS VARCHAR)
               || ' tests passed' AS test_summary FROM ({GRID})""",
    "key_violations": key_checks().replace("s_modifier", f"({ALL_MODIFIERS})"),
    "row_count_expectations": """
        SELECT metric, actual, CAST(expected AS BIGINT) AS expected,
               CASE WHEN expected IS NULL THEN 'INFO' WHEN actual = expected THEN 'OK' ELSE 'CHECK' END AS status
        FROM (SELECT 'Members' AS metric, (SELECT count(*) FROM m_member) AS actual,
                     (SELECT count(*) FROM customer) AS expected
              UNION ALL SELECT 'Providers', (SELECT count(*) FROM m_provider), (SELECT count(*) FROM supplier)
              UNION ALL SELECT 'Claims', (SELECT count(*) FROM e_claim), (SELECT count(*) FROM lineitem)
              UNION ALL SELECT 'Claims PENDING',
                     (SELECT count(*) FROM e_claim WHERE adjudication_status = 'PENDING'), 0
              UNION ALL SELECT 'Denied claims', (SELECT count(*) FROM e_denial), NULL
              UNION ALL SELECT 'Rule trace rows', (SELECT count(*) FROM e_trace), NULL
              UNION ALL SELECT 'Warehouse rows', (SELECT count(*) FROM w_fact), NULL
              UNION ALL SELECT 'Partitions loaded',
                     (SELECT count(*) FROM w_log WHERE load_status IN ('SUCCESS', 'RELOADED')), NULL
              UNION ALL SELECT 'Partitions FAILED',
                     (SELECT count(*) FROM w_log WHERE load_status = 'FAILED'), 0)""",
    "dim_date": """
        SELECT d AS date, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month_num,
               strftime(d, '%b %Y') AS month_name, 'Q' || quarter(d) || ' ' || year(d) AS quarter_name,
               CAST(date_trunc('week', d) AS DATE) AS week_start
        FROM (SELECT CAST(unnest(generate_series(min(service_date), max(service_date), INTERVAL 1 DAY)) AS DATE) AS d
              FROM w_fact)""",
    "kpi_measures": measures(),
    "kpi_measures_by_lob": measures("lob", "provider_type = 'LTSS'"),
    "config_status": """
        SELECT config_key, config_path, loaded_value, standard_value, standard_source,
               CASE WHEN loaded_value <> standard_value THEN 'DEFECT' ELSE 'OK' END AS config_status FROM m_config""",
    "rule_dimension": """
        SELECT d.rule_id, d.rule_name, d.rule_sequence, d.config_key, u.fact_rows, u.claims
        FROM (SELECT * FROM m_rule UNION ALL
              SELECT 'R-000', 'No denial — claim paid', CAST(0 AS SMALLINT), NULL) AS d
        LEFT JOIN (SELECT rule_id, count(*) AS fact_rows, CAST(sum(claim_count) AS BIGINT) AS claims
                   FROM w_fact GROUP BY rule_id) AS u USING (rule_id)""",
    "denials_by_rule_verdict": """
        SELECT coalesce(r.rule_name, 'No denial — claim paid') AS rule_name, verdict,
               CAST(sum(denied_count) AS BIGINT) AS denied_claims
        FROM w_fact AS f LEFT JOIN m_rule AS r USING (rule_id) GROUP BY ALL""",
    "exposure_by_provider_type": f"SELECT provider_type, {EXPOSURE} AS exposure FROM w_fact GROUP BY provider_type",
    "exposure_by_month": f"""
        SELECT CAST(year(service_date) AS INTEGER) AS year, CAST(month(service_date) AS INTEGER) AS month_num,
               strftime(service_date, '%b %Y') AS month_name, {EXPOSURE} AS exposure FROM w_fact GROUP BY ALL""",
    "unhealthy_count": "SELECT count(*) AS unhealthy_partitions FROM w_health WHERE health_flag <> 'OK'",
    "volume_vs_baseline": "SELECT partition_date, rows_written, rolling_avg_rows FROM w_health",
}


ANSWERS: dict[str, str] = {key: with_ctes(select) for key, select in _SELECTS.items()}
