"""Registered queries against their SQL on the smallest driver tables."""

import re
from pathlib import Path

import pytest

import __spark_entry__ as contract
from samplemap.compare import duck, duck_rows, spark_rows

SF_DIR = "/root/testdata/sf0.001"
#: A cross-section; ``python -m samplemap.compare`` runs all of them.
KEYS = [
    "cleanse_accepted", "cleanse_rejects", "rule_trace", "daily_fact", "duplicate_submissions",
    "auth_missing_flag", "asof_fee_outer", "pipeline_health", "what_if_delta", "provider_rollup",
    "partition_log_merge", "exposure_by_defect",
]

needs_data = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="driver tables not present")


def test_every_query_has_sql():
    """Every query of the claim engine has its SQL; the text package's keys are tested in its own folder."""
    from samplemap.answers import ANSWERS
    from samplemap.queries import QUERIES

    assert set(QUERIES) == set(ANSWERS)
    assert set(QUERIES) <= set(contract.queries()) and set(ANSWERS) <= set(contract.oracle_sql())


@needs_data
@pytest.mark.parametrize("key", KEYS)
def test_query_equals_sql(spark, key):
    names, got = spark_rows(contract.queries()[key](spark, SF_DIR))
    want_names, want, _ = duck_rows(duck(SF_DIR), contract.oracle_sql()[key])
    assert names == want_names and got == want and got


@needs_data
def test_entry(spark):
    assert contract.entry(spark).count() == 3


def test_no_python_functions_and_no_local_checkpoints():
    for path in Path(__file__).parents[1].glob("remitlens/**/*.py"):
        text = path.read_text()
        assert not re.search(r"\b(udf|pandas_udf|localCheckpoint|crossJoin)\(", text), path
