"""Append-once ledger of rejected raw rows."""

from __future__ import annotations

from pyspark.sql import DataFrame

LEDGER_KEY = ["source_file_name", "raw_row_num"]


def not_in_ledger(df: DataFrame, ledger: DataFrame) -> DataFrame:
    """Rows whose (file, row) was never rejected before."""
    return df.join(ledger.select(*LEDGER_KEY), LEDGER_KEY, "left_anti")


def append_rejects(new_rejects: DataFrame, ledger: DataFrame) -> DataFrame:
    """The ledger plus those new rejects it does not hold yet."""
    return ledger.unionByName(
        not_in_ledger(new_rejects, ledger).select(*ledger.columns), allowMissingColumns=False
    )
