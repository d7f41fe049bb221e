"""Upserts as pure snapshot transforms."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitlens.schemas import SCHEMAS, columns

#: A difference in one of these changes the price, so the claim is adjudicated again.
PRICE_COLUMNS = [
    "billed_amount",
    "received_date",
    "units",
    "procedure_code",
    "service_from_date",
    "service_thru_date",
]
_CARRIED = [*PRICE_COLUMNS, "modifier_list"]
_RESULTS = ["adjudicated_date", "paid_amount", "expected_allowed_amount"]


def _old(name: str) -> Column:
    return F.col(f"old.{name}")


def _new(name: str) -> Column:
    return F.col(f"new.{name}")


def merge_claims(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """Insert new claims; replace the priced fields of a claim only when one of them differs.

    Both sides hold a claim once.  A changed claim goes back to PENDING and loses its
    adjudication result; member, provider and line of business are never updated.
    """
    differs = reduce(lambda a, b: a | b, [_old(c) != _new(c) for c in PRICE_COLUMNS])
    inserted = _old("claim_id").isNull()
    # A NULL comparison is not a difference.
    changed = _new("claim_id").isNotNull() & ~inserted & F.coalesce(differs, F.lit(False))

    def merged(name: str) -> Column:
        if name in _RESULTS:
            value = F.when(~inserted & ~changed, _old(name))
        elif name == "adjudication_status":
            value = F.when(inserted | changed, F.lit("PENDING")).otherwise(_old(name))
        elif name in _CARRIED:
            value = F.when(inserted | changed, _new(name)).otherwise(_old(name))
        else:
            value = F.when(inserted, _new(name)).otherwise(_old(name))
        return value.cast(SCHEMAS["claim"][name].dataType).alias(name)

    joined = current.alias("old").join(
        incoming.alias("new"), _old("claim_id") == _new("claim_id"), "full_outer"
    )
    return joined.select(*[merged(c) for c in columns("claim")])


LOADED = ["SUCCESS", "RELOADED"]


def merge_partition_log(log: DataFrame, results: DataFrame) -> DataFrame:
    """Fold load results into the log, one row per partition date.

    ``results`` has the log's columns with ``load_status`` SUCCESS or FAILED.  A success
    over an earlier good load is a RELOADED; a failure keeps the counts and the start
    time of the row it hits and only replaces the end, the status and the message.
    """
    untouched = _new("partition_date").isNull()
    failed = _new("load_status") == "FAILED"
    had_row = _old("partition_date").isNotNull()
    keep = untouched | (failed & had_row)
    status = (
        F.when(untouched, _old("load_status"))
        .when(failed, F.lit("FAILED"))
        .when(_old("load_status").isin(LOADED), F.lit("RELOADED"))
        .otherwise(F.lit("SUCCESS"))
    )

    def merged(name: str) -> Column:
        if name == "partition_date":
            value = F.coalesce(_old(name), _new(name))
        elif name == "load_status":
            value = status
        elif name in ("load_end_utc", "load_message"):
            value = F.when(untouched, _old(name)).otherwise(_new(name))
        else:
            value = F.when(keep, _old(name)).otherwise(_new(name))
        return value.alias(name)

    joined = log.alias("old").join(
        results.alias("new"), _old("partition_date") == _new("partition_date"), "full_outer"
    )
    return joined.select(*[merged(c) for c in columns("partition_log")])
