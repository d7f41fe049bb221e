"""Effective-dated rate lookup.

Versions of a rate may overlap and an ended version can lie on top of an open one, so
"latest effective version still in force" is not a simple next-version boundary.  The
small rate table is first rewritten as gap-aware, non-overlapping segments with the
winning rate of each; a claim then matches at most one segment and the lookup is a
plain equi-join with a date range, evaluated in generated code and free of fan-out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rate_segments(fees: DataFrame) -> DataFrame:
    """(procedure_code, seg_start, seg_end, schedule_rate); ``seg_end`` is inclusive or NULL.

    The array per code holds one entry per effective date (the table's key), so it is
    bounded by the calendar and not by the number of claims.
    """
    versions = fees.groupBy("procedure_code").agg(
        # Latest effective date first, so the first version in force wins.
        F.sort_array(
            F.collect_list(F.struct("effective_date", "term_date", "schedule_rate")), asc=False
        ).alias("versions"),
    )
    starts = F.transform("versions", lambda v: v["effective_date"])
    restarts = F.transform(
        F.filter("versions", lambda v: v["term_date"].isNotNull()),
        lambda v: F.date_add(v["term_date"], 1),
    )
    cuts = F.array_sort(F.array_distinct(F.concat(starts, restarts)))

    def segment(cut, position):
        winner = F.try_element_at(
            F.filter(
                "versions",
                lambda v: (v["effective_date"] <= cut)
                & (v["term_date"].isNull() | (v["term_date"] >= cut)),
            ),
            F.lit(1),
        )
        next_cut = F.try_element_at(F.col("cuts"), position + 2)
        return F.struct(
            cut.alias("seg_start"),
            F.date_sub(next_cut, 1).alias("seg_end"),
            winner["schedule_rate"].alias("schedule_rate"),
        )

    return (
        versions.withColumn("cuts", cuts)
        .select("procedure_code", F.inline(F.transform("cuts", segment)))
        .filter(F.col("schedule_rate").isNotNull())
    )


def asof_rate(
    df: DataFrame, fees: DataFrame, how: str = "left", on_date: str = "service_from_date"
) -> DataFrame:
    """Add ``schedule_rate`` in force on ``on_date``; ``how='inner'`` drops rows without one."""
    seg = rate_segments(fees).alias("seg")
    matches = (
        (F.col("claim.procedure_code") == F.col("seg.procedure_code"))
        & (F.col("seg.seg_start") <= F.col(f"claim.{on_date}"))
        & (F.col("seg.seg_end").isNull() | (F.col("seg.seg_end") >= F.col(f"claim.{on_date}")))
    )
    return df.alias("claim").join(seg, matches, how).select("claim.*", "seg.schedule_rate")
