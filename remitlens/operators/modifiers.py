"""Pipe-delimited modifier lists as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def explode_modifiers(claims: DataFrame) -> DataFrame:
    """(claim_id, modifier_seq, modifier_code); the sequence is the place in the list, from 1.

    Only two-character entries are modifiers; skipped entries still count for the place.
    """
    parts = F.split(F.coalesce("modifier_list", F.lit("")), r"\|")
    return (
        claims.select("claim_id", F.posexplode(parts).alias("place", "raw"))
        .withColumn("modifier_code", F.trim("raw"))
        .filter(F.length("modifier_code") == 2)
        .select(
            "claim_id", (F.col("place") + 1).cast("smallint").alias("modifier_seq"), "modifier_code"
        )
    )


def replace_modifiers(
    current: DataFrame, arrived: DataFrame, accepted: DataFrame
) -> DataFrame:
    """Drop the modifiers of every claim that arrived, then add those of the accepted ones.

    A claim whose resubmission was rejected therefore ends without modifiers.
    """
    kept = current.join(arrived.select("claim_id"), "claim_id", "left_anti")
    return kept.unionByName(explode_modifiers(accepted))
