"""Does any approved authorization cover the date of service?

Comparing every claim of a member with every authorization of that member would be a
product inside the group.  Instead each authorization becomes bits in fixed 60-day
blocks of the calendar, the bits of a (member, type, block) are OR-ed with a partial
aggregate, and a claim tests one bit of at most one matching row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_DAYS = 60


def _day_number(day: Column) -> Column:
    return F.unix_date(day).cast("bigint")


def _block(day_number: Column) -> Column:
    return F.floor(day_number / F.lit(BLOCK_DAYS)).cast("int")


def _low_bits(n: Column) -> Column:
    """A word with the ``n`` lowest bits set."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), n.cast("int")) - F.lit(1)


def coverage_blocks(auths: DataFrame, first_day: Column, last_day: Column) -> DataFrame:
    """One row per (member_id, provider_type, block) with the covered days as bits.

    Authorizations are clipped to ``first_day``..``last_day``, so an open-ended one
    never unfolds past the claims it could cover.  One without a first or last date
    covers nothing, and without any claim there is nothing to cover.
    """
    dated = F.col("auth_eff_date").isNotNull() & F.col("auth_thru_date").isNotNull()
    clipped = (
        auths.filter((F.col("auth_status") == "APPROVED") & dated & first_day.isNotNull())
        .withColumn("lo", _day_number(F.greatest("auth_eff_date", first_day)))
        .withColumn("hi", _day_number(F.least("auth_thru_date", last_day)))
        .filter("lo <= hi")
    )
    unfolded = clipped.select(
        "member_id",
        "provider_type",
        "lo",
        "hi",
        F.explode(F.sequence(_block(F.col("lo")), _block(F.col("hi")))).alias("block"),
    )
    base = F.col("block").cast("bigint") * BLOCK_DAYS
    first_bit = F.greatest(F.col("lo") - base, F.lit(0))
    end_bit = F.least(F.col("hi") - base + 1, F.lit(BLOCK_DAYS))
    return (
        unfolded.withColumn("days", _low_bits(end_bit) - _low_bits(first_bit))
        .groupBy("member_id", "provider_type", "block")
        .agg(F.bit_or("days").alias("covered_days"))
    )


def flag_covered(
    df: DataFrame,
    auths: DataFrame,
    dates: DataFrame,
    on_date: str = "service_from_date",
    flag: str = "auth_on_file",
) -> DataFrame:
    """Add a boolean telling whether (member_id, provider_type) is authorized on ``on_date``.

    ``dates`` is a frame holding all values of ``on_date``; only its bounds are read.
    """
    bounds = dates.agg(
        F.struct(F.min(on_date).alias("first"), F.max(on_date).alias("last"))
    ).scalar()
    blocks = coverage_blocks(auths, bounds["first"], bounds["last"])
    day = _day_number(F.col(on_date))
    bit = F.call_function(
        "shiftright", F.col("covered_days"), F.pmod(day, F.lit(BLOCK_DAYS)).cast("int")
    )
    return (
        df.withColumn("block", _block(day))
        .join(blocks, ["member_id", "provider_type", "block"], "left")
        .withColumn(flag, F.coalesce(bit.bitwiseAND(F.lit(1)) == 1, F.lit(False)))
        .drop("block", "covered_days")
    )
