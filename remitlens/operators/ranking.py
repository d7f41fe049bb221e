"""Row numbers and ranks inside groups that may be very large.

A window over a group would put it into one task.  The rows are range-partitioned on
(group, order) instead, numbered inside each range, and shifted by the number of rows of
the group in the ranges before.  Groups of every size take this way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from remitlens.session import materialise


def number_within(df: DataFrame, group: list[str], order: list[Column], name: str) -> DataFrame:
    """``row_number`` (int) over a total order inside each group.

    The ranged rows are written to the checkpoint folder, so that a range keeps its number.
    """
    by_group = [F.col(g) for g in group]
    ranged = materialise(
        df.repartitionByRange(*by_group, *order).withColumn("_range", F.spark_partition_id())
    )
    # One row per group and range: as many as there are partitions, not rows.
    sizes = ranged.groupBy(*group, "_range").count()
    before = W.partitionBy(*group).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    shifts = sizes.select(
        *group, "_range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_shift")
    )
    local = F.row_number().over(W.partitionBy(*group, "_range").orderBy(*order))
    numbered = ranged.withColumn("_local", local).alias("n").join(
        shifts.alias("s"),
        [F.col(f"n.{g}").eqNullSafe(F.col(f"s.{g}")) for g in group]
        + [F.col("n._range") == F.col("s._range")],
    )
    position = (F.col("_local") + F.col("_shift")).cast("int")
    return numbered.select(*[f"n.{c}" for c in df.columns], position.alias(name))


def rank_within(df: DataFrame, group: str, value: str, tie_break: str, name: str) -> DataFrame:
    """``rank`` (int) by ``value`` descending inside each group; equal values share the lowest number."""
    order = [F.col(value).desc(), F.col(tie_break)]
    numbered = number_within(df, [group], order, "_position")
    first = numbered.groupBy(group, value).agg(F.min("_position").alias(name))
    return numbered.drop("_position").join(first, [group, value])
