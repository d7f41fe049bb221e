"""Keep-last deduplication without a window.

A window partitioned by the key would move every copy of a key into one task.  Here
the newest position per key is a partially aggregated ``max``, and the rows meet it
again on (key, position), which is unique, so copies of one key spread over the cluster.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def mark_latest(df: DataFrame, key: str, position: str, flag: str = "is_latest") -> DataFrame:
    """Flag the row with the highest ``position`` of each non-NULL key."""
    newest = (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.max(position).alias(position))
        .withColumn(flag, F.lit(True))
    )
    return df.join(newest, [key, position], "left").withColumn(
        flag, F.coalesce(F.col(flag), F.lit(False))
    )


def dedupe_latest(df: DataFrame, key: str, position: str) -> DataFrame:
    return mark_latest(df, key, position, "_latest").filter("_latest").drop("_latest")
