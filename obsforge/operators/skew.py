"""Hot keys: found by counting, bounded in number by their share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHARE = 1000


def hot_keys(df: DataFrame, key: str, share: int = SHARE, least: int = 1000) -> DataFrame:
    """Keys that hold more than 1/share of all rows (and at least ``least``): never more than ``share`` of them, so they may be broadcast."""
    floor = max(least, df.count() // share)
    return df.groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") > floor).select(key)
