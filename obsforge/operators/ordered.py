"""The width of time chunks into which sequences are cut, so that one entity with a third of all rows spreads over many tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

WIDTHS_US = [s * 1_000_000 for s in (64 * 86400, 16 * 86400, 4 * 86400, 86400, 6 * 3600, 3600, 600, 60, 1)]


def chunk_width(df: DataFrame, keys: Sequence[str], us: str, rows: int) -> int:
    """The widest of WIDTHS_US whose fullest (key, slot) holds at most ``rows`` rows; the narrowest if none does.

    Counted once at one hour; coarser widths are summed from that, finer ones counted only if an hour is too full.
    """
    hours = df.groupBy(*keys, F.floor(F.col(us) / 3_600_000_000).alias("_h")).agg(F.count("*").alias("_n"))
    coarse = [w for w in WIDTHS_US if w >= 3_600_000_000]
    sums = [
        F.max(f"_m{i}").alias(f"_m{i}")
        for i in range(len(coarse))
    ]
    over = hours.select("_n", *[F.sum("_n").over(Window.partitionBy(*keys, F.floor(F.col("_h") / (w // 3_600_000_000)))).alias(f"_m{i}") for i, w in enumerate(coarse)])
    most = over.agg(*sums).collect()[0]
    for i, w in enumerate(coarse):
        if (most[i] or 0) <= rows:
            return w
    for w in WIDTHS_US[len(coarse) :]:
        if (df.groupBy(*keys, F.floor(F.col(us) / w)).count().agg(F.max("count")).collect()[0][0] or 0) <= rows:
            return w
    return WIDTHS_US[-1]
