"""Aggregates over stacks of co-gridded images in long form.

Each is one hash aggregate by pixel: partial sums before the shuffle, nothing
collected per pixel, except for exact percentiles, whose state is the pixel's own
samples (one per image, bounded by the frames of a window).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNUSABLE = 1e12


def merge_inverse_variance(px: DataFrame, keys: Sequence[str], v: str = "v", unc: str = "unc") -> DataFrame:
    """(keys, v, unc): weights 1/u^2; an unusable u counts with the sentinel unless the value is missing or zero too.

    The uncertainty is the root mean square of the usable ones; none usable gives infinity.  A missing value gives 0.
    """
    val, u = F.col(v), F.col(unc)
    good = u.isNotNull() & (u > 0) & (u < float("inf"))
    empty = val.isNull() | (val == 0)
    w = F.when(good, 1 / (u * u)).when(~empty, F.lit(1 / (UNUSABLE * UNUSABLE)))
    mean = F.try_divide(F.sum(val * w), F.sum(w))
    return px.groupBy(*keys).agg(F.coalesce(mean, F.lit(0.0)).alias(v), F.coalesce(F.sqrt(F.avg(F.when(good, u * u))), F.lit(float("inf"))).alias(unc))


def image_statistics(px: DataFrame, keys: Sequence[str], v: str = "v", saturation: float = 1e9) -> DataFrame:
    """Zeros, saturated pixels, mean, median, deviation, extremes and percentiles of the non-zero pixels; -999 where there are none."""
    x = F.when((F.col(v) != 0) & ~F.isnan(v), F.col(v))
    none = lambda c, d=-999.0: F.coalesce(c, F.lit(d))
    levels = (1, 10, 25, 50, 75, 90, 95, 98, 99)
    pct = F.percentile(x, F.array(*[F.lit(p / 100) for p in levels]))
    return px.groupBy(*keys).agg(
        F.count_if(F.col(v) == 0).alias("zeros"), F.count_if(F.col(v) >= saturation).alias("saturated"), none(F.avg(x)).alias("mean"), none(F.stddev_pop(x)).alias("deviation"),
        none(F.min(x), 0.0).alias("low"), none(F.max(x), 0.0).alias("high"), *[none(F.element_at(pct, i + 1)).alias(f"p{p:02d}") for i, p in enumerate(levels)],
    )


def stack_percentile(px: DataFrame, keys: Sequence[str], v: Column, share: float, name: str) -> DataFrame:
    """Linear-interpolated percentile along the stack, missing values left out."""
    return px.groupBy(*keys).agg(F.percentile(v, F.lit(share)).alias(name))


def spike_votes(px: DataFrame, pixel: Sequence[str], frame: str, v: str, unc: str, voters: int, factor: float, needed: int, veto: int, absolute: float | None = None) -> DataFrame:
    """``px`` with ``spike``: whether enough of the ``voters`` frames on both sides differ by more than factor deviations of them, or by more than ``absolute``.

    An infinite uncertainty is a spike; more than ``veto`` voters against overrule.  The voters of a frame are the neighbouring
    rows of its pixel, so this is a window, not a self-join.
    """
    w = Window.partitionBy(*pixel).orderBy(frame)
    offsets = [k for k in range(-voters, voters + 1) if k]
    # One sort; the neighbours come as columns, so the whole vote stays in generated code.
    near = px.select("*", *[F.lag(c, -k).over(w).alias(f"_{c}{k}") for k in offsets for c in dict.fromkeys((v, unc))])
    at = {k: F.col(f"`_{v}{k}`") for k in offsets}
    sure = {k: F.col(f"`_{unc}{k}`") < 1 for k in offsets}
    total = lambda f: reduce(lambda a, b: a + b, [f(k) for k in offsets])
    n = total(lambda k: F.when(sure[k], 1).otherwise(0))
    near = near.withColumn("_sure", n).withColumn("_mean", F.try_divide(total(lambda k: F.when(sure[k], at[k]).otherwise(0.0)), F.col("_sure")))
    var = F.try_divide(total(lambda k: F.when(sure[k], (at[k] - F.col("_mean")) * (at[k] - F.col("_mean"))).otherwise(0.0)), F.col("_sure"))
    near = near.withColumn("_limit", factor * F.sqrt(var) if absolute is None else F.lit(float(absolute)))
    yes = total(lambda k: F.when(F.abs(F.col(v) - at[k]) > F.col("_limit"), 1).otherwise(0))
    there = total(lambda k: F.when(at[k].isNotNull(), 1).otherwise(0))
    flagged = ((yes > needed) & (there - yes <= veto)) | (F.col(unc) == float("inf"))
    return near.withColumn("spike", F.coalesce(flagged, F.lit(False))).select(*px.columns, "spike")


def despike(px: DataFrame, pixel: Sequence[str], frame: str, v: str, z: float = 10.0) -> DataFrame:
    """``px`` with ``spike``: z-score of each frame's value against the median and deviation of all but the brightest one.

    Groups hold 3 to 7 frames (others raise no spike).
    """
    rank = F.row_number().over(Window.partitionBy(*pixel).orderBy(F.desc(v), F.desc(frame)))
    ranked = px.withColumn("_r", rank)
    dim = ranked.where("_r > 1").groupBy(*pixel).agg(F.median(v).alias("_m"), F.stddev_pop(v).alias("_s"), F.count("*").alias("_n"))
    got = ranked.join(dim, list(pixel), "left")
    spike = F.col("_n").between(2, 6) & (F.col(v) - F.col("_m") >= z * F.col("_s")) & (F.col("_s") > 0)
    return got.withColumn("spike", F.coalesce(spike, F.lit(False))).drop("_r", "_m", "_s", "_n")


def matrix_times(px: DataFrame, matrix: DataFrame, image: str = "image_id") -> DataFrame:
    """(image, y, x, v): sum over k of matrix[y, k] * image[k, x]; the matrix (i, k, w) has one row per pair of detector rows, millions for a large detector, so whether it is broadcast is left to its size."""
    return px.join(matrix, F.col("y") == F.col("k")).groupBy(image, F.col("i").alias("y"), "x").agg(F.sum(F.col("w") * F.col("v")).alias("v"))


def destreak_matrix(n: int, exposure: float, readout: float, reset: float):
    """Inverse of the matrix with the exposure on the diagonal, the readout below and the reset above it."""
    m = np.full((n, n), float(exposure))
    m[np.tril_indices(n, -1)] = readout
    m[np.triu_indices(n, 1)] = reset
    return np.linalg.inv(m)
