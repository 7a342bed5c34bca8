"""Neighbourhood operators on images in long form, and their tiled twin.

The long form copies each pixel to the places that see it and aggregates there:
one shuffle by pixel, partial sums first.  The tiled form sends array tiles with
a halo through an Arrow kernel; both give the same numbers.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def neighbours(px: DataFrame, radius: int, ny: int, nx: int, image: str = "image_id", cols: Sequence[str] = ("v",)) -> DataFrame:
    """Each pixel once for every place that has it in its window of ``radius``: (image, y, x, dy, dx, cols)."""
    side = F.sequence(F.lit(-radius), F.lit(radius))
    far = px.select(image, F.col("y").alias("_y"), F.col("x").alias("_x"), *cols).withColumn("dy", F.explode(side)).withColumn("dx", F.explode(side))
    out = far.select(image, (F.col("_y") - F.col("dy")).alias("y"), (F.col("_x") - F.col("dx")).alias("x"), "dy", "dx", *cols)
    return out.where((F.col("y") >= 0) & (F.col("y") < ny) & (F.col("x") >= 0) & (F.col("x") < nx))


def percentile_filter(px: DataFrame, radius: int, share: float, ny: int, nx: int, image: str = "image_id") -> DataFrame:
    """Percentile of the window, cut at the edges, missing values left out."""
    return neighbours(px, radius, ny, nx, image).groupBy(image, "y", "x").agg(F.percentile("v", F.lit(share)).alias("v"))


def gaussian(px: DataFrame, sigma: float, ny: int, nx: int, image: str = "image_id") -> DataFrame:
    """Normalised Gaussian smoothing to four sigma: weights of missing pixels are left out."""
    r = int(4 * sigma + 0.5)
    w = F.exp(-(F.col("dy") * F.col("dy") + F.col("dx") * F.col("dx")) / (2 * sigma * sigma))
    return neighbours(px, r, ny, nx, image).groupBy(image, "y", "x").agg(F.try_divide(F.sum(w * F.col("v")), F.sum(F.when(F.col("v").isNotNull(), w))).alias("v"))


def dilate(px: DataFrame, flag: str, radius: int, ny: int, nx: int, image: str = "image_id", erode: bool = False, cross: bool = False) -> DataFrame:
    """Dilation (or erosion) of a flag by a square, or by ``radius`` steps along rows and columns (``cross``)."""
    f = F.bool_and if erode else F.bool_or
    near = neighbours(px, radius, ny, nx, image, (flag,))
    return (near.where(F.abs("dy") + F.abs("dx") <= radius) if cross else near).groupBy(image, "y", "x").agg(f(flag).alias(flag))


def fill_deficient(px: DataFrame, bad: str, needed: int, widest: int, ny: int, nx: int, how: Callable[[Column], Column], image: str = "image_id") -> DataFrame:
    """``px`` with deficient pixels replaced by the mean or median of the smallest window that has ``needed`` good ones.

    Only good pixels near bad ones travel.  Windows that never reach the number leave the pixel null; a filled pixel's
    uncertainty, if there is one, becomes infinite.
    """
    lost = px.where(bad).select(image, "y", "x")
    good = px.where(f"NOT {bad}")
    around = neighbours(good, widest, ny, nx, image).join(lost, [image, "y", "x"], "left_semi")
    ring = F.greatest(F.abs("dy"), F.abs("dx"))
    rings = around.withColumn("ring", ring)
    per = rings.groupBy(image, "y", "x", "ring").agg(F.count("v").alias("n"))
    reach = per.withColumn("cum", F.sum("n").over(Window.partitionBy(image, "y", "x").orderBy("ring"))).where(F.col("cum") >= needed).groupBy(image, "y", "x").agg(F.min("ring").alias("least"))
    filled = rings.join(reach, [image, "y", "x"]).where("ring <= least").groupBy(image, "y", "x").agg(how(F.col("v")).alias("_fill"))
    got = px.join(filled, [image, "y", "x"], "left").withColumn("v", F.when(F.col(bad), F.col("_fill")).otherwise(F.col("v"))).drop("_fill")
    return got.withColumn("unc", F.when(F.col(bad), F.lit(float("inf"))).otherwise(F.col("unc"))) if "unc" in px.columns else got


def shift_onto(px: DataFrame, grid: DataFrame, dy: Column, dx: Column, fill: float, image: str = "image_id") -> DataFrame:
    """The image moved by whole pixels onto a target grid; places it doesn't reach get ``fill``."""
    moved = px.select(image, (F.col("y") + dy).alias("y"), (F.col("x") + dx).alias("x"), "v")
    return grid.join(moved, [image, "y", "x"], "left").select(image, "y", "x", F.coalesce("v", F.lit(fill)).alias("v"))


def bin_down(px: DataFrame, ny: int, nx: int, out_y: int, out_x: int, image: str = "image_id") -> DataFrame:
    """Sums over the cells of a coarser grid."""
    by = [F.floor(F.col("y") * out_y / ny).cast("int").alias("y"), F.floor(F.col("x") * out_x / nx).cast("int").alias("x")]
    return px.groupBy(image, *by).agg(F.sum("v").alias("v"))


# --- Tiles -----------------------------------------------------------------


def tiles(px: DataFrame, ny: int, nx: int, size: int, halo: int, image: str = "image_id") -> DataFrame:
    """(image, ty, tx, y0, x0, h, w, data): array tiles of ``size`` with ``halo`` pixels of their neighbours around them.

    A tile's pixels are gathered in one group of at most (size + 2 halo)^2.
    """
    near = lambda c, n: F.explode(F.array_distinct(F.transform(F.array(F.lit(-halo), F.lit(0), F.lit(halo)), lambda o: F.greatest(F.lit(0), F.least(F.lit((n - 1) // size), F.floor((F.col(c) + o) / size).cast("int"))))))
    t = px.select(image, "y", "x", "v").withColumn("ty", near("y", ny)).withColumn("tx", near("x", nx))
    g = t.groupBy(image, "ty", "tx").agg(F.array_sort(F.collect_list(F.struct("y", "x", "v"))).alias("cells"))
    lo = lambda c: F.greatest(F.lit(0), F.col(c) * size - halo)
    hi = lambda c, n: F.least(F.lit(n), (F.col(c) + 1) * size + halo)
    return g.select(image, "ty", "tx", lo("ty").alias("y0"), lo("tx").alias("x0"), (hi("ty", ny) - lo("ty")).alias("h"), (hi("tx", nx) - lo("tx")).alias("w"), F.transform("cells", lambda c: c["v"]).alias("data"))


def on_tiles(tiled: DataFrame, kernel: Callable[[np.ndarray], np.ndarray], size: int, image: str = "image_id") -> DataFrame:
    """(image, y, x, v): run ``kernel`` on each tile (missing pixels NaN) and keep the tile's own pixels."""

    def run(batches):
        for pdf in batches:
            out = []
            for i, ty, tx, y0, x0, h, w, data in pdf.itertuples(index=False):
                a = kernel(np.asarray(data, dtype=float).reshape(h, w))
                ys, xs = np.mgrid[y0 : y0 + h, x0 : x0 + w]
                own = (ys // size == ty) & (xs // size == tx)
                out.append(pd.DataFrame({image: i, "y": ys[own], "x": xs[own], "v": a[own]}))
            yield pd.concat(out) if out else pd.DataFrame(columns=[image, "y", "x", "v"])

    return tiled.mapInPandas(run, f"{image} long, y int, x int, v double").withColumn("v", F.when(~F.isnan("v"), F.col("v")))


def gaussian_kernel(sigma: float) -> Callable[[np.ndarray], np.ndarray]:
    r = int(4 * sigma + 0.5)
    bands: dict[int, np.ndarray] = {}

    def band(n: int) -> np.ndarray:
        """Weights between the places of a line of n pixels."""
        if n not in bands:
            gap = np.abs(np.subtract.outer(np.arange(n), np.arange(n)))
            bands[n] = np.where(gap <= r, np.exp(-(gap**2) / (2 * sigma * sigma)), 0.0)
        return bands[n]

    def f(a: np.ndarray) -> np.ndarray:
        ok = ~np.isnan(a)
        down, across = band(a.shape[0]), band(a.shape[1])
        num, den = (down @ m @ across for m in (np.where(ok, a, 0.0), ok.astype(float)))
        with np.errstate(invalid="ignore", divide="ignore"):
            return np.where(den > 0, num / den, np.nan)

    return f


def inpaint(a: np.ndarray) -> np.ndarray:
    """Fill missing pixels with the mean of the known ones of their 5 x 5 window, again and again until nothing changes."""
    a = a.copy()
    while (holes := np.isnan(a)).any():
        p = np.pad(a, 2, mode="symmetric")
        w = np.lib.stride_tricks.sliding_window_view(p, (5, 5)).reshape(*a.shape, 25)
        known = ~np.isnan(w)
        n = known.sum(-1)
        new = holes & (n > 0)
        if not new.any():
            break
        a[new] = np.where(known, w, 0.0).sum(-1)[new] / n[new]
    return a
