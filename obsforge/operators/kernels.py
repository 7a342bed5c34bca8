"""Whole-image and per-cell kernels that no column expression can state: FFT, linear algebra, fits.

Images travel as one array a row and pass through ``mapInPandas`` in batches, so a
task holds a few images at a time.  What spans images (principal components,
mode fits) is first reduced to matrices or histograms of fixed size by aggregates.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def per_image(images: DataFrame, kernel: Callable[[np.ndarray], np.ndarray], ny: int, nx: int) -> DataFrame:
    """(image_id, data) through ``kernel``, which gets and gives (ny, nx) arrays; an image of another size gives null."""

    def run(batches):
        for pdf in batches:
            out = []
            for d in pdf["data"]:
                out.append(kernel(np.asarray(d, float).reshape(ny, nx)).ravel().tolist() if d is not None and len(d) == ny * nx else None)
            yield pd.DataFrame({"image_id": pdf["image_id"], "data": pd.Series(out, dtype=object)})

    return images.select("image_id", "data").mapInPandas(run, "image_id long, data array<double>")


def to_pixels(images: DataFrame, nx: int) -> DataFrame:
    p = images.select("image_id", F.posexplode("data").alias("pos", "v"))
    return p.select("image_id", F.floor(F.col("pos") / nx).cast("int").alias("y"), (F.col("pos") % nx).cast("int").alias("x"), "v")


def psf_kernel(ny: int, nx: int, sigma: float, target: float, alpha: float = 1e-3) -> Callable[[np.ndarray], np.ndarray]:
    """Regularised division by a Gaussian's transfer function and multiplication with a wider target's."""
    fy, fx = np.fft.fftfreq(ny)[:, None], np.fft.fftfreq(nx)[None, :]
    h = np.exp(-2 * np.pi**2 * sigma**2 * (fy**2 + fx**2))
    goal = np.exp(-2 * np.pi**2 * target**2 * (fy**2 + fx**2))
    transfer = goal * h / (h * h + alpha)
    transfer /= transfer[0, 0]
    return lambda a: np.real(np.fft.ifft2(np.fft.fft2(np.nan_to_num(a)) * transfer))


def motion_filter(cube: np.ndarray, slowest: float, fastest: float) -> np.ndarray:
    """Keep the part of a (time, y, x) cube whose frequency over wave number lies between two speeds (and the mean)."""
    f = np.abs(np.fft.fftfreq(cube.shape[0]))[:, None, None]
    k = np.hypot(np.fft.fftfreq(cube.shape[1])[:, None], np.fft.fftfreq(cube.shape[2])[None, :])[None]
    with np.errstate(divide="ignore", invalid="ignore"):
        speed = np.where(k > 0, f / np.where(k > 0, k, 1), np.inf)
    keep = (speed >= slowest) & (speed <= fastest)
    keep[0, 0, 0] = True
    return np.real(np.fft.ifftn(np.fft.fftn(cube) * keep))


def gram_sums(images: DataFrame) -> DataFrame:
    """(row, col, v): sums over all images of the products of their pixels, with a last row and column of ones; added up per task, then by cell."""

    def part(batches):
        total = None
        for pdf in batches:
            x = np.array([d for d in pdf["data"] if d is not None], float)
            if len(x):
                one = np.hstack([x, np.ones((len(x), 1))])
                g = one.T @ one
                total = g if total is None else total + g
        if total is not None:
            yield pd.DataFrame({"row": range(len(total)), "v": list(total)})

    parts = images.select("data").mapInPandas(part, "row int, v array<double>")
    return parts.select("row", F.posexplode("v").alias("col", "v")).groupBy("row", "col").agg(F.sum("v").alias("v"))


def gram(images: DataFrame) -> tuple[np.ndarray, np.ndarray, int]:
    """(sum of x x', sum of x, n) over all images: a matrix of pixels squared."""
    got = gram_sums(images).toPandas()  # pixels squared numbers, whatever number of images
    size = int(got["row"].max()) + 1 if len(got) else 1
    m = np.zeros((size, size))
    m[got["row"], got["col"]] = got["v"]
    return m[:-1, :-1], m[:-1, -1], int(m[-1, -1])


def principal_residual(images: DataFrame, components: int) -> DataFrame:
    """(image_id, data): each image less its projection on the leading principal components of all."""
    g, s, n = gram(images)
    mean = s / max(n, 1)
    _, vectors = np.linalg.eigh(g / max(n, 1) - np.outer(mean, mean))
    basis = vectors[:, ::-1][:, :components]
    shared = images.sparkSession.sparkContext.broadcast((mean, basis))

    def run(batches):
        mean, basis = shared.value
        for pdf in batches:
            x = np.array(pdf["data"].tolist(), float) - mean if len(pdf) else np.empty((0, len(mean)))
            yield pd.DataFrame({"image_id": pdf["image_id"], "data": list(x - (x @ basis) @ basis.T)})

    return images.select("image_id", "data").mapInPandas(run, "image_id long, data array<double>")


def mode_of_histogram(counts: np.ndarray, centres: np.ndarray) -> tuple[float, float]:
    """(mode, width) of a skewed peak: the smoothed maximum refined by a parabola, and the half-width of its lower side."""
    c = np.convolve(np.pad(counts.astype(float), 1, mode="edge"), [0.25, 0.5, 0.25], "valid")
    i = int(np.argmax(c))
    step = centres[1] - centres[0]
    shift = 0.0
    if 0 < i < len(c) - 1 and (d := c[i - 1] - 2 * c[i] + c[i + 1]) < 0:
        shift = 0.5 * (c[i - 1] - c[i + 1]) / d
    below = np.flatnonzero(c[: i + 1] < c[i] / 2)
    width = (i - below[-1]) * step if len(below) else (i + 1) * step
    return float(centres[i] + shift * step), float(width)


def fitted_modes(px: DataFrame, keys: list[str], low: float, high: float, bins: int = 50) -> DataFrame:
    """(keys, n, mode, width) of the values' histograms: 50 counts a group reach the fit, however many values it has."""
    width = (high - low) / bins
    b = F.least(F.lit(bins - 1), F.floor((F.col("v") - low) / width)).cast("int")
    counts = px.where((F.col("v") >= low) & (F.col("v") <= high)).groupBy(*keys, b.alias("b")).agg(F.count("*").alias("n"))
    hist = counts.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("b", "n"))).alias("h"), F.sum("n").alias("n"))
    centres = low + width * (np.arange(bins) + 0.5)

    def fit(batches):
        for pdf in batches:
            out = []
            for h in pdf["h"]:
                c = np.zeros(bins)
                for k, v in (h.items() if hasattr(h, "items") else h):
                    c[k] = v
                out.append(mode_of_histogram(c, centres))
            yield pdf[[*keys, "n"]].assign(mode=[o[0] for o in out], width=[o[1] for o in out])

    types = dict(hist.dtypes)
    return hist.mapInPandas(fit, ", ".join(f"`{k}` {types[k]}" for k in keys) + ", n long, mode double, width double")


def polar_map(ny: int, nx: int, radii: int, azimuths: int) -> Callable[[np.ndarray], np.ndarray]:
    """Bilinear remap of an image onto (radius, azimuth) around its centre, each radius normalised by mean and deviation."""
    cy, cx = (ny - 1) / 2, (nx - 1) / 2
    r = np.linspace(1, min(cy, cx), radii)[:, None]
    a = np.linspace(0, 2 * np.pi, azimuths, endpoint=False)[None, :]
    y, x = cy + r * np.sin(a), cx + r * np.cos(a)
    return lambda img: _normal_rows(bilinear(img, y, x))


def _normal_rows(p: np.ndarray) -> np.ndarray:
    s = p.std(axis=1, keepdims=True)
    return (p - p.mean(axis=1, keepdims=True)) / np.where(s > 0, s, 1)


def bilinear(img: np.ndarray, y: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Values at fractional places; NaN outside."""
    ny, nx = img.shape
    y0, x0 = np.clip(np.floor(y).astype(int), 0, ny - 2), np.clip(np.floor(x).astype(int), 0, nx - 2)
    fy, fx = y - y0, x - x0
    v = (1 - fy) * ((1 - fx) * img[y0, x0] + fx * img[y0, x0 + 1]) + fy * ((1 - fx) * img[y0 + 1, x0] + fx * img[y0 + 1, x0 + 1])
    return np.where((y < -1e-9) | (x < -1e-9) | (y > ny - 1 + 1e-9) | (x > nx - 1 + 1e-9), np.nan, v)


def rotate(angle_deg: float) -> Callable[[np.ndarray], np.ndarray]:
    """Reprojection by a rotation about the centre, bilinear; what falls outside is 0."""
    c, s = np.cos(np.radians(angle_deg)), np.sin(np.radians(angle_deg))

    def f(a: np.ndarray) -> np.ndarray:
        ny, nx = a.shape
        y, x = np.mgrid[0:ny, 0:nx] - np.array([(ny - 1) / 2, (nx - 1) / 2])[:, None, None]
        return np.nan_to_num(bilinear(a, c * y + s * x + (ny - 1) / 2, c * x - s * y + (nx - 1) / 2))

    return f


def decode_table(from_bits: int = 16, to_bits: int = 10, gain: float = 4.9, read: float = 17.0) -> np.ndarray:
    """Expected value behind each square-root code under Gaussian noise: bounded by 2^to_bits entries."""
    codes = np.arange(1 << to_bits)
    scale = 2.0 ** (2 * to_bits - from_bits)
    out = np.empty(len(codes))
    for c in codes:
        mid = c * c / scale
        sd = np.sqrt(max(mid, 0) / gain + (read / gain) ** 2)
        x = np.linspace(max(0, mid - 5 * sd), mid + 5 * sd + 1, 1001)
        w = np.exp(-0.5 * ((x - mid) / sd) ** 2)
        same = np.floor(np.sqrt(np.rint(np.rint(x) * scale))) == c
        out[c] = np.average(x[same], weights=w[same]) if same.any() else mid
    return out


def cubic_fill(a: np.ndarray) -> np.ndarray:
    """Missing pixels by a cubic through the nearest two known ones on either side, along its row and its column, averaged; else left missing."""
    out = a.copy()
    for y, x in np.argwhere(np.isnan(a)):
        found = []
        for line, at in ((a[y], x), (a[:, x], y)):
            known = np.flatnonzero(~np.isnan(line))
            near = np.concatenate([known[known < at][-2:], known[known > at][:2]])
            if len(near) >= 2:
                # Lagrange's form: no matrix, exact for polynomials of its degree.
                weight = [np.prod([(at - j) / (i - j) for j in near if j != i]) for i in near]
                found.append(float(np.dot(weight, line[near])))
        if found:
            out[y, x] = np.mean(found)
    return out


def fill_holes(a: np.ndarray) -> np.ndarray:
    """A mask (1 and 0) with the unset stretches set that four-neighbour steps don't join to the edge."""
    free = np.pad(a == 0, 1, constant_values=True)
    outside = np.zeros_like(free)
    outside[0], outside[-1], outside[:, 0], outside[:, -1] = True, True, True, True
    while True:
        grown = outside.copy()
        grown[1:] |= outside[:-1]
        grown[:-1] |= outside[1:]
        grown[:, 1:] |= outside[:, :-1]
        grown[:, :-1] |= outside[:, 1:]
        grown &= free
        if (grown == outside).all():
            return (~outside[1:-1, 1:-1]).astype(float)
        outside = grown
