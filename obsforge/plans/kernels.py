"""Queries that run array kernels; SQL can't express most of them, tests hold them against numpy."""

from __future__ import annotations

from pyspark.sql import functions as F

from obsforge.catalog import load
from obsforge.operators import kernels as k
from obsforge.plans.views import pixels


def images(spark, d):
    e = load(spark, d, "embeddings")
    return e.select(F.col("vec_id").alias("image_id"), F.transform("embedding", lambda x: x.cast("double")).alias("data"))


def _px(df, nx=8):
    return k.to_pixels(df, nx).select("image_id", "y", "x", F.round("v", 6).alias("v"))


def psf_corrected(spark, d):
    return _px(k.per_image(images(spark, d), k.psf_kernel(8, 8, 0.7, 1.0), 8, 8))


def reprojected(spark, d):
    return _px(k.per_image(images(spark, d), k.rotate(15.0), 8, 8))


def principal_residuals(spark, d):
    return _px(k.principal_residual(images(spark, d), 5))


def gram_pixels(spark, d):
    """Inner products of the pixels over all images: what the principal components are made from, in time linear in the images."""
    got = k.gram_sums(images(spark, d)).where("row <= col AND col < 64")
    return got.select(F.col("row").alias("a"), F.col("col").alias("b"), F.round("v", 5).alias("dot"))


def polar_remapped(spark, d):
    """A 3 x 16 polar map a image, normalised along each radius."""
    return _px(k.per_image(images(spark, d), k.polar_map(8, 8, 3, 16), 8, 8), 16)


def static_stray_light(spark, d):
    """Mode of the values in each 4 x 4 cell and observatory."""
    px = pixels(spark, d).withColumn("cy", F.floor(F.col("y") / 4)).withColumn("cx", F.floor(F.col("x") / 4))
    got = k.fitted_modes(px, ["obs", "cy", "cx"], -1.0, 1.0)
    return got.select("obs", "cy", "cx", "n", F.round("mode", 6).alias("mode"), F.round("width", 6).alias("width"))


def table_decoded(spark, d):
    """Codes to expected values through a lookup table of fixed size; codes beyond it take its end."""
    table = k.decode_table()
    at = F.array(*[F.lit(float(v)) for v in table])
    code = F.greatest(F.lit(0), F.least(F.lit(len(table) - 1), F.col("ccsds_packet_length")))
    return load(spark, d, "eng_ceb").select("id", F.round(F.element_at(at, code + 1), 4).alias("v"))


QUERIES = {f.__name__: f for f in (psf_corrected, reprojected, principal_residuals, gram_pixels, polar_remapped, static_stray_light, table_decoded)}
ORACLE: dict[str, str] = {
    "gram_pixels": """
WITH px AS (SELECT vec_id, CAST(i - 1 AS INTEGER) AS pos, CAST(embedding[i] AS DOUBLE) AS v FROM embeddings, range(1, 65) AS t(i))
SELECT p.pos AS a, q.pos AS b, round(sum(p.v * q.v), 5) AS dot FROM px p JOIN px q ON p.vec_id = q.vec_id AND p.pos <= q.pos GROUP BY p.pos, q.pos""",
}
