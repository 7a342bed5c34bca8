"""Views that several queries share: one row per file and flow, pixels of the image table; each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from obsforge.catalog import load


def first_row(df: DataFrame, key: str, *order: str) -> DataFrame:
    """One row per key, the first in the given order (nulls first)."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.where(F.col(key).isNotNull()).withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def files(spark: SparkSession, d: str) -> DataFrame:
    return first_row(load(spark, d, "files"), "file_id", "state")


def flows(spark: SparkSession, d: str) -> DataFrame:
    return first_row(load(spark, d, "flows"), "flow_id", "state", "launch_time", "end_time")


FILES = "f AS (SELECT * FROM files WHERE file_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY file_id ORDER BY state NULLS FIRST) = 1)"
FLOWS = "w AS (SELECT * FROM flows WHERE flow_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY flow_id ORDER BY state NULLS FIRST, launch_time NULLS FIRST, end_time NULLS FIRST) = 1)"


def pixels(spark: SparkSession, d: str) -> DataFrame:
    """Long image rows: (image_id, obs, y, x, v, unc, bad) of the 8 x 8 images in ``embeddings``; unc and bad follow from the position."""
    e = load(spark, d, "embeddings").select("vec_id", "label", F.posexplode("embedding").alias("pos", "e"))
    return e.select(
        F.col("vec_id").alias("image_id"), F.col("label").alias("obs"), F.floor(F.col("pos") / 8).cast("int").alias("y"), (F.col("pos") % 8).cast("int").alias("x"),
        F.col("e").cast("double").alias("v"),
        (F.lit(0.1) + F.pmod(F.col("vec_id") * 7 + F.col("pos"), F.lit(13)) / 10).alias("unc"),
        (F.pmod(F.col("vec_id") + F.col("pos"), F.lit(17)) == 0).alias("bad"),
    )


PIXELS = """px AS (SELECT vec_id AS image_id, label AS obs, CAST((i - 1) // 8 AS INTEGER) AS y, CAST((i - 1) % 8 AS INTEGER) AS x, CAST(embedding[i] AS DOUBLE) AS v,
CAST(0.1 AS DOUBLE) + CAST((vec_id * 7 + i - 1) % 13 AS DOUBLE) / 10 AS unc, (vec_id + i - 1) % 17 = 0 AS bad FROM embeddings, range(1, 65) AS t(i))"""


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def query_into(queries: dict, oracle: dict):
    """A decorator that registers a query under its name, with its SQL if there is any."""

    def query(sql: str | None = None):
        def keep(f):
            queries[f.__name__] = f
            if sql:
                oracle[f.__name__] = sql
            return f

        return keep

    return query
