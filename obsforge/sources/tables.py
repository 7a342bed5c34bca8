"""Catalogue tables in and out: CSV with declared columns, partitioned products, side-car hashes, limits, upserts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Columns of the delivered CSV tables.
CSV_SCHEMAS = {
    "replays": "start_time timestamp, start_block int, replay_length int",
    "alphas": "code string, alpha double",
    "stars": "RAdeg double, DEdeg double, Gmag double, Dist_ly double",
}
LIMIT_SCHEMA = "limit_id string, xkey string, ykey string, comp string, knots array<struct<x double, y double>>"


def read_csv(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """A CSV table by its declared columns; a row that doesn't fit them is kept whole in ``_bad``."""
    return spark.read.schema(CSV_SCHEMAS[kind] + ", _bad string").option("columnNameOfCorruptRecord", "_bad").option("mode", "PERMISSIVE").csv(path, header=True)


def write_products(df: DataFrame, path: str, date: str = "date_beg", by: Sequence[str] = ("level", "file_type", "observatory")) -> None:
    """Partitioned by level, product and day, so that later reads prune to what they ask for."""
    day = df.withColumn("day", F.to_date(F.col(date)))
    day.repartition(*by, "day").sortWithinPartitions(*by, "day", date).write.mode("overwrite").partitionBy(*by, "day").parquet(path)


def with_digest(files: DataFrame) -> DataFrame:
    """(path, length, digest) of ``binaryFile`` rows: the content of the hash side-car."""
    return files.select("path", "length", F.sha2("content", 256).alias("digest"))


def within_budget(rows: DataFrame, error: str, most: float = 0.05) -> DataFrame:
    """The rows without an error; the read fails if more than a share ``most`` of all rows has one."""
    share = rows.agg(F.avg(F.col(error).isNotNull().cast("double"))).scalar()
    fine = F.when(share > most, F.raise_error(F.format_string("%.1f %% of the inputs failed", share * 100)).cast("boolean")).otherwise(F.lit(True))
    return rows.where(F.col(error).isNull() & fine)


def upsert(table: DataFrame, news: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``table`` with the rows of ``news`` in place of those with the same key; nulls equal nulls."""
    on = None
    fresh = news.select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"_{k}"))
        on = c if on is None else on & c
    return table.join(fresh, on, "left_anti").unionByName(news)
