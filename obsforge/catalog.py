"""Loading of the catalogue's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "sci_xfi eng_ceb eng_pfw tlm_files files flows relationships health eval_items"
).split()


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def micros(col: Column | str) -> Column:
    """Microseconds since 1970 of a timestamp column, with or without zone (UTC)."""
    return F.unix_micros((F.col(col) if isinstance(col, str) else col).cast("timestamp"))
