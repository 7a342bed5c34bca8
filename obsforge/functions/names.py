"""Product names: file names, directories, versions, labels and templates, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the file name grammar PREFIX_L<level>_<type><observatory>_<yyyyMMddHHmmss>_v<version>.fits
NAME = r"^[A-Z]+_L([0-9A-Z])_([A-Z]{2})([0-9A-Z])_(\d{14})_v(\w+)\.fits$"


def file_name(level, kind, observatory, date, version, prefix: str = "OBS") -> Column:
    return F.concat(F.lit(f"{prefix}_L"), level, F.lit("_"), kind, observatory, F.lit("_"), F.date_format(date, "yyyyMMddHHmmss"), F.lit("_v"), version, F.lit(".fits"))


def directory(level, kind, observatory, date) -> Column:
    return F.concat(level, F.lit("/"), kind, observatory, F.lit("/"), F.date_format(date, "yyyy/MM/dd"))


def parse_name(name: Column) -> Column:
    """struct<level, kind, observatory, date, version, polarization> of a file name; null fields if it does not fit."""
    part = lambda i: F.when(name.rlike(NAME), F.regexp_extract(name, NAME, i))
    return F.struct(
        part(1).alias("level"), part(2).alias("kind"), part(3).alias("observatory"),
        F.try_to_timestamp(part(4), F.lit("yyyyMMddHHmmss")).cast("timestamp_ntz").alias("date"), part(5).alias("version"),
        polarization(part(2)).alias("polarization"),
    )


def polarization(kind: Column) -> Column:
    """M, Z or P, or C for a clear one, from the second letter of a type code."""
    second = F.substring(kind, 2, 1)
    return F.when(second.isin("M", "Z", "P"), second).when(second == "R", "C")


def rewrite_version(name: Column, old: str, new: str) -> Column:
    return F.regexp_replace(name, rf"_v{old}\.fits", f"_v{new}.fits")


def fill_template(template: str, **values: Column) -> Column:
    """Replace {KEY} by its value; a key without a value, or with a null one, stays as it is written."""
    out = F.lit(template)
    for key, value in values.items():
        out = F.replace(out, F.lit("{" + key + "}"), F.coalesce(value.cast("string"), F.lit("{" + key + "}")))
    return out
