"""Session factory and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session with this engine's defaults; anything in ``conf`` wins."""
    builder = SparkSession.builder.master(master).appName("obsforge")
    for key, value in {**DEFAULTS, "spark.sql.shuffle.partitions": str(shuffle_partitions), **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can read: ``spark.checkpoint.dir`` of the session, else the context's checkpoint folder.

    Only where neither is set and all executors are on this machine (tests, a laptop) is a temporary folder made and
    remembered in the session's configuration; on a cluster that is an error.
    """
    sc = spark.sparkContext
    where = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir() or spark.conf.get("obsforge.shared.dir", None)
    if not where:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir names no folder that all executors share")
        where = "file://" + os.path.abspath(tempfile.mkdtemp(prefix="obsforge-"))
        spark.conf.set("obsforge.shared.dir", where)
    return where.rstrip("/")


def forget(spark: SparkSession) -> None:
    """Remove all tables and filters that this engine wrote to the shared folder; for when no query's result is needed any more."""
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/obsforge")
    path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder, with its file system named."""
    where = f"{shared_dir(spark)}/obsforge/{name}-{uuid.uuid4().hex}"
    if "://" in where:
        return where
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(where)
    full = path.getFileSystem(sc._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return full.replace("file:/", "file:///", 1) if full.startswith("file:/") and not full.startswith("file://") else full


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage with a table that outlives any executor, keeps column
    pruning and compression, and gives the optimizer the true size.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once per application, so that it need not be installed there."""
    sc = spark.sparkContext
    if getattr(sc, "_obsforge_shipped", False):
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="obsforge-py-")) / "obsforge_package.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(str(target))
    sc._obsforge_shipped = True
