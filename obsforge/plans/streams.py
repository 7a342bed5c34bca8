"""Queries that run a stream over a table to its end and read what it wrote."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from obsforge.catalog import load
from obsforge.session import scratch_path
from obsforge.streaming import ingest


def _run(spark, stream, mode="append"):
    out = scratch_path(spark, "stream")
    ingest.run_to_table(stream, f"{out}/rows", f"{out}/checkpoint", mode)
    return spark.read.schema(stream.schema.add("batch", "integer")).parquet(f"{out}/rows")


#: Bytes of files in a micro-batch of the queries whose work is small beside a micro-batch's fixed cost (state of all partitions read and committed).
BATCH_BYTES = 256 << 20


def _stream(spark, d, name, *cols, batch_bytes=None):
    """The table as it is delivered: a file, or a folder of files taken one by one, or ``batch_bytes`` at a time.  A pattern, as a stream's plain path must be a folder."""
    like = load(spark, d, name)
    return ingest.read_table(spark, f"{d}/{name}.parque[t]", like, bytes_per_trigger=batch_bytes).select(*cols)


def stream_tumbling(spark, d):
    """Science packets per half hour and spacecraft; the counts of a window are given out anew with each batch, the last one stands."""
    s = ingest.tumbling_counts(_stream(spark, d, "sci_xfi", "spacecraft_id", "timestamp", batch_bytes=BATCH_BYTES), "timestamp", "32 minutes", ["spacecraft_id"])
    last = _run(spark, s, "update").groupBy("start", "spacecraft_id").agg(F.max_by("n", "batch").alias("n"))
    return last.select(F.col("start").cast("timestamp_ntz").alias("start"), "spacecraft_id", "n")


def stream_hopping(spark, d):
    """Files per 30 hours every 24."""
    s = ingest.tumbling_counts(_stream(spark, d, "files", "observatory", "date_beg").where("date_beg IS NOT NULL"), "date_beg", "30 hours", ["observatory"], slide="24 hours")
    last = _run(spark, s, "update").groupBy("start", "observatory").agg(F.max_by("n", "batch").alias("n"))
    return last.select(F.col("start").cast("timestamp_ntz").alias("start"), "observatory", "n")


def stream_once(spark, d):
    """Packet ids that came through with duplicates of (spacecraft, count, time) dropped; as a count per spacecraft."""
    s = ingest.once(_stream(spark, d, "eng_ceb", "spacecraft_id", "ccsds_sequence_count", "timestamp"), ["spacecraft_id", "ccsds_sequence_count", "timestamp"], "timestamp", "3650 days")
    return _run(spark, s).groupBy("spacecraft_id").agg(F.count("*").alias("n"))


def stream_groups(spark, d):
    """Flows whose two files have all arrived."""
    s = ingest.complete_groups(_stream(spark, d, "files", "processing_flow", "file_id", "date_beg", batch_bytes=BATCH_BYTES).where("processing_flow IS NOT NULL AND date_beg IS NOT NULL"), "processing_flow", "file_id", "date_beg", 2, 3_600_000, "3650 days")
    return _run(spark, s, "update").where("complete").select("grp").distinct()


def stream_intervals(spark, d):
    """Number of periods and covered time per observatory, from keyed interval maps."""
    s = ingest.interval_maps(_stream(spark, d, "files", "observatory", "date_beg", "date_end"), "observatory", "date_beg", "date_end")
    rank = F.row_number().over(Window.partitionBy("entity").orderBy(F.desc("batch")))
    return _run(spark, s, "update").withColumn("r", rank).where("r = 1").select(F.col("entity").alias("observatory"), "periods", "covered_us")


def stream_cycles(spark, d):
    """Polarization cycles per observatory that are finished a day before the stream's end."""
    f = _stream(spark, d, "files", "observatory", "polarization", "file_id", "date_beg").where("polarization IN ('M', 'Z', 'P')").withColumn("code", F.expr("instr('MZP', polarization)"))
    s = ingest.cycle_sessions(f, "observatory", "date_beg", "code", "file_id", 600_000_000, 2, "1 day")
    return _run(spark, s).select(F.col("key").alias("observatory"), "start_us", "n", F.col("first_member").alias("first_file"))


QUERIES = {f.__name__: f for f in (stream_tumbling, stream_hopping, stream_once, stream_groups, stream_intervals, stream_cycles)}
ORACLE = {
    "stream_cycles": """WITH a AS (SELECT file_id, observatory, epoch_us(date_beg) AS us, CAST(strpos('MZP', polarization) AS INTEGER) AS code FROM files
  WHERE date_beg IS NOT NULL AND file_id IS NOT NULL AND observatory IS NOT NULL AND polarization IN ('M', 'Z', 'P')),
m AS (SELECT (max(us) // 1000 - 86400000) * 1000 AS mark FROM a), p AS (SELECT a.* FROM a, m WHERE us <= mark),
l AS (SELECT *, code - lag(code) OVER s AS rise, us - lag(us) OVER s AS pause FROM p WINDOW s AS (PARTITION BY observatory ORDER BY us, file_id)),
c AS (SELECT *, sum(CASE WHEN rise <= 0 OR pause > 600000000 * rise OR rise IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY observatory ORDER BY us, file_id ROWS UNBOUNDED PRECEDING) AS cycle FROM l),
g AS (SELECT observatory, cycle, min(us) AS start_us, max(us) AS last_us, count(*) AS n, arg_min(file_id, (us, file_id)) AS first_file FROM c GROUP BY observatory, cycle)
SELECT observatory, start_us, n, first_file FROM (SELECT *, max(cycle) OVER (PARTITION BY observatory) AS newest FROM g), m WHERE cycle < newest OR last_us + 1200000000 < mark""",
    "stream_tumbling": "SELECT make_timestamp(epoch_us(timestamp) // 1920000000 * 1920000000) AS start, spacecraft_id, count(*) AS n FROM sci_xfi WHERE timestamp IS NOT NULL GROUP BY ALL",
    "stream_hopping": """WITH s AS (SELECT observatory, epoch_us(date_beg) AS us FROM files WHERE date_beg IS NOT NULL),
h AS (SELECT observatory, unnest(CASE WHEN us % 86400000000 < 21600000000 THEN [us // 86400000000, us // 86400000000 - 1] ELSE [us // 86400000000] END) AS day FROM s)
SELECT make_timestamp(day * 86400000000) AS start, observatory, count(*) AS n FROM h GROUP BY ALL""",
    "stream_once": "SELECT spacecraft_id, count(*) AS n FROM (SELECT DISTINCT spacecraft_id, ccsds_sequence_count, timestamp FROM eng_ceb WHERE timestamp IS NOT NULL) GROUP BY spacecraft_id",
    "stream_groups": "SELECT processing_flow AS grp FROM files WHERE processing_flow IS NOT NULL AND date_beg IS NOT NULL GROUP BY processing_flow HAVING count(DISTINCT file_id) >= 2",
    "stream_intervals": """WITH s AS (SELECT observatory, epoch_us(date_beg) AS b, epoch_us(date_end) AS e FROM files WHERE observatory IS NOT NULL AND date_beg < date_end),
m AS (SELECT *, max(e) OVER (PARTITION BY observatory ORDER BY b, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM s),
g AS (SELECT *, sum(CASE WHEN reach >= b THEN 0 ELSE 1 END) OVER (PARTITION BY observatory ORDER BY b, e) AS grp FROM m),
p AS (SELECT observatory, min(b) AS b, max(e) AS e FROM g GROUP BY observatory, grp)
SELECT observatory, count(*) AS periods, CAST(sum(e - b) AS BIGINT) AS covered_us FROM p GROUP BY observatory""",
}
