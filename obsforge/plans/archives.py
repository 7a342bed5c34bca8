"""Queries that write an archive to the shared folder and read it back: FITS, packets, masks, CSV, ingest and sampling."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from obsforge.catalog import load
from obsforge.plans.pixels import KEY, PX, r6
from obsforge.plans.views import FILES, files, pixels, query_into, with_
from obsforge.session import materialize, scratch_path
from obsforge.sources import fits, packets, tables

Q: dict = {}
ORACLE: dict[str, str] = {}
query = query_into(Q, ORACLE)
PER_FILE = 20


def _archive(spark, d, compression):
    """Twenty images one above the other in each file, their numbers as its provenance."""
    e = load(spark, d, "embeddings").groupBy(F.floor(F.col("vec_id") / PER_FILE).alias("g")).agg(F.array_sort(F.collect_list(F.struct("vec_id", "embedding"))).alias("s"))
    rows = e.select(
        F.format_string("s%010d.fits", "g").alias("name"), (F.size("s") * 8).alias("ny"), F.lit(8).alias("nx"), F.flatten(F.transform("s", lambda x: x["embedding"])).alias("data"),
        F.transform("s", lambda x: x["vec_id"].cast("string")).alias("provenance"), F.create_map(F.lit("LEVEL"), F.lit("0")).alias("header"),
    )
    folder = scratch_path(spark, "fits")
    fits.write_images(rows, folder, compression).agg(F.sum("bytes")).collect()
    spark.dataSource.register(fits.FitsSource)
    return folder


def _read_back(spark, folder):
    back = spark.read.format("fits").schema("data array<float>, provenance array<string>, error string").load(folder).where("error IS NULL")
    px = back.select("provenance", F.posexplode("data").alias("pos", "v"))
    number = F.element_at("provenance", F.floor(F.col("pos") / 64).cast("int") + 1).cast("long")
    return px.select(number.alias("image_id"), F.floor(F.col("pos") % 64 / 8).cast("int").alias("y"), (F.col("pos") % 8).cast("int").alias("x"), r6(F.col("v").cast("double"), "v"))


@query(PX + "SELECT image_id, y, x, round(v, 6) AS v FROM px")
def fits_compressed(spark, d):
    """All images through tile-compressed FITS files, without loss."""
    return _read_back(spark, _archive(spark, d, "GZIP_2"))


@query(PX + "SELECT image_id, y, x, round(v, 6) AS v FROM px")
def fits_plain(spark, d):
    """All images through plain FITS files."""
    return _read_back(spark, _archive(spark, d, None))


@query(f"SELECT vec_id // {PER_FILE} AS g, CAST(8 * count(*) AS INTEGER) AS ny, 8 AS nx FROM embeddings GROUP BY vec_id // {PER_FILE}")
def fits_headers(spark, d):
    """A scan that asks for no pixels reads none."""
    heads = spark.read.format("fits").schema("name string, ny int, nx int").load(_archive(spark, d, "GZIP_2"))
    return heads.select(F.regexp_extract("name", r"(\d+)", 1).cast("long").alias("g"), "ny", "nx")


FIELDS = {0x40: [("id", 40), ("spacecraft_id", 16), ("place", 32)]}


@query("""SELECT id, CAST(spacecraft_id AS BIGINT) AS spacecraft_id, CAST(packet_index AS BIGINT) AS packet_index, ccsds_sequence_count FROM eng_pfw
WHERE id IS NOT NULL AND spacecraft_id IS NOT NULL AND packet_index IS NOT NULL AND ccsds_sequence_count IS NOT NULL""")
def packet_archive(spark, d):
    """Engineering packets as CCSDS space packets, a thousand a file, read again by their dictionary."""
    rows = load(spark, d, "eng_pfw").select("id", "spacecraft_id", "packet_index", "ccsds_sequence_count").dropna()

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for r in pdf.sort_values("id").itertuples():
            body = ((int(r.id) << 48) | (int(r.spacecraft_id) << 32) | int(r.packet_index)).to_bytes(11, "big")
            parts.append(packets.build(0x40, int(r.ccsds_sequence_count), 0, 0, body))
        return pd.DataFrame({"path": [str(int(pdf["id"].iloc[0]) // 1000)], "content": [b"".join(parts)]})

    contents = materialize(rows.groupBy(F.floor(F.col("id") / 1000)).applyInPandas(pack, "path string, content binary"), "packets")
    got = packets.decode_fields(packets.packets(contents), FIELDS)
    return got.where("error IS NULL").select("id", "spacecraft_id", F.col("place").alias("packet_index"), "ccsds_sequence_count")


@query(PX + "SELECT image_id, y, x FROM px WHERE bad")
def mask_archive(spark, d):
    """Masks packed column by column, eight pixels a byte, and unpacked to their set pixels."""
    per = pixels(spark, d).groupBy("image_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("x", "y", "bad"))), lambda p: p["bad"].cast("byte")).alias("m"))

    def pack(batches):
        for pdf in batches:
            yield pd.DataFrame({"image_id": pdf["image_id"], "content": [np.packbits(np.asarray(m, np.uint8)).tobytes() for m in pdf["m"]]})

    return packets.masks(per.mapInPandas(pack, "image_id long, content binary"), "image_id", "content", 8, 8).select(*KEY)


@query("SELECT timestamp AS start_time, packet_index AS start_block, ccsds_packet_length AS replay_length FROM eng_pfw")
def csv_archive(spark, d):
    """A table of requests through CSV with declared columns."""
    folder = scratch_path(spark, "csv")
    e = load(spark, d, "eng_pfw")
    e.select(F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("start_time"), F.col("packet_index").alias("start_block"), F.col("ccsds_packet_length").alias("replay_length")).write.csv(folder, header=True)
    back = tables.read_csv(spark, folder, "replays").where("_bad IS NULL").drop("_bad")
    return back.withColumn("start_time", F.col("start_time").cast("timestamp_ntz"))


@query("""WITH t AS (SELECT tlm_id, bool_or(successful) AS fine, max(num_attempts) AS n FROM tlm_files WHERE tlm_id IS NOT NULL GROUP BY tlm_id),
k AS (SELECT tlm_id, count(*) AS kept FROM eng_ceb WHERE packet_index % 4 = 0 GROUP BY tlm_id)
SELECT t.tlm_id, CASE WHEN fine THEN 'read' ELSE 'failed' END AS outcome, coalesce(n, 0) + 1 AS attempts, CASE WHEN fine THEN coalesce(kept, 0) ELSE 0 END AS kept FROM t LEFT JOIN k ON k.tlm_id = t.tlm_id""")
def bulk_ingest(spark, d):
    """One attempt at each telemetry file: of a readable one every fourth packet is taken, an unreadable one is kept as failed."""
    t = load(spark, d, "tlm_files").where("tlm_id IS NOT NULL").groupBy("tlm_id").agg(F.bool_or("successful").alias("fine"), F.max("num_attempts").alias("n"))
    k = load(spark, d, "eng_ceb").where("packet_index % 4 = 0").groupBy("tlm_id").agg(F.count("*").alias("k"))
    got = t.join(k, "tlm_id", "left")
    return got.select("tlm_id", F.when(F.col("fine"), "read").otherwise("failed").alias("outcome"), (F.coalesce("n", F.lit(0)) + 1).alias("attempts"), F.when(F.col("fine"), F.coalesce("k", F.lit(0))).otherwise(0).cast("long").alias("kept"))


@query("SELECT DISTINCT tlm_id FROM tlm_files WHERE tlm_id IS NOT NULL AND tlm_id NOT IN (SELECT tlm_id FROM sci_xfi WHERE tlm_id IS NOT NULL AND timestamp < TIMESTAMP '2025-10-04 06:00:00')")
def unlisted_files(spark, d):
    """Files that lie in the archive without a row in the packet index as it was on a day."""
    found = load(spark, d, "tlm_files").where("tlm_id IS NOT NULL").select("tlm_id").distinct()
    return packets.new_files(found, load(spark, d, "sci_xfi").where("timestamp < timestamp_ntz'2025-10-04 06:00:00'"), "tlm_id")


@query(with_(FILES) + """SELECT file_id FROM f WHERE level = '1' AND date_beg IS NOT NULL ORDER BY md5('1/' || CAST(file_id AS VARCHAR)), file_id LIMIT 50""")
def random_sample(spark, d):
    """Fifty images drawn with a seed; the draw depends on the ids alone, so it is the same on every cluster."""
    f = files(spark, d).where("level = '1' AND date_beg IS NOT NULL").select("file_id")
    return f.orderBy(F.md5(F.concat(F.lit("1/"), F.col("file_id").cast("string"))), "file_id").limit(50)


TEMPLATE, DENIED = ["observatory", "polarization", "crota", "software_version", "file_version", "state"], ["file_version", "state"]


@query(with_(FILES) + """, e AS (SELECT child, min(parent) AS parent FROM relationships WHERE parent IN (SELECT file_id FROM f) GROUP BY child)
SELECT e.child AS file_id, p.observatory, p.polarization, p.crota, p.software_version FROM e JOIN f p ON p.file_id = e.parent""")
def copied_header(spark, d):
    """A product takes over its first input's values for the columns that its template has and the deny-list doesn't."""
    f = files(spark, d)
    e = load(spark, d, "relationships").join(f.select(F.col("file_id").alias("parent")), "parent", "left_semi").groupBy("child").agg(F.min("parent").alias("parent"))
    kept = [c for c in f.columns if c in TEMPLATE and c not in DENIED]
    return e.join(f, F.col("parent") == f["file_id"]).select(F.col("child").alias("file_id"), *[c for c in TEMPLATE if c in kept])


@query(with_(FILES) + """, k AS (SELECT * FROM (VALUES ('CR'), ('PM'), ('PZ'), ('ZZ')) v(kind))
SELECT k.kind, coalesce(min(date_beg), TIMESTAMP '1900-01-01') AS lo, coalesce(max(date_beg), TIMESTAMP '2900-01-01') AS hi FROM k LEFT JOIN f ON f.file_type = k.kind GROUP BY k.kind""")
def ranges_by_kind(spark, d):
    """The span of each kind of file, with defaults for a kind that has none."""
    kinds = spark.createDataFrame([(k,) for k in ("CR", "PM", "PZ", "ZZ")], "kind string")
    got = files(spark, d).groupBy(F.col("file_type").alias("kind")).agg(F.min("date_beg").alias("lo"), F.max("date_beg").alias("hi"))
    default = lambda c, v: F.coalesce(c, F.lit(v).cast("timestamp_ntz")).alias(c)
    return kinds.join(got, "kind", "left").select("kind", default("lo", "1900-01-01"), default("hi", "2900-01-01"))


@query("""WITH h AS (SELECT date_trunc('hour', end_time) AS hour, count(*) AS n, max(end_time) AS last FROM flows WHERE end_time IS NOT NULL GROUP BY 1), m AS (SELECT max(last) AS now FROM h)
SELECT hour, n, CASE WHEN hour < date_trunc('hour', now) THEN CAST(n AS DOUBLE) WHEN epoch_us(now) - epoch_us(hour) > 120000000 THEN round(n * 3600 / ((epoch_us(now) - epoch_us(hour)) / 1000000), 4) END AS rate FROM h, m""")
def hourly_rate(spark, d):
    """Jobs ended an hour; the last, unfinished hour is carried on at its pace, and left open in its first two minutes."""
    h = load(spark, d, "flows").where("end_time IS NOT NULL").groupBy(F.date_trunc("hour", "end_time").alias("t")).agg(F.count("*").alias("n"), F.max("end_time").alias("last"))
    h = h.withColumn("now", F.max("last").over(Window.partitionBy()))  # one row an hour
    age = (F.unix_micros(F.col("now").cast("timestamp")) - F.unix_micros(F.col("t").cast("timestamp"))) / 1_000_000
    rate = F.when(F.col("t") < F.date_trunc("hour", "now"), F.col("n").cast("double")).when(age > 120, F.round(F.col("n") * 3600 / age, 4))
    return h.select(F.col("t").cast("timestamp_ntz").alias("hour"), "n", rate.alias("rate"))


QUERIES = Q
