"""Catalogue queries: filters, joins, aggregates, set operations, names and JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from obsforge.catalog import load
from obsforge.functions import names
from obsforge.operators import filters
from obsforge.plans.views import FILES, FLOWS, files, flows, query_into, with_

Q: dict = {}
ORACLE: dict[str, str] = {}


query = query_into(Q, ORACLE)


@query("""SELECT file_id, file_type, observatory, date_beg FROM files
WHERE level = '1' AND state IN ('created', 'progressed') AND file_type NOT IN ('CR') AND observatory <> '4' AND file_type LIKE 'P%' AND NOT (software_version LIKE 'v%')
AND date_beg BETWEEN TIMESTAMP '2025-10-04 02:00:00' AND TIMESTAMP '2025-12-31 00:00:00' AND minute(date_beg) BETWEEN 10 AND 40""")
def ready_files_filter(spark: SparkSession, d: str) -> DataFrame:
    f = load(spark, d, "files")
    return f.where(
        (F.col("level") == "1") & F.col("state").isin("created", "progressed") & ~F.col("file_type").isin("CR") & (F.col("observatory") != "4")
        & F.col("file_type").startswith("P") & ~F.col("software_version").like("v%")
        & F.col("date_beg").between(F.lit("2025-10-04 02:00:00").cast("timestamp_ntz"), F.lit("2025-12-31").cast("timestamp_ntz")) & F.minute("date_beg").between(10, 40)
    ).select("file_id", "file_type", "observatory", "date_beg")


@query("""SELECT id, timestamp FROM sci_xfi WHERE (is_used IS NULL OR NOT is_used) AND flash_block BETWEEN 2048 AND 24575
AND NOT (timestamp BETWEEN TIMESTAMP '2025-10-04 06:00:00' AND TIMESTAMP '2025-10-04 09:00:00')""")
def unused_packets(spark, d):
    s = load(spark, d, "sci_xfi")
    quiet = F.col("timestamp").between(F.lit("2025-10-04 06:00:00").cast("timestamp_ntz"), F.lit("2025-10-04 09:00:00").cast("timestamp_ntz"))
    return s.where((F.col("is_used").isNull() | ~F.col("is_used")) & F.col("flash_block").between(2048, 24575) & ~quiet).select("id", "timestamp")


@query("SELECT file_id, crota FROM files WHERE abs(crota - 179.5) < 5 OR abs(crota - 179.5) > 355")
def angle_proximity(spark, d):
    return load(spark, d, "files").where(filters.angle_near(F.col("crota"), F.lit(179.5), 5.0)).select("file_id", "crota")


@query("SELECT file_id FROM files WHERE level = '2' AND file_type IN ('PM', 'PZ') AND observatory <> '4' AND observatory <> 'N'")
def filter_dsl_lists(spark, d):
    return filters.apply(load(spark, d, "files"), "{level} eq 2 && {file_type} eq PM,PZ && {observatory} ne 4,N").select("file_id")


@query("SELECT file_id FROM files WHERE file_type LIKE 'C%' AND software_version LIKE '%dev%' AND file_id >= 100")
def filter_dsl_like(spark, d):
    return filters.apply(load(spark, d, "files"), "{file_type} eq C* && {software_version} contains dev && {file_id} ge 100").select("file_id")


@query("SELECT file_id, crota FROM files WHERE crota < 10 AND crota >= -10.5 AND level <> '0'")
def filter_dsl_range(spark, d):
    return filters.apply(load(spark, d, "files"), "{crota} lt 10 && {crota} >= -10.5 && {level} ne 0").select("file_id", "crota")


@query("SELECT file_id FROM files WHERE coalesce(outlier, 0) <> 0 OR coalesce(bad_packets, FALSE)")
def outlier_filter(spark, d):
    return load(spark, d, "files").where("coalesce(outlier, 0) <> 0 OR coalesce(bad_packets, false)").select("file_id")


@query(with_(FILES, FLOWS) + "SELECT w.flow_type, w.state, count(*) AS n FROM f JOIN w ON w.flow_id = f.processing_flow GROUP BY w.flow_type, w.state")
def file_flow_join(spark, d):
    return files(spark, d).select("processing_flow").join(flows(spark, d).select("flow_id", "flow_type", "state"), F.col("flow_id") == F.col("processing_flow")).groupBy("flow_type", "state").agg(F.count("*").alias("n"))


@query(with_(FILES, FLOWS) + """SELECT w.flow_id, count(DISTINCT c.file_id) AS children, count(DISTINCT p.file_id) AS parents
FROM w LEFT JOIN f c ON c.processing_flow = w.flow_id LEFT JOIN relationships r ON r.child = c.file_id LEFT JOIN f p ON p.file_id = r.parent
WHERE w.state <> 'completed' GROUP BY w.flow_id""")
def revivable_chain(spark, d):
    """Flows that did not complete, with the files they made and those files' parents; flows without files stay."""
    f = files(spark, d)
    w = flows(spark, d).where("state <> 'completed'").select("flow_id")
    c = f.select(F.col("file_id").alias("cid"), "processing_flow")
    p = f.select(F.col("file_id").alias("pid"))
    chain = w.join(c, F.col("flow_id") == F.col("processing_flow"), "left").join(load(spark, d, "relationships"), F.col("child") == F.col("cid"), "left").join(p, F.col("pid") == F.col("parent"), "left")
    return chain.groupBy("flow_id").agg(F.count_distinct("cid").alias("children"), F.count_distinct("pid").alias("parents"))


@query(with_(FLOWS) + """, a AS (SELECT flow_level, flow_type, count(*) AS n FROM w WHERE state = 'completed' GROUP BY ALL),
b AS (SELECT flow_level, flow_type, count(*) AS n FROM w WHERE state IN ('failed', 'planned') GROUP BY ALL)
SELECT coalesce(a.flow_level, b.flow_level) AS flow_level, coalesce(a.flow_type, b.flow_type) AS flow_type, coalesce(a.n, 0) AS done, coalesce(b.n, 0) AS waiting
FROM a FULL JOIN b ON a.flow_level = b.flow_level AND a.flow_type = b.flow_type""")
def status_cards(spark, d):
    w = flows(spark, d)
    keys = ["flow_level", "flow_type"]
    a = w.where("state = 'completed'").groupBy(*keys).agg(F.count("*").alias("a"))
    b = w.where("state IN ('failed', 'planned')").groupBy(*keys).agg(F.count("*").alias("b"))
    return a.join(b, keys, "full").select(*keys, F.coalesce("a", F.lit(0)).alias("done"), F.coalesce("b", F.lit(0)).alias("waiting"))


@query(with_(FILES) + """SELECT f.file_id FROM f WHERE f.level = '1' AND NOT EXISTS (SELECT 1 FROM relationships r JOIN f c ON c.file_id = r.child
WHERE r.parent = f.file_id AND c.file_type IN ('PM', 'PZ', 'PP'))""")
def parents_without_child(spark, d):
    f = files(spark, d)
    made = load(spark, d, "relationships").join(f.where(F.col("file_type").isin("PM", "PZ", "PP")).select(F.col("file_id").alias("child")), "child").select(F.col("parent").alias("file_id"))
    return f.where("level = '1'").select("file_id").join(made, "file_id", "left_anti")


@query(with_(FILES, FLOWS) + "SELECT file_id, state FROM f WHERE processing_flow IN (SELECT flow_id FROM w WHERE state = 'running')")
def files_of_running_flows(spark, d):
    running = flows(spark, d).where("state = 'running'").select(F.col("flow_id").alias("processing_flow"))
    return files(spark, d).join(running, "processing_flow", "left_semi").select("file_id", "state")


@query(with_(FILES) + """SELECT a.file_id FROM f a WHERE a.level = '1' AND NOT EXISTS
(SELECT 1 FROM f b WHERE b.level = '2' AND b.observatory = a.observatory AND b.file_type = a.file_type AND date_trunc('minute', b.date_beg) = date_trunc('minute', a.date_beg))""")
def not_yet_produced(spark, d):
    f = files(spark, d).withColumn("minute", F.date_trunc("minute", "date_beg"))
    there = f.where("level = '2'").select("observatory", "file_type", "minute")
    return f.where("level = '1'").join(there, ["observatory", "file_type", "minute"], "left_anti").select("file_id")


@query(with_(FILES) + """SELECT p.file_id AS parent, c.file_id AS child FROM f p JOIN f c ON c.processing_flow = p.processing_flow AND p.level = '0' AND c.level = '1'""")
def lineage_product(spark, d):
    """Every input of a flow with every output of it; bounded by what one flow handles."""
    f = files(spark, d).select("file_id", "level", "processing_flow")
    p = f.where("level = '0'").select(F.col("file_id").alias("parent"), "processing_flow")
    c = f.where("level = '1'").select(F.col("file_id").alias("child"), "processing_flow")
    return p.join(c, "processing_flow").select("parent", "child")


@query(with_(FILES) + """, n AS (SELECT *, row_number() OVER (PARTITION BY processing_flow, level ORDER BY file_id) AS i FROM f WHERE processing_flow IS NOT NULL)
SELECT p.file_id AS parent, c.file_id AS child FROM n p JOIN n c ON c.processing_flow = p.processing_flow AND c.i = p.i AND p.level = '0' AND c.level = '1'""")
def lineage_one_to_one(spark, d):
    f = files(spark, d).where("processing_flow IS NOT NULL AND level IN ('0', '1')").withColumn("i", F.row_number().over(Window.partitionBy("processing_flow", "level").orderBy("file_id")))
    p = f.where("level = '0'").select(F.col("file_id").alias("parent"), "processing_flow", "i")
    c = f.where("level = '1'").select(F.col("file_id").alias("child"), "processing_flow", "i")
    return p.join(c, ["processing_flow", "i"]).select("parent", "child")


@query(with_(FLOWS) + """SELECT flow_type, count(*) AS n, CAST(sum(CASE WHEN state = 'planned' THEN 1 + flow_id % 3 ELSE 0 END) AS BIGINT) AS planned_weight,
CAST(sum(CASE WHEN state IN ('running', 'launched') THEN 1 + flow_id % 3 ELSE 0 END) AS BIGINT) AS running_weight FROM w GROUP BY flow_type""")
def flow_weights(spark, d):
    w = flows(spark, d).withColumn("weight", 1 + F.col("flow_id") % 3)
    total = lambda c: F.sum(F.when(c, F.col("weight")).otherwise(0))
    return w.groupBy("flow_type").agg(F.count("*").alias("n"), total(F.col("state") == "planned").alias("planned_weight"), total(F.col("state").isin("running", "launched")).alias("running_weight"))


@query(with_(FLOWS) + """SELECT flow_level, count(*) FILTER (WHERE state = 'planned') AS planned, count(*) FILTER (WHERE state = 'running') AS running, count(*) FILTER (WHERE state = 'completed') AS completed,
count(*) FILTER (WHERE state = 'failed') AS failed FROM w GROUP BY flow_level""")
def state_counts(spark, d):
    states = ("planned", "running", "completed", "failed")
    return flows(spark, d).groupBy("flow_level").agg(*[F.count_if(F.col("state") == s).alias(s) for s in states])


@query(with_(FLOWS) + """SELECT flow_type, state, date_trunc('hour', end_time) AS hour, count(*) AS n, round(avg(epoch_us(end_time) - epoch_us(start_time)) / 1e6, 8) AS mean_s
FROM w WHERE end_time IS NOT NULL AND start_time IS NOT NULL GROUP BY ALL""")
def hourly_throughput(spark, d):
    w = flows(spark, d).where("end_time IS NOT NULL AND start_time IS NOT NULL")
    us = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    return w.groupBy("flow_type", "state", F.date_trunc("hour", "end_time").cast("timestamp_ntz").alias("hour")).agg(F.count("*").alias("n"), F.round(F.avg(us("end_time") - us("start_time")) / 1e6, 8).alias("mean_s"))


@query(with_(FLOWS) + """, b AS (SELECT date_trunc('hour', min(end_time)) AS lo, date_trunc('hour', max(end_time)) AS hi FROM w),
h AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS hour FROM b), t AS (SELECT DISTINCT flow_type FROM w), s AS (SELECT unnest(['failed', 'completed']) AS state),
c AS (SELECT flow_type, state, date_trunc('hour', end_time) AS hour, count(*) AS n FROM w GROUP BY ALL)
SELECT g.hour, g.flow_type, g.state, coalesce(c.n, 0) AS n FROM (SELECT * FROM h, t, s) g LEFT JOIN c ON c.hour = g.hour AND c.flow_type = g.flow_type AND c.state = g.state""")
def gap_filled_hours(spark, d):
    """Counts for every hour, flow type and end state, zero where nothing ended; the grid is hours x types x 2."""
    w = flows(spark, d)
    span = w.agg(F.date_trunc("hour", F.min("end_time")).alias("lo"), F.date_trunc("hour", F.max("end_time")).alias("hi"))
    hours = span.select(F.explode(F.sequence(F.col("lo").cast("timestamp_ntz"), F.col("hi").cast("timestamp_ntz"), F.expr("INTERVAL 1 HOUR"))).alias("hour"))
    types = w.agg(F.collect_set("flow_type")).scalar()  # as many as there are flow types
    grid = hours.withColumn("flow_type", F.explode(types)).withColumn("state", F.explode(F.array(F.lit("failed"), F.lit("completed"))))
    counts = w.groupBy(F.date_trunc("hour", "end_time").cast("timestamp_ntz").alias("hour"), "flow_type", "state").agg(F.count("*").alias("c"))
    return grid.join(counts, ["hour", "flow_type", "state"], "left").select("hour", "flow_type", "state", F.coalesce("c", F.lit(0)).alias("n"))


@query("SELECT level, file_type, observatory, state, count(*) AS n FROM files GROUP BY level, file_type, observatory, state")
def dynamic_group_count(spark, d):
    by = ["level", "file_type", "observatory", "state"]
    return load(spark, d, "files").groupBy(*by).agg(F.count("*").alias("n"))


@query(with_(FILES) + """, g AS (SELECT file_id, level, CAST(floor(epoch_us(date_beg) / 900000000.0 + 0.5) AS BIGINT) AS slot FROM f WHERE date_beg IS NOT NULL)
SELECT level, slot, count(*) AS n, min(file_id) AS representative FROM g GROUP BY level, slot""")
def rounded_time_groups(spark, d):
    """Quarter hours, rounded half up, with one representative file each."""
    f = files(spark, d).where("date_beg IS NOT NULL").withColumn("slot", F.floor(F.unix_micros(F.col("date_beg").cast("timestamp")) / 900000000.0 + 0.5))
    return f.groupBy("level", "slot").agg(F.count("*").alias("n"), F.min("file_id").alias("representative"))


@query(with_(FILES) + """, e AS (SELECT * FROM (VALUES ('1', 'PM', 50), ('2', 'CR', 20), ('3', 'PT', 1), ('9', 'XX', 1)) v(level, file_type, least))
SELECT e.level, e.file_type, count(f.file_id) AS n, count(f.file_id) < e.least AS alarm FROM e LEFT JOIN f ON f.level = e.level AND f.file_type = e.file_type GROUP BY e.level, e.file_type, e.least""")
def product_watchdog(spark, d):
    expected = spark.createDataFrame([("1", "PM", 50), ("2", "CR", 20), ("3", "PT", 1), ("9", "XX", 1)], "level string, file_type string, least int")
    n = files(spark, d).groupBy("level", "file_type").agg(F.count("*").alias("c"))
    return F.broadcast(expected).join(n, ["level", "file_type"], "left").select("level", "file_type", F.coalesce("c", F.lit(0)).alias("n"), (F.coalesce("c", F.lit(0)) < F.col("least")).alias("alarm"))


@query("SELECT DISTINCT spacecraft_id, date_trunc('second', timestamp) AS second FROM sci_xfi WHERE is_used IS NULL OR NOT is_used")
def distinct_work_items(spark, d):
    return load(spark, d, "sci_xfi").where("is_used IS NULL OR NOT is_used").select("spacecraft_id", F.date_trunc("second", "timestamp").cast("timestamp_ntz").alias("second")).distinct()


@query("""WITH g AS (SELECT *, count(*) OVER (PARTITION BY level, file_type, observatory, date_beg) AS n,
row_number() OVER (PARTITION BY level, file_type, observatory, date_beg ORDER BY file_id, state) AS rn FROM files WHERE date_beg IS NOT NULL)
SELECT file_id, state FROM g WHERE n > 1 AND rn > 1""")
def duplicates_to_delete(spark, d):
    """All but the first of the files that agree in level, type, observatory and date."""
    w = Window.partitionBy("level", "file_type", "observatory", "date_beg")
    return load(spark, d, "files").where("date_beg IS NOT NULL").withColumn("rn", F.row_number().over(w.orderBy("file_id", "state"))).where("rn > 1").select("file_id", "state")


@query("SELECT spacecraft_id, ccsds_sequence_count, max(id) AS id, arg_max(tlm_id, id) AS tlm_id FROM sci_xfi GROUP BY spacecraft_id, ccsds_sequence_count")
def latest_replay_packet(spark, d):
    """A null tlm_id of the latest packet is passed over, as max_by passes over nothing but the order."""
    s = load(spark, d, "sci_xfi").select("spacecraft_id", "ccsds_sequence_count", "id", "tlm_id")
    return s.groupBy("spacecraft_id", "ccsds_sequence_count").agg(F.max("id").alias("id"), F.max_by("tlm_id", F.when(F.col("tlm_id").isNotNull(), F.col("id"))).alias("tlm_id"))


@query("SELECT last_skip_reason, count(*) AS n FROM sci_xfi WHERE last_skip_reason IS NOT NULL GROUP BY last_skip_reason ORDER BY n DESC, last_skip_reason")
def skip_reasons(spark, d):
    return load(spark, d, "sci_xfi").where("last_skip_reason IS NOT NULL").groupBy("last_skip_reason").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "last_skip_reason")


@query(with_(FILES) + """SELECT processing_flow, bool_or(coalesce(bad_packets, FALSE)) AS any_bad, min(date_beg) AS beg, max(date_end) AS "end",
make_timestamp(CAST(floor(avg(epoch_us(date_beg))) AS BIGINT)) AS mean_date, count(*) AS n FROM f WHERE processing_flow IS NOT NULL AND date_beg IS NOT NULL GROUP BY processing_flow""")
def group_flags_and_dates(spark, d):
    f = files(spark, d).where("processing_flow IS NOT NULL AND date_beg IS NOT NULL")
    mean = F.timestamp_micros(F.floor(F.avg(F.unix_micros(F.col("date_beg").cast("timestamp"))))).cast("timestamp_ntz")
    return f.groupBy("processing_flow").agg(F.bool_or(F.coalesce("bad_packets", F.lit(False))).alias("any_bad"), F.min("date_beg").alias("beg"), F.max("date_end").alias("end"), mean.alias("mean_date"), F.count("*").alias("n"))


@query("SELECT DISTINCT tlm_id FROM sci_xfi WHERE tlm_id IS NOT NULL AND tlm_id NOT IN (SELECT tlm_id FROM tlm_files WHERE tlm_id IS NOT NULL)")
def undelivered_files(spark, d):
    return load(spark, d, "sci_xfi").select("tlm_id").where("tlm_id IS NOT NULL").distinct().join(load(spark, d, "tlm_files").select("tlm_id"), "tlm_id", "left_anti")


@query("""SELECT node, count(*) AS sides FROM (SELECT DISTINCT parent AS node, 'p' AS side FROM relationships UNION SELECT DISTINCT child, 'c' FROM relationships) GROUP BY node""")
def parents_or_children(spark, d):
    r = load(spark, d, "relationships")
    both = r.select(F.col("parent").alias("node"), F.lit("p").alias("side")).unionByName(r.select(F.col("child").alias("node"), F.lit("c").alias("side"))).distinct()
    return both.groupBy("node").agg(F.count("*").alias("sides"))


@query("SELECT parent AS node FROM relationships INTERSECT SELECT child FROM relationships")
def parents_and_children(spark, d):
    r = load(spark, d, "relationships")
    return r.select(F.col("parent").alias("node")).intersect(r.select("child"))


@query("SELECT ccsds_sequence_count AS n, spacecraft_id FROM eng_ceb EXCEPT SELECT ccsds_sequence_count, spacecraft_id FROM eng_pfw")
def packets_only_in_one(spark, d):
    a, b = load(spark, d, "eng_ceb"), load(spark, d, "eng_pfw")
    return a.select(F.col("ccsds_sequence_count").alias("n"), "spacecraft_id").subtract(b.select("ccsds_sequence_count", "spacecraft_id"))


@query("SELECT DISTINCT tlm_id, path FROM (SELECT tlm_id, path FROM tlm_files UNION ALL SELECT tlm_id, path FROM tlm_files WHERE successful)")
def concat_and_drop_duplicates(spark, d):
    t = load(spark, d, "tlm_files")
    return t.select("tlm_id", "path").unionByName(t.where("successful").select("tlm_id", "path")).dropDuplicates()


@query(with_(FILES) + """SELECT a.file_id, b.file_id AS twin FROM f a JOIN f b ON a.level = b.level AND a.file_type = b.file_type AND a.observatory = b.observatory AND a.date_beg IS NOT DISTINCT FROM b.date_beg
AND a.polarization IS NOT DISTINCT FROM b.polarization AND a.file_version = b.file_version AND a.file_id < b.file_id AND a.date_beg IS NOT NULL""")
def natural_key_twins(spark, d):
    """Files that an import would find by the natural key, nulls equal to nulls."""
    f = files(spark, d).where("date_beg IS NOT NULL").select("file_id", "level", "file_type", "observatory", "date_beg", "polarization", "file_version")
    a, b = f.alias("a"), f.alias("b")
    on = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("level", "file_type", "observatory", "date_beg", "file_version")] + [F.col("a.polarization").eqNullSafe(F.col("b.polarization"))]
    return a.join(b, [*on, F.col("a.file_id") < F.col("b.file_id")]).select("a.file_id", F.col("b.file_id").alias("twin"))


@query(with_(FILES) + """, g AS (SELECT * FROM (VALUES ('1'), ('2')) a(level), (VALUES ('PM'), ('CR'), ('XX')) b(file_type))
SELECT g.level, g.file_type, f.date_beg, max(f.file_version) AS newest FROM g LEFT JOIN f ON f.level = g.level AND f.file_type = g.file_type GROUP BY ALL""")
def search_newest_versions(spark, d):
    """A grid of requested attributes, and the newest version of each time stamp."""
    grid = spark.createDataFrame([(a, b) for a in ("1", "2") for b in ("PM", "CR", "XX")], "level string, file_type string")
    f = files(spark, d).groupBy("level", "file_type", "date_beg").agg(F.max("file_version").alias("newest"))
    return F.broadcast(grid).join(f, ["level", "file_type"], "left").select("level", "file_type", "date_beg", "newest")


@query(with_(FILES) + """SELECT file_id, 'OBS_L' || level || '_' || file_type || observatory || '_' || strftime(date_beg, '%Y%m%d%H%M%S') || '_v' || file_version || '.fits' AS name,
level || '/' || file_type || observatory || '/' || strftime(date_beg, '%Y/%m/%d') AS dir FROM f WHERE date_beg IS NOT NULL""")
def file_names(spark, d):
    f = files(spark, d).where("date_beg IS NOT NULL")
    c = [F.col(x) for x in ("level", "file_type", "observatory", "date_beg")]
    return f.select("file_id", names.file_name(*c, F.col("file_version")).alias("name"), names.directory(*c).alias("dir"))


@query(with_(FILES) + """SELECT file_id, level, file_type AS kind, observatory, date_trunc('second', date_beg) AS date, file_version AS version,
CASE WHEN file_type[2] IN ('M', 'Z', 'P') THEN file_type[2] WHEN file_type[2] = 'R' THEN 'C' END AS polarization FROM f WHERE date_beg IS NOT NULL""")
def parsed_names(spark, d):
    return file_names(spark, d).select("file_id", names.parse_name(F.col("name")).alias("p")).select("file_id", "p.*")


@query("""WITH n AS (SELECT tlm_id, path, split_part(path, '/', -1) AS base FROM tlm_files)
SELECT tlm_id, base, sha256(path) AS digest, replace(base, '.tlm', '_v2.tlm') AS renamed FROM n""")
def path_parts(spark, d):
    base = F.split_part(F.col("path"), F.lit("/"), F.lit(-1))
    return load(spark, d, "tlm_files").select("tlm_id", base.alias("base"), F.sha2("path", 256).alias("digest"), F.replace(base, F.lit(".tlm"), F.lit("_v2.tlm")).alias("renamed"))


@query(with_(FILES) + """SELECT file_id, regexp_replace('OBS_v' || file_version || '.fits', '_v0c\\.fits', '_v0d.fits') AS name,
replace(replace('{LEVEL}-{TYPE} by {WHO}', '{LEVEL}', level), '{TYPE}', file_type) AS title FROM f""")
def rewritten_versions(spark, d):
    name = F.concat(F.lit("OBS_v"), "file_version", F.lit(".fits"))
    return files(spark, d).select("file_id", names.rewrite_version(name, "0c", "0d").alias("name"), names.fill_template("{LEVEL}-{TYPE} by {WHO}", LEVEL=F.col("level"), TYPE=F.col("file_type")).alias("title"))


@query(with_(FLOWS) + """SELECT flow_id, call_data ->> '$.preset' AS preset, CAST(json_array_length(call_data, '$.file_ids') AS INTEGER) AS n_files, CAST(call_data ->> '$.file_ids[0]' AS BIGINT) AS first_file
FROM w WHERE call_data IS NOT NULL""")
def call_data_fields(spark, d):
    w = flows(spark, d).where("call_data IS NOT NULL").withColumn("j", F.from_json("call_data", "file_ids array<bigint>, preset string"))
    return w.select("flow_id", "j.preset", F.size("j.file_ids").alias("n_files"), F.try_element_at("j.file_ids", F.lit(1)).alias("first_file"))


@query(with_(FLOWS) + """SELECT flow_id, file_id FROM (SELECT flow_id, CAST(unnest(CAST(call_data -> '$.file_ids' AS BIGINT[])) AS BIGINT) AS file_id FROM w WHERE call_data IS NOT NULL)""")
def call_data_files(spark, d):
    w = flows(spark, d).where("call_data IS NOT NULL")
    return w.select("flow_id", F.explode(F.from_json("call_data", "file_ids array<bigint>")["file_ids"]).alias("file_id"))


@query(with_(FLOWS) + "SELECT flow_id, concat_ws(' ', flow_level, flow_type, state) AS label, upper(left(flow_type, 3)) AS short FROM w")
def flow_labels(spark, d):
    return flows(spark, d).select("flow_id", F.concat_ws(" ", "flow_level", "flow_type", "state").alias("label"), F.upper(F.substring("flow_type", 1, 3)).alias("short"))


@query(with_(FLOWS) + "SELECT flow_id, priority, creation_time FROM w ORDER BY is_backprocessing NULLS FIRST, priority DESC NULLS LAST, creation_time NULLS FIRST, flow_id LIMIT 20 OFFSET 10")
def page_of_flows(spark, d):
    order = ["is_backprocessing", F.desc("priority"), "creation_time", "flow_id"]
    return flows(spark, d).orderBy(*order).offset(10).limit(20).select("flow_id", "priority", "creation_time")


@query(with_(FILES) + """SELECT file_id, date_beg FROM f WHERE level = '1' AND date_beg IS NOT NULL
ORDER BY abs(epoch_us(date_beg) - epoch_us(TIMESTAMP '2025-10-04 12:00:00')) // 1000000, file_id LIMIT 25""")
def nearest_to_target(spark, d):
    gap = F.floor(F.abs(F.unix_micros(F.col("date_beg").cast("timestamp")) - F.unix_micros(F.lit("2025-10-04 12:00:00").cast("timestamp"))) / 1000000)
    return files(spark, d).where("level = '1' AND date_beg IS NOT NULL").orderBy(gap, "file_id").limit(25).select("file_id", "date_beg")


@query("SELECT count(*) AS n, count(*) FILTER (WHERE successful) AS good, round(count(*) FILTER (WHERE NOT successful) / count(*), 6) AS failed_share, count(*) FILTER (WHERE NOT successful) / count(*) <= 0.5 AS within_budget FROM tlm_files")
def fault_budget(spark, d):
    bad = F.count_if(~F.col("successful")) / F.count("*")
    return load(spark, d, "tlm_files").agg(F.count("*").alias("n"), F.count_if("successful").alias("good"), F.round(bad, 6).alias("failed_share"), (bad <= 0.5).alias("within_budget"))


@query("""SELECT host, date_trunc('hour', datetime) AS hour, round(avg(cpu_usage), 6) AS cpu, max(num_pids) AS pids, count(*) AS n FROM health GROUP BY ALL""")
def health_by_hour(spark, d):
    h = load(spark, d, "health")
    return h.groupBy("host", F.date_trunc("hour", "datetime").cast("timestamp_ntz").alias("hour")).agg(F.round(F.avg("cpu_usage"), 6).alias("cpu"), F.max("num_pids").alias("pids"), F.count("*").alias("n"))


@query("""SELECT p_brand, p_type, count(*) AS n, round(avg(p_retailprice), 4) AS mean_price FROM part JOIN lineitem ON l_partkey = p_partkey GROUP BY p_brand, p_type""")
def dimension_join(spark, d):
    return load(spark, d, "lineitem").select("l_partkey").join(load(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey")).groupBy("p_brand", "p_type").agg(F.count("*").alias("n"), F.round(F.avg("p_retailprice"), 4).alias("mean_price"))


QUERIES = Q
