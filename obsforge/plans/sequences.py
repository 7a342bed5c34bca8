"""Queries over ordered rows: groups, windows, readiness, admission, escalation, merging, retries."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Window
from pyspark.sql import functions as F

from obsforge.catalog import load, micros
from obsforge.operators import sequences as seq
from obsforge.operators import slotted
from obsforge.plans.views import FILES, FLOWS, files, flows, query_into, with_

Q: dict = {}
ORACLE: dict[str, str] = {}


query = query_into(Q, ORACLE)


NOW = "2025-10-08 00:00:00"
now_us = int(datetime.fromisoformat(NOW).replace(tzinfo=timezone.utc).timestamp()) * 1_000_000
NOW_SQL = f"epoch_us(TIMESTAMP '{NOW}')"
POL = "p AS (SELECT file_id, observatory, epoch_us(date_beg) AS us, CAST(strpos('MZP', polarization) AS INTEGER) AS code FROM f WHERE date_beg IS NOT NULL AND polarization IN ('M', 'Z', 'P'))"


def pol(spark, d):
    f = files(spark, d).where("date_beg IS NOT NULL AND polarization IN ('M', 'Z', 'P')")
    return f.select("file_id", "observatory", micros("date_beg").alias("us"), F.expr("instr('MZP', polarization)").alias("code"))


CYCLE = """, l AS (SELECT *, code - lag(code) OVER s AS rise, us - lag(us) OVER s AS pause FROM p WINDOW s AS (PARTITION BY observatory ORDER BY us, file_id)),
c AS (SELECT *, sum(CASE WHEN rise <= 0 OR pause > 600000000 * rise OR rise IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY observatory ORDER BY us, file_id) AS cycle FROM l)
"""


@query(with_(FILES, POL) + CYCLE + "SELECT observatory, min(us) AS start_us, count(*) AS n, min(file_id) AS first_file FROM c GROUP BY observatory, cycle")
def cycle_groups(spark, d):
    c = seq.cycles(pol(spark, d), ["observatory"], "us", "code", 600_000_000, "file_id")
    return c.groupBy("observatory", "cycle").agg(F.min("us").alias("start_us"), F.count("*").alias("n"), F.min("file_id").alias("first_file")).drop("cycle")


@query("WITH RECURSIVE " + FILES + ",\n" + POL + CYCLE + """, h AS (SELECT observatory, cycle, min(us) AS us, min(file_id) AS head FROM c GROUP BY observatory, cycle HAVING count(*) = 3),
r AS (SELECT *, row_number() OVER (ORDER BY us, head) AS i FROM h),
g AS (SELECT i, observatory, cycle, us AS anchor, 1 AS n FROM r WHERE i = 1
      UNION ALL SELECT r.i, r.observatory, r.cycle, CASE WHEN r.us - g.anchor > 600000000 OR g.n >= 1000 THEN r.us ELSE g.anchor END,
      CASE WHEN r.us - g.anchor > 600000000 OR g.n >= 1000 THEN 1 ELSE g.n + 1 END FROM g JOIN r ON r.i = g.i + 1)
SELECT g.anchor, c.observatory, c.file_id FROM g JOIN c ON c.observatory = g.observatory AND c.cycle = g.cycle""")
def complete_triplets(spark, d):
    """Complete cycles whose first images lie within ten minutes of a group's first one, over all observatories, expanded again."""
    c = seq.cycles(pol(spark, d), ["observatory"], "us", "code", 600_000_000, "file_id")
    each = Window.partitionBy("observatory", "cycle")
    whole = c.withColumn("n", F.count("*").over(each)).withColumn("head", F.min("file_id").over(each)).where("n = 3")
    heads = whole.groupBy("head").agg(F.min("us").alias("us"))
    groups = seq.anchored_groups(heads, [], "us", "head", 600_000_000, 1000, "head long, us long")
    return whole.join(groups.select("head", "anchor"), "head").select("anchor", "observatory", "file_id")


def _fold_sql(source: str, longest: int, most: int) -> str:
    return f"""WITH RECURSIVE {FILES},
n AS ({source}),
r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY us, file_id) AS i FROM n),
g AS (SELECT k, i, file_id, us, us AS anchor, 1 AS n FROM r WHERE i = 1
      UNION ALL SELECT r.k, r.i, r.file_id, r.us, CASE WHEN r.us - g.anchor > {longest} OR g.n >= {most} THEN r.us ELSE g.anchor END,
      CASE WHEN r.us - g.anchor > {longest} OR g.n >= {most} THEN 1 ELSE g.n + 1 END FROM g JOIN r ON r.k = g.k AND r.i = g.i + 1)
SELECT k AS observatory, file_id, anchor FROM g"""


@query(_fold_sql("SELECT observatory AS k, file_id, epoch_us(date_beg) AS us FROM f WHERE level = '1' AND date_beg IS NOT NULL", 3_600_000_000, 12))
def anchored_groups(spark, d):
    """Groups of at most an hour from their first file and at most twelve files."""
    f = files(spark, d).where("level = '1' AND date_beg IS NOT NULL").select("observatory", "file_id", micros("date_beg").alias("us"))
    return seq.anchored_groups(f, ["observatory"], "us", "file_id", 3_600_000_000, 12, "observatory string, file_id long, us long").select("observatory", "file_id", "anchor")


def _tumbling(name: str, width_us: int, least: int, level: str):
    sql = with_(FILES) + f""", g AS (SELECT observatory, epoch_us(date_beg) // {width_us} AS slot, count(*) AS n, min(file_id) AS first_file, max(epoch_us(date_beg)) AS newest,
count(*) FILTER (WHERE coalesce(outlier, 0) <> 0) AS dropped FROM f WHERE level = '{level}' AND date_beg IS NOT NULL GROUP BY ALL)
SELECT observatory, make_timestamp(slot * {width_us} + {width_us // 2}) AS ref_time, n, dropped, first_file, n - dropped >= {least} AS complete FROM g WHERE n >= {least} OR newest < {NOW_SQL} - 86400000000"""

    def f(spark, d):
        g = files(spark, d).where((F.col("level") == level) & F.col("date_beg").isNotNull()).groupBy("observatory", F.window("date_beg", f"{width_us // 1_000_000} seconds").alias("w"))
        g = g.agg(F.count("*").alias("n"), F.count_if(F.coalesce("outlier", F.lit(0)) != 0).alias("dropped"), F.min("file_id").alias("first_file"), F.max(micros("date_beg")).alias("newest"))
        ref = F.timestamp_micros(micros("w.start") + width_us // 2).cast("timestamp_ntz")
        return g.where((F.col("n") >= least) | (F.col("newest") < now_us - 86_400_000_000)).select("observatory", ref.alias("ref_time"), "n", "dropped", "first_file", (F.col("n") - F.col("dropped") >= least).alias("complete"))

    f.__name__ = name
    Q[name], ORACLE[name] = f, sql


_tumbling("tumbling_low_noise", 1_920_000_000, 4, "2")
_tumbling("tumbling_velocity", 21_600_000_000, 8, "3")


@query(with_(FILES) + """, b AS (SELECT date_trunc('day', min(date_beg)) AS lo, max(date_beg) AS hi FROM f), t AS (SELECT unnest(generate_series(lo, hi, INTERVAL 6 HOUR)) AS ref_time FROM b)
SELECT ref_time, 'waiting' AS state FROM t WHERE ref_time NOT IN (SELECT time_bucket(INTERVAL 6 HOUR, date_beg) FROM f WHERE level = '3' AND file_type = 'PT' AND date_beg IS NOT NULL)""")
def model_grid_missing(spark, d):
    f = files(spark, d)
    span = f.agg(F.date_trunc("day", F.min("date_beg")).cast("timestamp_ntz").alias("lo"), F.max("date_beg").alias("hi"))
    grid = span.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 6 HOUR"))).alias("ref_time"))
    there = f.where("level = '3' AND file_type = 'PT' AND date_beg IS NOT NULL").select(F.window("date_beg", "6 hours")["start"].alias("ref_time"))
    return grid.join(there, "ref_time", "left_anti").select("ref_time", F.lit("waiting").alias("state"))


@query(with_(FILES) + """, t AS (SELECT * FROM (VALUES (TIMESTAMP '2025-10-04 12:00:00'), (TIMESTAMP '2025-10-06 00:00:00'), (TIMESTAMP '2025-11-15 00:00:00')) v(ref_time)),
s AS (SELECT t.ref_time, f.file_id, f.date_beg >= t.ref_time AS later, row_number() OVER (PARTITION BY t.ref_time, f.date_beg >= t.ref_time ORDER BY abs(epoch_us(f.date_beg) - epoch_us(t.ref_time)), f.file_id) AS rn
FROM t JOIN f ON abs(epoch_us(f.date_beg) - epoch_us(t.ref_time)) <= 172800000000 AND f.level = '1' AND NOT coalesce(f.bad_packets, FALSE) AND f.state IN ('created', 'progressed')),
c AS (SELECT ref_time, count(*) FILTER (WHERE later AND rn <= 60) AS after, count(*) FILTER (WHERE NOT later AND rn <= 60) AS before FROM s GROUP BY ref_time)
SELECT t.ref_time, coalesce(before, 0) AS before, coalesce(after, 0) AS after, least(coalesce(before, 0), coalesce(after, 0)) AS used,
CASE WHEN coalesce(before, 0) > 20 AND coalesce(after, 0) > 20 THEN 'ready' WHEN epoch_us(t.ref_time) < epoch_us(TIMESTAMP '2025-10-08 00:00:00') - 172800000000 THEN 'impossible' ELSE 'waiting' END AS verdict
FROM t LEFT JOIN c ON c.ref_time = t.ref_time""")
def half_window_inputs(spark, d):
    """Up to 60 inputs on each side of a reference time, cut to the shorter side; ready, waiting or impossible."""
    times = ["2025-10-04 12:00:00", "2025-10-06 00:00:00", "2025-11-15 00:00:00"]
    t = spark.createDataFrame([(x,) for x in times], "r string").select(F.col("r").cast("timestamp_ntz").alias("ref_time"))
    f = files(spark, d).where("level = '1' AND NOT coalesce(bad_packets, false) AND state IN ('created', 'progressed') AND date_beg IS NOT NULL").select("file_id", micros("date_beg").alias("us"))
    asked = F.explode(F.array(*[F.lit(x).cast("timestamp_ntz") for x in times]))
    near = f.withColumn("ref_time", asked).where(F.abs(F.col("us") - micros("ref_time")) <= 172_800_000_000).withColumn("later", F.col("us") >= micros("ref_time"))
    rank = F.row_number().over(Window.partitionBy("ref_time", "later").orderBy(F.abs(F.col("us") - micros("ref_time")), "file_id"))
    c = near.withColumn("rn", rank).where("rn <= 60").groupBy("ref_time").agg(F.count_if("later").alias("a"), F.count_if(~F.col("later")).alias("b"))
    got = t.join(c, "ref_time", "left").select("ref_time", F.coalesce("b", F.lit(0)).alias("before"), F.coalesce("a", F.lit(0)).alias("after"))
    verdict = F.when((F.col("before") > 20) & (F.col("after") > 20), "ready").when(micros("ref_time") < now_us - 172_800_000_000, "impossible").otherwise("waiting")
    return got.select("ref_time", "before", "after", F.least("before", "after").alias("used"), verdict.alias("verdict"))


@query(with_(FLOWS) + """, q AS (SELECT flow_id, 1 + flow_id % 3 AS weight, row_number() OVER (ORDER BY coalesce(is_backprocessing, FALSE), priority DESC NULLS LAST, creation_time NULLS LAST, flow_id) AS rn FROM w WHERE state = 'planned'),
s AS (SELECT *, coalesce(sum(weight) OVER (ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used FROM q)
SELECT flow_id, weight FROM s WHERE used < 12 AND rn <= 10""")
def admit_prefix(spark, d):
    q = flows(spark, d).where("state = 'planned'").withColumn("weight", 1 + F.col("flow_id") % 3).withColumn("share", F.lit(1))
    order = [F.coalesce("is_backprocessing", F.lit(False)), F.desc_nulls_last("priority"), F.asc_nulls_last("creation_time"), F.col("flow_id")]
    return seq.admit(q, order, "weight", "share", 12, 10).select("flow_id", "weight")


@query(with_(FLOWS) + """SELECT flow_id, CAST((row_number() OVER (PARTITION BY flow_type ORDER BY creation_time NULLS LAST, flow_id) - 1) // 50 AS BIGINT) AS chunk FROM w""")
def batches_of_fifty(spark, d):
    never = F.lit(1 << 56)  # flows without a time come last
    f = flows(spark, d).select("flow_id", "flow_type", F.coalesce(micros("creation_time"), never).alias("us"))
    return slotted.running_sum(f, ["flow_type"], "us", "flow_id", F.lit(1), "i").select("flow_id", F.floor((F.col("i") - 1) / 50).alias("chunk"))


@query(with_(FLOWS) + f"""SELECT flow_id, CAST(greatest(priority, CASE WHEN waited > 30 THEN 10 ELSE 0 END, CASE WHEN waited > 120 THEN 20 ELSE 0 END, CASE WHEN waited > 600 THEN 30 ELSE 0 END) AS INTEGER) AS priority
FROM (SELECT flow_id, priority, ({NOW_SQL} - epoch_us(creation_time)) // 1000000 AS waited FROM w WHERE state = 'planned' AND creation_time IS NOT NULL)""")
def escalated_priorities(spark, d):
    waited = F.floor((F.lit(now_us) - micros("creation_time")) / 1_000_000)
    steps = [F.when(waited > s, F.lit(p)).otherwise(F.lit(0)) for s, p in ((30, 10), (120, 20), (600, 30))]
    return flows(spark, d).where("state = 'planned' AND creation_time IS NOT NULL").select("flow_id", F.greatest("priority", *steps).alias("priority"))


@query("""SELECT health_id, round(avg(cpu_usage) OVER (PARTITION BY host ORDER BY epoch_us(datetime) RANGE BETWEEN 899999999 PRECEDING AND 900000000 FOLLOWING), 6) AS smooth
FROM health WHERE datetime IS NOT NULL""")
def rolling_mean(spark, d):
    """Mean over the half hour around each reading, its left end left out."""
    h = load(spark, d, "health").select("health_id", "host", "cpu_usage", micros("datetime").alias("us"))
    return slotted.time_mean(h, ["host"], "us", "cpu_usage", 900_000_000, 900_000_000, "smooth").select("health_id", F.round("smooth", 6).alias("smooth"))


@query("""WITH s AS (SELECT l_suppkey AS k, l_partkey AS b, l_partkey + CAST(l_quantity AS BIGINT) AS e FROM lineitem),
m AS (SELECT *, max(e) OVER (PARTITION BY k ORDER BY b, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM s),
g AS (SELECT *, sum(CASE WHEN b > reach OR reach IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY k ORDER BY b, e) AS i FROM m)
SELECT k AS l_suppkey, min(b) AS start, max(e) AS "end", count(*) AS requests FROM g GROUP BY k, i""")
def merged_replays(spark, d):
    s = load(spark, d, "lineitem").select("l_suppkey", F.col("l_partkey").alias("start"), F.col("l_quantity").cast("long").alias("length"))
    return seq.merge_blocks(s, ["l_suppkey"], "start", "length")


_RING = "spacecraft_id, 1024 + (id * 7919) % 25000 AS b, CASE WHEN id % 40 = 0 THEN -22000 ELSE id % 5 END AS len FROM eng_pfw WHERE spacecraft_id IS NOT NULL"


@query(f"""WITH r AS (SELECT {_RING}), s AS (SELECT spacecraft_id, b, max(CASE WHEN len < 0 THEN len + 22528 ELSE len END) AS w, count(*) AS n FROM r WHERE b BETWEEN 2048 AND 24575 GROUP BY spacecraft_id, b),
m AS (SELECT *, max(b + w) OVER (PARTITION BY spacecraft_id ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM s),
g AS (SELECT *, sum(CASE WHEN b > reach OR reach IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY spacecraft_id ORDER BY b) AS i FROM m),
k AS (SELECT spacecraft_id, i, min(b) AS b, max(b + w) AS e, sum(n) AS n FROM g GROUP BY spacecraft_id, i),
l AS (SELECT *, max(i) OVER (PARTITION BY spacecraft_id) AS newest, arg_max(e, i) OVER (PARTITION BY spacecraft_id) - 22528 AS over FROM k),
t AS (SELECT *, i < newest AND over > 2048 AND b <= over AS taken FROM l),
u AS (SELECT spacecraft_id, CASE WHEN taken THEN newest ELSE i END AS i, min(b + CASE WHEN taken THEN 22528 ELSE 0 END) AS b, max(e + CASE WHEN taken THEN 22528 ELSE 0 END) AS e, sum(n) AS n FROM t GROUP BY 1, 2)
SELECT spacecraft_id, b AS start_block, CASE WHEN n = 1 THEN e - b ELSE e - b + 1 END AS replay_length, CAST(n AS BIGINT) AS requests FROM u""")
def ring_replays(spark, d):
    """Replay requests per spacecraft on a ring of flash blocks, with requests that wrap around its end."""
    e = load(spark, d, "eng_pfw").where("spacecraft_id IS NOT NULL")
    r = e.select("spacecraft_id", (1024 + F.col("id") * 7919 % 25000).alias("b"), F.when(F.col("id") % 40 == 0, -22000).otherwise(F.col("id") % 5).alias("len"))
    return seq.ring_blocks(r, ["spacecraft_id"], "b", "len")


@query("""WITH p AS (SELECT spacecraft_id, packet_group, ccsds_sequence_count AS n, lag(ccsds_sequence_count) OVER (PARTITION BY spacecraft_id, packet_group ORDER BY timestamp, id) AS before FROM sci_xfi WHERE packet_group IS NOT NULL)
SELECT spacecraft_id, packet_group, count(*) AS packets, bool_and(before IS NULL OR (n - before) IN (1, -16383)) AS contiguous FROM p GROUP BY spacecraft_id, packet_group""")
def packet_contiguity(spark, d):
    """Whether each group's sequence counts follow one another, starting over after 14 bits."""
    w = Window.partitionBy("spacecraft_id", "packet_group").orderBy("timestamp", "id")
    p = load(spark, d, "sci_xfi").where("packet_group IS NOT NULL").select("spacecraft_id", "packet_group", (F.col("ccsds_sequence_count") - F.lag("ccsds_sequence_count").over(w)).alias("step"))
    return p.groupBy("spacecraft_id", "packet_group").agg(F.count("*").alias("packets"), F.bool_and(F.col("step").isNull() | F.col("step").isin(1, -16383)).alias("contiguous"))


@query("""WITH a AS (SELECT spacecraft_id, packet_group, max(coalesce(num_attempts, 0)) AS attempts, max(last_attempt) AS last_attempt FROM sci_xfi WHERE packet_group IS NOT NULL AND (is_used IS NULL OR NOT is_used) GROUP BY ALL)
SELECT spacecraft_id, packet_group, attempts, last_attempt FROM a ORDER BY attempts > 0, last_attempt NULLS FIRST, spacecraft_id, packet_group LIMIT 2000""")
def retry_queue(spark, d):
    """Work never tried first, then the least recently tried; a queue of 2000."""
    a = load(spark, d, "sci_xfi").where("packet_group IS NOT NULL AND (is_used IS NULL OR NOT is_used)").groupBy("spacecraft_id", "packet_group").agg(F.max(F.coalesce("num_attempts", F.lit(0))).alias("attempts"), F.max("last_attempt").alias("last_attempt"))
    return a.orderBy(F.col("attempts") > 0, F.asc_nulls_first("last_attempt"), "spacecraft_id", "packet_group").limit(2000)


@query("""SELECT health_id, last_value(cpu_usage IGNORE NULLS) OVER (PARTITION BY host ORDER BY datetime, health_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_cpu FROM health""")
def last_valid_reading(spark, d):
    h = load(spark, d, "health").select("health_id", "host", "cpu_usage", micros("datetime").alias("us"))
    return slotted.last_value(h, ["host"], "us", "health_id", F.col("cpu_usage"), "last_cpu").select("health_id", "last_cpu")


@query(with_(FILES) + """SELECT file_id, lead(file_id) OVER (PARTITION BY observatory, file_type ORDER BY date_beg, file_id) AS next_file FROM f WHERE level = '3' AND date_beg IS NOT NULL""")
def consecutive_pairs(spark, d):
    f = files(spark, d).where("level = '3' AND date_beg IS NOT NULL").select("file_id", "observatory", "file_type", micros("date_beg").alias("us"))
    return slotted.previous(f, ["observatory", "file_type"], "us", "file_id", ["file_id"], "then", following=True).select("file_id", F.col("then.file_id").alias("next_file"))


@query(with_(FILES) + f""", c AS (SELECT file_id, observatory, date_beg, 1 + file_id % 50 AS size FROM f WHERE date_beg IS NOT NULL),
s AS (SELECT *, sum(size) OVER (PARTITION BY observatory ORDER BY date_beg DESC, file_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS held FROM c)
SELECT file_id, CASE WHEN {NOW_SQL} - epoch_us(date_beg) > 172800000000 THEN 'age' ELSE 'size' END AS reason FROM s WHERE {NOW_SQL} - epoch_us(date_beg) > 172800000000 OR held > 5000""")
def cache_eviction(spark, d):
    """What an age limit and then a size limit, newest first, would drop."""
    c = files(spark, d).where("date_beg IS NOT NULL").select("file_id", "observatory", micros("date_beg").alias("us"), (-F.col("file_id")).alias("tie"))
    held = slotted.running_sum(c, ["observatory"], "us", "tie", 1 + F.col("file_id") % 50, "held", down=True)
    old = F.lit(now_us) - F.col("us") > 172_800_000_000
    return held.where(old | (F.col("held") > 5000)).select("file_id", F.when(old, "age").otherwise("size").alias("reason"))


@query(with_(FLOWS) + """SELECT flow_type, count(*) FILTER (WHERE state = 'planned') AS planned, count(*) FILTER (WHERE state IN ('launched', 'running')) AS busy,
greatest(0, least(10 - count(*) FILTER (WHERE state IN ('launched', 'running')), count(*) FILTER (WHERE state = 'planned'))) AS free FROM w GROUP BY flow_type""")
def launch_capacity(spark, d):
    n = lambda *s: F.count_if(F.col("state").isin(*s))
    w = flows(spark, d).groupBy("flow_type").agg(n("planned").alias("planned"), n("launched", "running").alias("busy"))
    return w.select("flow_type", "planned", "busy", F.greatest(F.lit(0), F.least(10 - F.col("busy"), F.col("planned"))).alias("free"))


@query(with_(FILES) + """, p AS (SELECT DISTINCT level, file_type FROM f), r AS (SELECT level, file_type, count(*) AS n, min(file_id) AS first_file FROM f
WHERE state IN ('created', 'progressed') AND date_beg >= TIMESTAMP '2025-10-05' GROUP BY ALL) SELECT p.level, p.file_type, coalesce(r.n, 0) AS n, r.first_file FROM p LEFT JOIN r ON r.level = p.level AND r.file_type = p.file_type""")
def movie_groups(spark, d):
    """One group for each product, also for those without recent files."""
    f = files(spark, d)
    r = f.where((F.col("state").isin("created", "progressed")) & (F.col("date_beg") >= F.lit("2025-10-05").cast("timestamp_ntz"))).groupBy("level", "file_type").agg(F.count("*").alias("n"), F.min("file_id").alias("first_file"))
    return f.select("level", "file_type").distinct().join(r, ["level", "file_type"], "left").select("level", "file_type", F.coalesce("n", F.lit(0)).alias("n"), "first_file")


QUERIES = Q
