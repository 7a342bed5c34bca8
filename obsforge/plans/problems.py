"""The pN_ queries of the general problems, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsforge.catalog import load, micros
from obsforge.operators import hierarchy as hier
from obsforge.operators import intervals, plausibility, redelivery, timestamps
from obsforge.operators.orphans import orphans

PACKET = ["spacecraft_id", "ccsds_sequence_count"]
DAY_US = 86_400_000_000


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return redelivery.redelivered(load(spark, d, "sci_xfi"), "id", PACKET, "timestamp").select("id")


def p1_kept(spark: SparkSession, d: str) -> DataFrame:
    """Packets left per spacecraft once redeliveries are dropped."""
    sci = load(spark, d, "sci_xfi").select("id", "timestamp", *PACKET)
    return redelivery.delivered_once(sci, "id", PACKET, "timestamp").groupBy("spacecraft_id").agg(F.count("*").alias("packets"))


def _tree(spark: SparkSession, d: str) -> hier.Hierarchy:
    return hier.hierarchy(load(spark, d, "relationships"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return _tree(spark, d).nodes


def p2_descendants(spark: SparkSession, d: str) -> DataFrame:
    return hier.descendants(_tree(spark, d).nodes)


def p2_loops(spark: SparkSession, d: str) -> DataFrame:
    return _tree(spark, d).loops


def p2_families(spark: SparkSession, d: str) -> DataFrame:
    return hier.summary(_tree(spark, d).nodes)


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return plausibility.flags(load(spark, d, "health")).where("impossible OR stuck OR spike").select("health_id", "field_name")


def p4_flags(spark: SparkSession, d: str) -> DataFrame:
    """Every flag by name, with the pure peaks-over-threshold one."""
    return plausibility.flags(load(spark, d, "health"))


def p4_cutoffs(spark: SparkSession, d: str) -> DataFrame:
    """The fitted tail and cutoff of each host and field."""
    return plausibility.pot_cutoffs(plausibility.analyse(load(spark, d, "health")))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    got = timestamps.instants(load(spark, d, "files"), "file_id", ["date_created", "date_obs"])
    return got.withColumnRenamed("id", "file_id").distinct()


def p5_rejected(spark: SparkSession, d: str) -> DataFrame:
    """How often each text that denotes no one instant occurs, per field."""
    return timestamps.rejected(load(spark, d, "files"), ["date_created", "date_obs"])


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    files, flows, tlm = (load(spark, d, t) for t in ("files", "flows", "tlm_files"))
    month = lambda c: F.coalesce(F.date_format(c, "yyyy-MM"), F.lit("unknown"))
    out = lambda df, table, i, key, m: df.select(F.lit(table).alias("src_table"), F.col(i).alias("src_id"), F.col(key).cast("long").alias("ref_key"), m.alias("ref_month"))
    # Only orphans need the child's date, so the join comes after the anti-join.
    born = files.groupBy(F.col("file_id").alias("child")).agg(F.min("date_beg").alias("born"))
    links = orphans(load(spark, d, "relationships").select("relationship_id", "parent", "child"), files, ["parent"], ["file_id"])
    links = out(links.join(born, "child", "left"), "relationships", "relationship_id", "parent", month("born"))
    jobs = out(orphans(files.select("file_id", "processing_flow", "date_beg"), flows, ["processing_flow"], ["flow_id"]), "files", "file_id", "processing_flow", month("date_beg"))
    packets = out(orphans(load(spark, d, "sci_xfi").select("id", "tlm_id", "timestamp"), tlm, ["tlm_id"], ["tlm_id"]), "sci_xfi", "id", "tlm_id", month("timestamp"))
    return links.unionByName(jobs).unionByName(packets).distinct()


def p6_report(spark: SparkSession, d: str) -> DataFrame:
    return p6_found(spark, d).groupBy("src_table", "ref_month").agg(F.count("*").alias("orphan_rows"), F.count_distinct("ref_key").alias("missing_keys"))


# Each packet of eng_ceb refers by (spacecraft_id, tlm_id) to the science packets of one file and spacecraft.
PAIR = ["spacecraft_id", "tlm_id"]


def _composite(spark: SparkSession, d: str, match: str) -> DataFrame:
    refs, target = load(spark, d, "eng_ceb").select("id", *PAIR), load(spark, d, "sci_xfi").select(*PAIR)
    return orphans(refs, target, PAIR, PAIR, match).select("id", *PAIR).distinct()


def p6_partial(spark: SparkSession, d: str) -> DataFrame:
    """Composite references; of a partly null one the columns that it has must occur together."""
    return _composite(spark, d, "partial")


def p6_full(spark: SparkSession, d: str) -> DataFrame:
    """Composite references; a partly null one is an orphan."""
    return _composite(spark, d, "full")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return intervals.periods_and_gaps(load(spark, d, "files"), "observatory", "date_beg", "date_end", DAY_US).withColumnRenamed("entity", "observatory")


def p7_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Covered time and number of periods per observatory."""
    return p7_found(spark, d).where("span_kind = 'period'").groupBy("observatory").agg(F.count("*").alias("periods"), F.sum(F.col("end_us") - F.col("beg_us")).alias("covered_us"))


QUERIES = {
    f.__name__: f
    for f in (p1_found, p1_kept, p2_found, p2_descendants, p2_loops, p2_families, p4_found, p4_flags, p4_cutoffs, p5_found, p5_rejected, p6_found, p6_report, p6_partial, p6_full, p7_found, p7_coverage)
}

_P1 = """
WITH p AS (SELECT id, spacecraft_id AS k1, ccsds_sequence_count AS k2, epoch_us(timestamp) AS us, spacecraft_id
           FROM sci_xfi WHERE id IS NOT NULL AND spacecraft_id IS NOT NULL AND ccsds_sequence_count IS NOT NULL AND timestamp IS NOT NULL),
c AS (SELECT *, CASE WHEN us - lag(us) OVER (PARTITION BY k1, k2 ORDER BY us, id) < 1000000 THEN 0 ELSE 1 END AS cut FROM p),
g AS (SELECT *, sum(cut) OVER (PARTITION BY k1, k2 ORDER BY us, id) AS grp FROM c),
f AS (SELECT *, min(id) OVER (PARTITION BY k1, k2, grp) AS first_id FROM g)
"""
_P2 = """
WITH RECURSIVE e AS (SELECT child AS c, min(parent) AS p FROM relationships WHERE child IS NOT NULL AND parent IS NOT NULL GROUP BY child),
ids AS (SELECT parent AS node FROM relationships WHERE parent IS NOT NULL UNION SELECT child FROM relationships WHERE child IS NOT NULL),
down AS (SELECT node, node AS root, 0 AS depth, CAST(node AS VARCHAR) AS path FROM ids WHERE node NOT IN (SELECT c FROM e)
         UNION ALL SELECT e.c, down.root, down.depth + 1, down.path || '/' || CAST(e.c AS VARCHAR) FROM down JOIN e ON e.p = down.node),
bad AS (SELECT node FROM ids WHERE node NOT IN (SELECT node FROM down)),
up AS (SELECT node AS start, node AS at FROM bad UNION SELECT up.start, e.p FROM up JOIN e ON e.c = up.at),
onloop AS (SELECT DISTINCT up.at AS node FROM up JOIN e ON e.c = up.start WHERE up.at = up.start
             AND EXISTS (SELECT 1 FROM up u2 JOIN e e2 ON e2.c = u2.at WHERE u2.start = up.start AND e2.p = up.start)),
lowest AS (SELECT up.start AS node, min(up.at) AS loop_id FROM up WHERE up.at IN (SELECT node FROM onloop) GROUP BY up.start),
nodes AS (SELECT node AS node_id, root AS root_id, CAST(depth AS INTEGER) AS node_depth, path AS node_path FROM down
          UNION ALL SELECT node, loop_id, CAST(-1 AS INTEGER), '' FROM lowest)
"""
_P4 = """
WITH cap AS (SELECT host, CASE WHEN abs(c - round(c)) <= 0.002 * c THEN round(c) ELSE c END AS capacity FROM (
  SELECT host, median(memory_usage / memory_percentage * 100) AS c FROM health
  WHERE memory_usage > 0 AND memory_percentage > 0 AND memory_percentage <= 100 AND memory_usage < 1e9 GROUP BY host)),
r AS (SELECT h.health_id, h.host, epoch_us(datetime) AS us, field_name, v, v < 0 OR coalesce(v > CASE field_name WHEN 'memory_usage' THEN capacity ELSE 100 END, false) AS bad
  FROM (SELECT health_id, host, datetime, 'cpu_usage' AS field_name, cpu_usage AS v FROM health UNION ALL SELECT health_id, host, datetime, 'memory_usage', memory_usage FROM health
        UNION ALL SELECT health_id, host, datetime, 'disk_percentage', disk_percentage FROM health) h LEFT JOIN cap USING (host)
  WHERE v IS NOT NULL AND NOT isnan(v) AND host IS NOT NULL AND datetime IS NOT NULL AND health_id IS NOT NULL),
i AS (SELECT *, sum(new) OVER (PARTITION BY host, field_name ORDER BY us, health_id) AS island FROM (
  SELECT *, CASE WHEN v = lag(v) OVER (PARTITION BY host, field_name ORDER BY us, health_id) THEN 0 ELSE 1 END AS new FROM r)),
s AS (SELECT *, count(*) OVER (PARTITION BY host, field_name, island) >= 20 AS stuck FROM i),
p AS (SELECT *, lag(v) OVER w AS l1, lag(v, 2) OVER w AS l2, lag(v, 3) OVER w AS l3, lead(v) OVER w AS n1, lead(v, 2) OVER w AS n2, lead(v, 3) OVER w AS n3, lag(stuck) OVER w AS lag_stuck
  FROM s WHERE NOT bad WINDOW w AS (PARTITION BY host, field_name ORDER BY us, health_id)),
u AS (SELECT host, field_name, median(round(abs(v - l1), 9)) AS usual FROM p WHERE l1 IS NOT NULL AND NOT stuck AND NOT lag_stuck GROUP BY host, field_name),
h AS (SELECT health_id, field_name, host, greatest(0,
  CASE WHEN l1 IS NOT NULL AND n1 IS NOT NULL THEN greatest(v - greatest(l1, n1), least(l1, n1) - v) END,
  CASE WHEN l1 IS NOT NULL AND n2 IS NOT NULL THEN greatest(least(v, n1) - greatest(l1, n2), least(l1, n2) - greatest(v, n1)) END,
  CASE WHEN l2 IS NOT NULL AND n1 IS NOT NULL THEN greatest(least(l1, v) - greatest(l2, n1), least(l2, n1) - greatest(l1, v)) END,
  CASE WHEN l1 IS NOT NULL AND n3 IS NOT NULL THEN greatest(least(v, n1, n2) - greatest(l1, n3), least(l1, n3) - greatest(v, n1, n2)) END,
  CASE WHEN l2 IS NOT NULL AND n2 IS NOT NULL THEN greatest(least(l1, v, n1) - greatest(l2, n2), least(l2, n2) - greatest(l1, v, n1)) END,
  CASE WHEN l3 IS NOT NULL AND n1 IS NOT NULL THEN greatest(least(l2, l1, v) - greatest(l3, n1), least(l3, n1) - greatest(l2, l1, v)) END) AS height FROM p)
SELECT health_id, field_name FROM s WHERE bad OR stuck
UNION SELECT h.health_id, h.field_name FROM h JOIN u USING (host, field_name) WHERE height > 10 * usual"""
_P6 = """
WITH born AS (SELECT file_id AS child, min(date_beg) AS born FROM files GROUP BY file_id),
found AS (
SELECT 'relationships' AS src_table, r.relationship_id AS src_id, r.parent AS ref_key, coalesce(strftime(b.born, '%Y-%m'), 'unknown') AS ref_month
FROM relationships r LEFT JOIN born b ON b.child = r.child
WHERE r.parent IS NOT NULL AND NOT EXISTS (SELECT 1 FROM files f WHERE f.file_id = r.parent)
UNION SELECT 'files', f.file_id, f.processing_flow, coalesce(strftime(f.date_beg, '%Y-%m'), 'unknown') FROM files f
WHERE f.processing_flow IS NOT NULL AND NOT EXISTS (SELECT 1 FROM flows w WHERE w.flow_id = f.processing_flow)
UNION SELECT 'sci_xfi', s.id, CAST(s.tlm_id AS BIGINT), coalesce(strftime(s.timestamp, '%Y-%m'), 'unknown') FROM sci_xfi s
WHERE s.tlm_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM tlm_files t WHERE t.tlm_id = s.tlm_id))
"""
_P7 = """
WITH s AS (SELECT observatory, epoch_us(date_beg) AS b, epoch_us(date_end) AS e FROM files WHERE observatory IS NOT NULL AND date_beg < date_end),
m AS (SELECT *, max(e) OVER (PARTITION BY observatory ORDER BY b, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM s),
g AS (SELECT *, sum(CASE WHEN reach >= b THEN 0 ELSE 1 END) OVER (PARTITION BY observatory ORDER BY b, e) AS grp FROM m),
p AS (SELECT observatory, min(b) AS beg_us, max(e) AS end_us FROM g GROUP BY observatory, grp),
n AS (SELECT observatory, end_us AS beg_us, lead(beg_us) OVER (PARTITION BY observatory ORDER BY beg_us) AS end_us FROM p),
found AS (SELECT observatory, 'period' AS span_kind, beg_us, end_us FROM p
          UNION ALL SELECT observatory, 'gap', beg_us, end_us FROM n WHERE end_us - beg_us <= 86400000000)
"""
ORACLE = {
    "p1_found": _P1 + "SELECT DISTINCT id FROM f WHERE id <> first_id",
    "p1_kept": _P1 + "SELECT spacecraft_id, count(*) AS packets FROM sci_xfi WHERE id NOT IN (SELECT id FROM f WHERE id <> first_id) GROUP BY spacecraft_id",
    "p2_found": _P2 + "SELECT * FROM nodes",
    "p2_families": _P2 + "SELECT root_id, count(*) AS members, max(node_depth) AS max_depth, min(node_depth) < 0 AS looped FROM nodes GROUP BY root_id",
    "p2_descendants": _P2 + """, hops AS (SELECT down.node AS anc, down.node, 0 AS distance FROM down UNION ALL SELECT hops.anc, e.c, hops.distance + 1 FROM hops JOIN e ON e.p = hops.node)
SELECT anc AS ancestor_id, node AS node_id, CAST(distance AS INTEGER) AS distance FROM hops WHERE distance > 0""",
    "p2_loops": _P2 + "SELECT onloop.node AS node_id, lowest.loop_id FROM onloop JOIN lowest ON lowest.node = onloop.node",
    "p4_found": _P4,
    "p6_partial": """WITH s AS (SELECT DISTINCT spacecraft_id, tlm_id FROM sci_xfi)
SELECT DISTINCT id, spacecraft_id, tlm_id FROM eng_ceb e WHERE CASE WHEN spacecraft_id IS NULL AND tlm_id IS NULL THEN false
WHEN tlm_id IS NULL THEN spacecraft_id NOT IN (SELECT spacecraft_id FROM s WHERE spacecraft_id IS NOT NULL) WHEN spacecraft_id IS NULL THEN tlm_id NOT IN (SELECT tlm_id FROM s WHERE tlm_id IS NOT NULL)
ELSE NOT EXISTS (SELECT 1 FROM s WHERE s.spacecraft_id = e.spacecraft_id AND s.tlm_id = e.tlm_id) END""",
    "p6_full": """SELECT DISTINCT id, spacecraft_id, tlm_id FROM eng_ceb e WHERE (spacecraft_id IS NULL) <> (tlm_id IS NULL) OR (spacecraft_id IS NOT NULL
AND NOT EXISTS (SELECT 1 FROM (SELECT DISTINCT spacecraft_id, tlm_id FROM sci_xfi) s WHERE s.spacecraft_id = e.spacecraft_id AND s.tlm_id = e.tlm_id))""",
    "p6_found": _P6 + "SELECT * FROM found",
    "p6_report": _P6 + "SELECT src_table, ref_month, count(*) AS orphan_rows, count(DISTINCT ref_key) AS missing_keys FROM found GROUP BY src_table, ref_month",
    "p7_found": _P7 + "SELECT * FROM found",
    "p7_coverage": _P7 + "SELECT observatory, count(*) AS periods, CAST(sum(end_us - beg_us) AS BIGINT) AS covered_us FROM found WHERE span_kind = 'period' GROUP BY observatory",
}
