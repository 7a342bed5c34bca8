"""Ready queries and job control: what can run, with which models, and what a failure undoes."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from obsforge.catalog import load, micros
from obsforge.operators import asof
from obsforge.plans.sequences import NOW_SQL, now_us
from obsforge.plans.views import FILES, FLOWS, files, flows, query_into, with_

Q: dict = {}
ORACLE: dict[str, str] = {}


query = query_into(Q, ORACLE)


def _models(f, level, kind):
    m = f.where((F.col("level") == level) & (F.col("file_type") == kind) & F.col("date_beg").isNotNull())
    return m.groupBy("observatory", micros("date_beg").alias("mus")).agg(F.min("file_id").alias("model"))


def _raw(level, types):
    return f"SELECT file_id, observatory, epoch_us(date_beg) AS us FROM f WHERE level = '{level}' AND file_type IN ({types}) AND state IN ('created', 'progressed') AND date_beg IS NOT NULL"


@query(with_(FILES) + f""", o AS ({_raw('0', "'PM', 'PZ', 'PP', 'CR'")}), m AS (SELECT observatory, file_type, epoch_us(date_beg) AS mus, file_id FROM f WHERE level IN ('1', '2') AND date_beg IS NOT NULL),
x AS (SELECT o.file_id, (SELECT count(*) FROM m WHERE m.observatory = o.observatory AND m.file_type = 'PM' AND m.mus <= o.us) AS a, (SELECT count(*) FROM m WHERE m.observatory = o.observatory AND m.file_type = 'CR' AND m.mus <= o.us) AS b FROM o)
SELECT file_id, CASE WHEN a = 0 THEN 'no quartic model' WHEN b = 0 THEN 'no vignetting model' ELSE 'ready' END AS verdict FROM x""")
def level1_early_ready(spark, d):
    """Raw images with the first calibration model that they lack, if any."""
    f = files(spark, d)
    o = f.where(F.col("level").isin("0") & F.col("file_type").isin("PM", "PZ", "PP", "CR") & F.col("state").isin("created", "progressed") & F.col("date_beg").isNotNull()).select("file_id", "observatory", micros("date_beg").alias("us"))
    for n, kind in (("a", "PM"), ("b", "CR")):
        m = f.where(F.col("level").isin("1", "2") & (F.col("file_type") == kind) & F.col("date_beg").isNotNull()).groupBy("observatory").agg(F.min(micros("date_beg")).alias(n))
        o = o.join(m, "observatory", "left")  # one row an observatory
    missing = lambda c: ~F.coalesce(F.col(c) <= F.col("us"), F.lit(False))
    return o.select("file_id", F.when(missing("a"), "no quartic model").when(missing("b"), "no vignetting model").otherwise("ready").alias("verdict"))


@query(with_(FILES) + f""", o AS ({_raw('1', "'PM', 'PZ', 'PP'")}), r AS (SELECT min(epoch_us(date_beg)) AS lo, max(epoch_us(date_beg)) AS hi FROM f WHERE level = '3' AND state IN ('created', 'progressed'))
SELECT o.file_id FROM o, r WHERE o.us BETWEEN r.lo AND r.hi AND NOT EXISTS (SELECT 1 FROM relationships e JOIN f c ON c.file_id = e.child WHERE e.parent = o.file_id AND c.level = '2')""")
def level1_middle_ready(spark, d):
    """Images within the models' span that have no product of the next level yet."""
    f = files(spark, d)
    o = f.where((F.col("level") == "1") & F.col("file_type").isin("PM", "PZ", "PP") & F.col("state").isin("created", "progressed") & F.col("date_beg").isNotNull()).select("file_id", micros("date_beg").alias("us"))
    models = f.where("level = '3' AND state IN ('created', 'progressed')")
    lo, hi = (models.agg(g(micros("date_beg"))).scalar() for g in (F.min, F.max))
    made = load(spark, d, "relationships").join(f.where("level = '2'").select(F.col("file_id").alias("child")), "child").select(F.col("parent").alias("file_id"))
    return o.where(F.col("us").between(lo, hi)).join(made, "file_id", "left_anti").select("file_id")


@query(with_(FILES) + f""", o AS ({_raw('3', "'PM', 'CR', 'PZ', 'PP'")}), m AS (SELECT observatory, epoch_us(date_beg) AS mus FROM f WHERE level = '2' AND date_beg IS NOT NULL)
SELECT o.file_id FROM o WHERE EXISTS (SELECT 1 FROM m WHERE m.observatory = o.observatory AND m.mus < o.us AND o.us - m.mus <= 1800000000)
AND EXISTS (SELECT 1 FROM m WHERE m.observatory = o.observatory AND m.mus > o.us AND m.mus - o.us <= 1800000000)""")
def level3_ready(spark, d):
    """Mosaics with a model within half an hour on both sides."""
    f = files(spark, d)
    o = f.where((F.col("level") == "3") & F.col("file_type").isin("PM", "CR", "PZ", "PP") & F.col("state").isin("created", "progressed") & F.col("date_beg").isNotNull()).select("file_id", "observatory", micros("date_beg").alias("us"))
    m = f.where("level = '2' AND date_beg IS NOT NULL").groupBy("observatory", micros("date_beg").alias("mus")).agg(F.min("file_id").alias("model"))
    got = asof.before_after(o, m, ["observatory"], "us", "mus", "model", strict=True)
    return got.where((F.col("us") - F.col("before.us") <= 1_800_000_000) & (F.col("after.us") - F.col("us") <= 1_800_000_000)).select("file_id")


@query(with_(FILES) + """, g AS (SELECT observatory, epoch_us(date_beg) // 3600000000 AS slot, count(*) AS n, min(epoch_us(date_beg)) AS oldest, bool_or(coalesce(outlier, 0) <> 0) AS any_outlier FROM f WHERE level = '2' AND date_beg IS NOT NULL GROUP BY ALL),
e AS (SELECT observatory, epoch_us(date_beg) // 3600000000 AS slot, count(*) AS expected FROM f WHERE level = '1' AND date_beg IS NOT NULL GROUP BY ALL)
SELECT g.observatory, g.slot, n, coalesce(expected, 0) AS expected, CASE WHEN n >= 3 THEN 'complete' WHEN oldest > """ + NOW_SQL + """ - 86400000000 THEN 'wait' WHEN n = coalesce(expected, 0) THEN 'all there is' ELSE 'short' END AS verdict
FROM g LEFT JOIN e ON e.observatory = g.observatory AND e.slot = g.slot""")
def group_completeness(spark, d):
    """Groups of an hour: complete, waiting, as full as they can get, or short."""
    f = files(spark, d).where("date_beg IS NOT NULL").withColumn("slot", F.floor(micros("date_beg") / 3_600_000_000))
    g = f.where("level = '2'").groupBy("observatory", "slot").agg(F.count("*").alias("n"), F.min(micros("date_beg")).alias("oldest"))
    e = f.where("level = '1'").groupBy("observatory", "slot").agg(F.count("*").alias("e"))
    got = g.join(e, ["observatory", "slot"], "left").withColumn("expected", F.coalesce("e", F.lit(0)))
    verdict = F.when(F.col("n") >= 3, "complete").when(F.col("oldest") > now_us - 86_400_000_000, "wait").when(F.col("n") == F.col("expected"), "all there is").otherwise("short")
    return got.select("observatory", "slot", "n", "expected", verdict.alias("verdict"))


@query(with_(FILES, FLOWS) + """, dead AS (SELECT flow_id FROM w WHERE state = 'failed'), c AS (SELECT file_id FROM f WHERE processing_flow IN (SELECT flow_id FROM dead)),
e AS (SELECT relationship_id, parent FROM relationships WHERE child IN (SELECT file_id FROM c))
SELECT 'file' AS what, file_id AS id, 'delete' AS action FROM c UNION SELECT 'relationship', relationship_id, 'delete' FROM e
UNION SELECT 'file', parent, 'reset' FROM e WHERE parent IN (SELECT file_id FROM f) AND parent NOT IN (SELECT file_id FROM c) UNION SELECT 'flow', flow_id, 'replan' FROM dead""")
def revive_cascade(spark, d):
    """What reviving failed flows deletes, resets and plans again."""
    f = files(spark, d).select("file_id", "processing_flow")
    dead = flows(spark, d).where("state = 'failed'").select("flow_id")
    c = f.join(dead, F.col("processing_flow") == F.col("flow_id"), "left_semi").select("file_id")
    e = load(spark, d, "relationships").join(c.select(F.col("file_id").alias("child")), "child", "left_semi").select("relationship_id", "parent")
    row = lambda df, what, col, action: df.select(F.lit(what).alias("what"), F.col(col).alias("id"), F.lit(action).alias("action"))
    reset = e.select(F.col("parent").alias("file_id")).join(f, "file_id", "left_semi").join(c, "file_id", "left_anti")
    return row(c, "file", "file_id", "delete").unionByName(row(e, "relationship", "relationship_id", "delete")).unionByName(row(reset, "file", "file_id", "reset")).unionByName(row(dead, "flow", "flow_id", "replan")).distinct()


@query(with_(FLOWS) + f"""SELECT flow_id, state, CASE WHEN state IN ('running', 'launched') AND {NOW_SQL} - epoch_us(coalesce(start_time, launch_time, creation_time)) > 21600000000 THEN 'timed_out'
WHEN state = 'being_planned' AND {NOW_SQL} - epoch_us(creation_time) > 3600000000 THEN 'failed' WHEN state = 'revivable' THEN 'planned' ELSE state END AS next_state FROM w""")
def state_machine(spark, d):
    """One step of the clean-up: stuck flows time out, abandoned plans fail, revivable ones are planned again."""
    since = lambda *c: F.lit(now_us) - micros(F.coalesce(*c))
    nxt = F.when(F.col("state").isin("running", "launched") & (since("start_time", "launch_time", "creation_time") > 21_600_000_000), "timed_out")
    nxt = nxt.when((F.col("state") == "being_planned") & (since("creation_time") > 3_600_000_000), "failed").when(F.col("state") == "revivable", "planned").otherwise(F.col("state"))
    return flows(spark, d).select("flow_id", "state", nxt.alias("next_state"))


@query(with_(FLOWS) + """SELECT flow_type, count(*) FILTER (WHERE state IN ('planned', 'launched', 'running')) AS active, count(*) FILTER (WHERE state IN ('planned', 'launched', 'running')) = 0 AS may_start,
greatest(0, 20 - count(*) FILTER (WHERE state IN ('planned', 'launched', 'running'))) AS quota FROM w GROUP BY flow_type""")
def singleton_guard(spark, d):
    """Flow types with nothing under way, and how many more each may plan."""
    active = F.count_if(F.col("state").isin("planned", "launched", "running"))
    return flows(spark, d).groupBy("flow_type").agg(active.alias("active"), (active == 0).alias("may_start"), F.greatest(F.lit(0), 20 - active).alias("quota"))


@query(with_(FILES) + """, q AS (SELECT file_id, date_beg FROM f WHERE level = '1' AND observatory = '4' AND file_type = 'CR' AND coalesce(outlier, 0) = 0 AND date_beg IS NOT NULL ORDER BY date_beg DESC, file_id LIMIT 1000),
t AS (SELECT max(epoch_us(date_beg)) AS newest, count(*) AS n FROM q) SELECT file_id FROM q, t WHERE t.n >= 10 AND t.newest - epoch_us(q.date_beg) <= 1296000000000""")
def residual_batch(spark, d):
    """The newest batch of at most 1000 images and 15 days, if there are enough to fit."""
    q = files(spark, d).where("level = '1' AND observatory = '4' AND file_type = 'CR' AND coalesce(outlier, 0) = 0 AND date_beg IS NOT NULL").orderBy(F.desc("date_beg"), "file_id").limit(1000)
    newest, n = q.agg(F.max(micros("date_beg"))).scalar(), q.agg(F.count("*")).scalar()
    return q.where((newest - micros("date_beg") <= 1_296_000_000_000) & (n >= 10)).select("file_id")


@query(with_(FILES) + """SELECT observatory, file_type, (row_number() OVER (PARTITION BY observatory, file_type ORDER BY date_beg DESC NULLS LAST, file_id) - 1) // 5 + 1 AS batch, file_id
FROM f WHERE level = '3' AND state = 'created'""")
def upload_batch_files(spark, d):
    """All ready products of each kind in successive batches of five, the newest first, those without a date last."""
    w = Window.partitionBy("observatory", "file_type").orderBy(F.desc_nulls_last("date_beg"), "file_id")
    ready = files(spark, d).where("level = '3' AND state = 'created'")
    return ready.select("observatory", "file_type", (F.floor((F.row_number().over(w) - 1) / 5) + 1).alias("batch"), "file_id")


QUERIES = Q
