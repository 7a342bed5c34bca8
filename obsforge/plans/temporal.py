"""Queries that match rows in time: as-of, bracketing, nearest, overlapping and neighbouring rows."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from obsforge.catalog import load, micros
from obsforge.operators import asof
from obsforge.plans.views import FILES, files, query_into, with_

Q: dict = {}
ORACLE: dict[str, str] = {}


query = query_into(Q, ORACLE)


# Observations are level 1 files; calibration models are level 3 files of the same observatory.
OBS = "o AS (SELECT file_id, observatory, date_beg AS t, epoch_us(date_beg) AS us FROM f WHERE level = '1' AND date_beg IS NOT NULL)"
MODELS = "m AS (SELECT file_id AS model, observatory, date_beg AS mt, epoch_us(date_beg) AS mus, file_version AS version, state FROM f WHERE level = '3' AND date_beg IS NOT NULL)"


def obs(spark, d):
    return files(spark, d).where("level = '1' AND date_beg IS NOT NULL").select("file_id", "observatory", F.col("date_beg").alias("t"), micros("date_beg").alias("us"))


def models(spark, d):
    f = files(spark, d).where("level = '3' AND date_beg IS NOT NULL")
    return f.select(F.col("file_id").alias("model"), "observatory", F.col("date_beg").alias("mt"), micros("date_beg").alias("mus"), F.col("file_version").alias("version"), "state")


@query(with_(FILES, OBS, MODELS) + """SELECT o.file_id, (SELECT model FROM m WHERE m.observatory = o.observatory AND m.mus <= o.us AND NOT m.version LIKE 'v%'
ORDER BY m.version DESC, m.mus DESC, m.model DESC LIMIT 1) AS model FROM o""")
def asof_versioned(spark, d):
    """The newest version comes before the newest date; versions that start with v are left out."""
    good = models(spark, d).where("NOT version LIKE 'v%'")
    best = asof.asof_best(obs(spark, d), good, ["observatory"], "us", "mus", F.struct("version", "mus", "model"), "backward")
    return best.select("file_id", F.col("best.model").alias("model"))


@query(with_(FILES, OBS, MODELS) + """SELECT o.file_id, (SELECT model FROM m WHERE m.observatory = o.observatory AND m.mus >= o.us
ORDER BY m.version DESC, m.mus, m.model DESC LIMIT 1) AS model FROM o""")
def asof_forward_versioned(spark, d):
    """The highest version, then the earliest date, among models at or after the observation."""
    m = models(spark, d).withColumn("neg", -F.col("mus"))
    best = asof.asof_best(obs(spark, d), m, ["observatory"], "us", "mus", F.struct("version", "neg", "model"), "forward")
    return best.select("file_id", F.col("best.model").alias("model"))


@query(with_(FILES, OBS, MODELS) + """, u AS (SELECT observatory, mus, min(model) AS model, bool_or(model % 7 = 0) AS impossible FROM m GROUP BY observatory, mus),
b AS (SELECT o.file_id, o.observatory, o.us, (SELECT struct_pack(us := mus, id := model, bad := impossible) FROM u WHERE u.observatory = o.observatory AND u.mus < o.us ORDER BY mus DESC LIMIT 1) AS p,
(SELECT struct_pack(us := mus, id := model, bad := impossible) FROM u WHERE u.observatory = o.observatory AND u.mus > o.us ORDER BY mus LIMIT 1) AS n,
EXISTS (SELECT 1 FROM u WHERE u.observatory = o.observatory AND u.mus = o.us) AS exact FROM o)
SELECT file_id, CASE WHEN exact OR p IS NULL OR n IS NULL THEN 'wait' WHEN p.bad OR n.bad THEN 'nearest' ELSE 'bracket' END AS kind,
CASE WHEN exact OR p IS NULL OR n IS NULL THEN NULL WHEN p.bad OR n.bad THEN (SELECT min(model) FROM (SELECT model FROM u WHERE u.observatory = b.observatory AND NOT impossible
ORDER BY abs(mus - b.us), mus LIMIT 2)) ELSE least(p.id, n.id) END AS first_model FROM b""")
def bracket_pair(spark, d):
    """The models strictly before and after; if one of them is impossible, the two nearest possible ones; else wait."""
    m = models(spark, d).groupBy("observatory", "mus").agg(F.min("model").alias("model"), F.bool_or(F.col("model") % 7 == 0).alias("impossible"))
    return asof.bracket(obs(spark, d), m, ["observatory"], "file_id", "us", "mus", "model", "impossible").select("file_id", "kind", F.least("first", "second").alias("first_model"))


@query(with_(FILES, OBS, MODELS) + """, p AS (SELECT o.file_id, m.model, m.mus, abs(m.mus - o.us) AS gap FROM o JOIN m ON m.observatory = o.observatory AND abs(m.mus - o.us) < 86400000000),
r AS (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY gap, mus, model) AS rn, count(*) OVER (PARTITION BY file_id) AS n FROM p)
SELECT file_id, model, CAST(rn AS INTEGER) AS rank FROM r WHERE rn <= 2 AND n >= 2""")
def nearest_two(spark, d):
    """The two nearest models within a day, none if there are fewer than two."""
    near = asof.nearest_k(obs(spark, d), models(spark, d), ["observatory"], "file_id", "us", "mus", "model", 2, 86_400_000_000)
    both = near.withColumn("n", F.count("*").over(Window.partitionBy("file_id")))
    return both.where("n >= 2").select("file_id", "model", "rank")


@query(with_(FILES, OBS, MODELS) + """SELECT o.file_id,
(SELECT model FROM m WHERE m.observatory = o.observatory AND mus <= o.us ORDER BY mus DESC, model LIMIT 1) AS before,
(SELECT model FROM m WHERE m.observatory = o.observatory AND mus >= o.us ORDER BY mus, model LIMIT 1) AS after,
(SELECT model FROM m WHERE m.observatory = o.observatory ORDER BY abs(mus - o.us), model LIMIT 1) AS nearest FROM o""")
def nearest_single(spark, d):
    m = models(spark, d).groupBy("observatory", "mus").agg(F.min("model").alias("model"))
    got = asof.before_after(obs(spark, d), m, ["observatory"], "us", "mus", "model")
    gap = lambda c: F.when(F.col(c).isNotNull(), F.struct(F.abs(F.col("us") - F.col(f"{c}.us")), F.col(f"{c}.id").alias("id")))
    return got.select("file_id", F.col("before.id").alias("before"), F.col("after.id").alias("after"), F.least(gap("before"), gap("after"))["id"].alias("nearest"))


@query(with_(FILES) + """, q AS (SELECT file_id, abs(epoch_us(date_beg) - epoch_us(TIMESTAMP '2025-10-05 00:00:00')) // 1000000 AS dt FROM f
WHERE level = '1' AND date_beg IS NOT NULL AND coalesce(outlier, 0) = 0), a AS (SELECT * FROM q WHERE dt > 600 ORDER BY dt, file_id LIMIT 40)
SELECT file_id FROM a WHERE file_id NOT IN (SELECT file_id FROM f WHERE level = '1' AND file_id % 5 = 0) ORDER BY dt, file_id LIMIT 30""")
def fitting_set(spark, d):
    """Nearest images outside an exclusion gap, without the inputs, topped up to a target number."""
    dt = F.floor(F.abs(micros("date_beg") - F.unix_micros(F.lit("2025-10-05 00:00:00").cast("timestamp"))) / 1000000)
    q = files(spark, d).where("level = '1' AND date_beg IS NOT NULL AND coalesce(outlier, 0) = 0").select("file_id", dt.alias("dt"))
    inputs = files(spark, d).where("level = '1' AND file_id % 5 = 0").select("file_id")
    return q.where("dt > 600").orderBy("dt", "file_id").limit(40).join(inputs, "file_id", "left_anti").orderBy("dt", "file_id").limit(30).select("file_id")


@query("""WITH s AS (SELECT id, spacecraft_id AS sc, epoch_us(timestamp) AS us FROM eng_pfw WHERE timestamp IS NOT NULL), e AS (SELECT id AS eid, spacecraft_id AS sc, epoch_us(timestamp) AS eus FROM eng_ceb WHERE timestamp IS NOT NULL)
SELECT s.id, (SELECT eid FROM e WHERE e.sc = s.sc AND e.eus <= s.us AND e.eus >= s.us - 60000000 ORDER BY eus DESC, eid LIMIT 1) AS before,
(SELECT eid FROM e WHERE e.sc = s.sc AND e.eus >= s.us AND e.eus <= s.us + 60000000 ORDER BY eus, eid LIMIT 1) AS after FROM s""")
def packets_around(spark, d):
    """The packet of another table at or before and at or after, within a minute."""
    s = load(spark, d, "eng_pfw").where("timestamp IS NOT NULL").select("id", F.col("spacecraft_id").alias("sc"), micros("timestamp").alias("us"))
    e = load(spark, d, "eng_ceb").where("timestamp IS NOT NULL").groupBy(F.col("spacecraft_id").alias("sc"), micros("timestamp").alias("eus")).agg(F.min("id").alias("eid"))
    got = asof.before_after(s, e, ["sc"], "us", "eus", "eid")
    near = lambda c: F.when(F.abs(F.col("us") - F.col(f"{c}.us")) <= 60_000_000, F.col(f"{c}.id"))
    return got.select("id", near("before").alias("before"), near("after").alias("after"))


SPANS = "s AS (SELECT file_id, observatory, epoch_us(date_beg) AS b, epoch_us(date_end) AS e FROM f WHERE date_beg < date_end)"


@query(with_(FILES, SPANS) + """, x AS (SELECT a.file_id, p.file_id AS pulse, CASE WHEN p.b <= a.b AND p.e >= a.e THEN 1 WHEN p.b <= a.b THEN 2 WHEN p.e >= a.e THEN 3 ELSE 4 END AS overlap_case
FROM s a JOIN s p ON p.observatory = a.observatory AND p.b <= a.e AND p.e >= a.b AND a.file_id % 2 = 0 AND p.file_id % 2 = 1)
SELECT file_id, pulse, CAST(overlap_case AS INTEGER) AS overlap_case FROM x QUALIFY row_number() OVER (PARTITION BY file_id ORDER BY overlap_case, pulse) = 1""")
def interval_overlap(spark, d):
    """The first pulse that covers an exposure, overlaps its begin, its end, or lies within it, in this order."""
    s = files(spark, d).where("date_beg < date_end").select("file_id", "observatory", micros("date_beg").alias("b"), micros("date_end").alias("e"))
    a, p = s.where("file_id % 2 = 0"), s.where("file_id % 2 = 1").select(F.col("file_id").alias("pulse"), "observatory", F.col("b").alias("pb"), F.col("e").alias("pe"))
    x = asof.overlap_join(a, p, ["observatory"], ("b", "e"), ("pb", "pe"), 3_600_000_000)
    case = F.when((F.col("pb") <= F.col("b")) & (F.col("pe") >= F.col("e")), 1).when(F.col("pb") <= F.col("b"), 2).when(F.col("pe") >= F.col("e"), 3).otherwise(4)
    best = x.groupBy("file_id").agg(F.min(F.struct(case.alias("overlap_case"), F.col("pulse"))).alias("m"))
    return best.select("file_id", "m.pulse", "m.overlap_case")


@query(with_(FILES) + """, n AS (SELECT file_id, observatory, crota, epoch_us(date_beg) AS us FROM f WHERE date_beg IS NOT NULL AND crota IS NOT NULL AND NOT coalesce(bad_packets, FALSE)),
x AS (SELECT a.file_id, b.file_id AS neighbour, b.us FROM n a JOIN n b ON a.observatory = b.observatory AND a.file_id <> b.file_id AND abs(a.us - b.us) < 900000000
AND (abs(a.crota - b.crota) <= 20.0 OR abs(a.crota - b.crota) >= 340.0))
SELECT file_id, neighbour FROM x QUALIFY row_number() OVER (PARTITION BY file_id, us ORDER BY neighbour DESC) = 1""")
def rotation_neighbours(spark, d):
    """Images of one observatory within 15 minutes and 20 degrees of roll, one per time, without the image itself."""
    n = files(spark, d).where("date_beg IS NOT NULL AND crota IS NOT NULL AND NOT coalesce(bad_packets, false)").select("file_id", "observatory", "crota", micros("date_beg").alias("us"))
    b = n.select(F.col("file_id").alias("neighbour"), "observatory", F.col("crota").alias("c2"), F.col("us").alias("us2"))
    x = asof.within(n, b, ["observatory"], "us", "us2", 900_000_000, strict=True)
    gap = F.abs(F.col("crota") - F.col("c2"))
    x = x.where((F.col("file_id") != F.col("neighbour")) & ((gap <= 20.0) | (gap >= 340.0)))
    return x.groupBy("file_id", "us2").agg(F.max("neighbour").alias("neighbour")).select("file_id", "neighbour")


@query(with_(FILES) + """, p AS (SELECT file_id, observatory, epoch_us(date_beg) AS us, (epoch_us(date_beg) // 60000000) % 8 AS phase FROM f WHERE date_beg IS NOT NULL)
SELECT a.file_id AS first_id, (SELECT b.file_id FROM p b WHERE b.observatory = a.observatory AND b.phase >= 4 AND b.us > a.us AND b.us - a.us < 480000000 ORDER BY b.us, b.file_id LIMIT 1) AS second_id
FROM p a WHERE a.phase < 4""")
def phase_pairs(spark, d):
    """Each image of the first half cycle with the next one of the second half within 8 minutes; partners may be shared."""
    p = files(spark, d).where("date_beg IS NOT NULL").select("file_id", "observatory", micros("date_beg").alias("us")).withColumn("phase", F.pmod(F.floor(F.col("us") / 60_000_000), F.lit(8)))
    second = p.where("phase >= 4").groupBy("observatory", F.col("us").alias("us2")).agg(F.min("file_id").alias("second"))
    got = asof.before_after(p.where("phase < 4"), second, ["observatory"], "us", "us2", "second", strict=True)
    return got.select(F.col("file_id").alias("first_id"), F.when(F.col("after.us") - F.col("us") < 480_000_000, F.col("after.id")).alias("second_id"))


def _triplet_sql(letter: str) -> str:
    return f"(SELECT b.file_id FROM q b WHERE b.observatory = z.observatory AND b.polarization = '{letter}' ORDER BY abs(b.us - z.us), b.us, b.file_id LIMIT 1) AS {letter.lower()}_id"


@query(with_(FILES) + f""", q AS (SELECT file_id, observatory, polarization, epoch_us(date_beg) AS us FROM f WHERE date_beg IS NOT NULL),
t AS (SELECT z.file_id AS z_id, z.us, {_triplet_sql('M')}, {_triplet_sql('P')} FROM q z WHERE z.polarization = 'Z')
SELECT z_id, m_id, p_id FROM t JOIN q m ON m.file_id = m_id JOIN q p ON p.file_id = p_id WHERE abs(m.us - t.us) <= 900000000 AND abs(p.us - t.us) <= 900000000""")
def polarizer_triplets(spark, d):
    """Each Z image with the nearest M and the nearest P, both within 15 minutes."""
    q = files(spark, d).where("date_beg IS NOT NULL").select("file_id", "observatory", "polarization", micros("date_beg").alias("us"))
    out = q.where("polarization = 'Z'").select(F.col("file_id").alias("z_id"), "observatory", "us")
    for letter in "MP":
        side = q.where(F.col("polarization") == letter).groupBy("observatory", F.col("us").alias("us2")).agg(F.min("file_id").alias("id2"))
        got = asof.before_after(out, side, ["observatory"], "us", "us2", "id2")
        gap = lambda c: F.when(F.col(c).isNotNull(), F.struct(F.abs(F.col("us") - F.col(f"{c}.us")).alias("gap"), F.col(f"{c}.us").alias("at"), F.col(f"{c}.id").alias("id")))
        best = F.least(gap("before"), gap("after"))
        out = got.withColumn("best", best).where("best.gap <= 900000000").withColumn(f"{letter.lower()}_id", F.col("best.id")).drop("before", "after", "best")
    return out.select("z_id", "m_id", "p_id")


@query("""WITH s AS (SELECT vec_id, label, embedding[1] AS x, embedding[2] AS y FROM embeddings), c AS (SELECT label AS c_id, CAST(embedding[1] AS DOUBLE) AS cx, CAST(embedding[2] AS DOUBLE) AS cy, vec_id AS star FROM embeddings WHERE vec_id % 10 = 0)
SELECT s.vec_id, (SELECT star FROM c WHERE abs(cx - s.x) <= 0.05 AND abs(cy - s.y) <= 0.05 ORDER BY (cx - s.x) * (cx - s.x) + (cy - s.y) * (cy - s.y), star LIMIT 1) AS star FROM s""")
def spatial_nearest(spark, d):
    """The nearest catalogue star within a small box, through grid cells of the box's size."""
    e = load(spark, d, "embeddings").select("vec_id", F.element_at("embedding", 1).cast("double").alias("x"), F.element_at("embedding", 2).cast("double").alias("y"))
    stars = e.where("vec_id % 10 = 0").select(F.col("vec_id").alias("star"), F.col("x").alias("cx"), F.col("y").alias("cy"))
    return asof.nearest_in_grid(e, stars, "vec_id", ("x", "y"), "star", ("cx", "cy"), 0.05)


@query("""WITH s AS (SELECT vec_id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y FROM embeddings), c AS (SELECT vec_id AS star, embedding[1]::DOUBLE AS cx, embedding[2]::DOUBLE AS cy FROM embeddings WHERE vec_id % 10 = 0)
SELECT vec_id, arg_min(star, (d, star)) AS star FROM (SELECT vec_id, star, (cx - x) * (cx - x) + (cy - y) * (cy - y) AS d FROM s, c) GROUP BY vec_id""")
def spatial_nearest_any(spark, d):
    """The nearest catalogue star of each point, however far it lies."""
    e = load(spark, d, "embeddings").select("vec_id", F.element_at("embedding", 1).cast("double").alias("x"), F.element_at("embedding", 2).cast("double").alias("y"))
    stars = e.where("vec_id % 10 = 0").select(F.col("vec_id").alias("star"), F.col("x").alias("cx"), F.col("y").alias("cy"))
    return asof.nearest_anywhere(e, stars, "vec_id", ("x", "y"), "star", ("cx", "cy"), 0.05)


@query(with_(FILES) + """SELECT file_id, file_type, CASE WHEN file_type[2] = 'R' THEN 'C' WHEN file_type[2] IN ('M', 'Z', 'P') THEN 'P' END AS model_kind,
CASE observatory WHEN '1' THEN 4.9 WHEN '2' THEN 4.9 WHEN '3' THEN 4.94 WHEN '4' THEN 4.89 END AS gain FROM f""")
def model_lookup(spark, d):
    """A dimension lookup by a small constant map; what has no entry stays null."""
    gain = F.create_map(*[F.lit(x) for kv in {"1": 4.9, "2": 4.9, "3": 4.94, "4": 4.89}.items() for x in kv])
    second = F.substring("file_type", 2, 1)
    kind = F.when(second == "R", "C").when(second.isin("M", "Z", "P"), "P")
    return files(spark, d).select("file_id", "file_type", kind.alias("model_kind"), F.try_element_at(gain, F.col("observatory")).cast("decimal(3,2)").alias("gain"))


@query(with_(FILES) + """, x AS (SELECT a.file_id, count(b.file_id) AS n FROM f a LEFT JOIN f b ON b.processing_flow = a.processing_flow AND b.level = a.level GROUP BY a.file_id)
SELECT file_id, n, CASE WHEN n = 1 THEN 'ok' WHEN n = 0 THEN 'missing' ELSE 'ambiguous' END AS verdict FROM x""")
def output_match(spark, d):
    """How many outputs a flow's file agrees with; exactly one is right."""
    f = files(spark, d).select("file_id", "processing_flow", "level")
    n = f.where("processing_flow IS NOT NULL AND level IS NOT NULL").groupBy("processing_flow", "level").agg(F.count("*").alias("c"))
    got = f.join(n, ["processing_flow", "level"], "left").withColumn("n", F.coalesce("c", F.lit(0)))
    return got.select("file_id", "n", F.when(F.col("n") == 1, "ok").when(F.col("n") == 0, "missing").otherwise("ambiguous").alias("verdict"))


@query(with_(FILES) + """, c AS (SELECT observatory, date_trunc('minute', date_beg) AS m FROM f WHERE level = '0' AND date_beg IS NOT NULL)
SELECT a.file_id, (SELECT count(*) FROM c WHERE c.observatory = a.observatory AND abs(epoch_us(c.m) - epoch_us(a.date_beg)) <= 1200000000) AS expected
FROM f a WHERE a.level = '2' AND a.date_beg IS NOT NULL""")
def expected_inputs(spark, d):
    """How many raw files lie within twenty minutes of a product: decides whether a group can still fill up."""
    f = files(spark, d).where("date_beg IS NOT NULL")
    a = f.where("level = '2'").select("file_id", "observatory", micros("date_beg").alias("us"))
    c = f.where("level = '0'").select("observatory", micros(F.date_trunc("minute", "date_beg")).alias("us2"))
    return asof.count_within(a, c, ["observatory"], "file_id", "us", "us2", 1_200_000_000, "expected")


QUERIES = Q
