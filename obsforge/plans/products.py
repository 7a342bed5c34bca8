"""Queries for whole products: readiness of each product line, model inputs, and the remaining image operators."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from obsforge.catalog import load, micros
from obsforge.operators import asof, kernels, stencils
from obsforge.plans.pixels import KEY, NEAR, PX, r6
from obsforge.plans.sequences import NOW_SQL, now_us
from obsforge.plans.views import FILES, files, pixels, query_into, with_

Q: dict = {}
ORACLE: dict[str, str] = {}
query = query_into(Q, ORACLE)


def _obs(f, level, *types):
    return f.where((F.col("level") == level) & F.col("file_type").isin(*types) & F.col("state").isin("created", "progressed") & F.col("date_beg").isNotNull()).select("file_id", "observatory", micros("date_beg").alias("us"))


def _obs_sql(level, types):
    return f"o AS (SELECT file_id, observatory, epoch_us(date_beg) AS us FROM f WHERE level = '{level}' AND file_type IN ({types}) AND state IN ('created', 'progressed') AND date_beg IS NOT NULL)"


NO_CHILD = "NOT EXISTS (SELECT 1 FROM relationships e JOIN f c ON c.file_id = e.child WHERE e.parent = o.file_id AND c.level = '{level}')"


def _childless(spark, d, o, f, level):
    made = load(spark, d, "relationships").join(f.where(F.col("level") == level).select(F.col("file_id").alias("child")), "child").select(F.col("parent").alias("file_id"))
    return o.join(made, "file_id", "left_anti")


@query(with_(FILES, _obs_sql("1", "'CR', 'PM'")) + f""", m AS (SELECT file_id AS model, observatory, epoch_us(date_beg) AS mus FROM f WHERE level = '3' AND state = 'created' AND date_beg IS NOT NULL)
SELECT o.file_id, count(m.model) AS models FROM o LEFT JOIN m ON m.observatory = o.observatory AND abs(m.mus - o.us) < 7200000000 WHERE {NO_CHILD.format(level='2')} GROUP BY o.file_id HAVING count(m.model) >= 2""")
def level1_quick_ready(spark, d):
    """Images without a quick product that have two models near enough; missing ones are counted, not compared with nothing."""
    f = files(spark, d)
    o = _childless(spark, d, _obs(f, "1", "CR", "PM"), f, "2")
    m = f.where("level = '3' AND state = 'created' AND date_beg IS NOT NULL").select("observatory", micros("date_beg").alias("mus"))
    return asof.count_within(o, m, ["observatory"], "file_id", "us", "mus", 7_200_000_000 - 1, "models").where("models >= 2")


@query(with_(FILES, _obs_sql("1", "'PM', 'PZ', 'PP', 'CR'")) + f""", m AS (SELECT observatory, min(epoch_us(date_beg)) AS lo, max(epoch_us(date_beg)) AS hi FROM f WHERE level = '3' AND date_beg IS NOT NULL GROUP BY observatory)
SELECT o.file_id FROM o JOIN m ON m.observatory = o.observatory WHERE o.us > m.lo AND o.us < m.hi AND {NO_CHILD.format(level='2')}""")
def level1_late_ready(spark, d):
    f = files(spark, d)
    span = f.where("level = '3' AND date_beg IS NOT NULL").groupBy("observatory").agg(F.min(micros("date_beg")).alias("lo"), F.max(micros("date_beg")).alias("hi"))
    o = _obs(f, "1", "PM", "PZ", "PP", "CR").join(span, "observatory").where("us > lo AND us < hi")
    return _childless(spark, d, o, f, "2").select("file_id")


@query(with_(FILES, _obs_sql("2", "'PM', 'PZ', 'PP', 'CR'")) + """, m AS (SELECT observatory, epoch_us(date_beg) AS mus FROM f WHERE level = '3' AND date_beg IS NOT NULL),
b AS (SELECT observatory, us // 1800000000 AS slot, us, EXISTS (SELECT 1 FROM m WHERE m.observatory = o.observatory AND m.mus < o.us) AND EXISTS (SELECT 1 FROM m WHERE m.observatory = o.observatory AND m.mus > o.us) AS has FROM o)
SELECT observatory, slot, count(*) AS n, bool_and(has) AS ready FROM b GROUP BY observatory, slot HAVING max(us) < """ + NOW_SQL + " + 30 * 86400000000")
def mosaic_groups_ready(spark, d):
    """Groups all of whose members have a model before and after."""
    f = files(spark, d)
    m = f.where("level = '3' AND date_beg IS NOT NULL").groupBy("observatory", micros("date_beg").alias("mus")).agg(F.min("file_id").alias("model"))
    got = asof.before_after(_obs(f, "2", "PM", "PZ", "PP", "CR"), m, ["observatory"], "us", "mus", "model", strict=True)
    g = got.groupBy("observatory", F.floor(F.col("us") / 1_800_000_000).alias("slot"))
    return g.agg(F.count("*").alias("n"), F.bool_and(F.col("before").isNotNull() & F.col("after").isNotNull()).alias("ready"), F.max("us").alias("last")).where(F.col("last") < now_us + 30 * 86_400_000_000).drop("last")


def _halves_sql(level, types, extra, most):
    return with_(FILES) + f""", t AS (SELECT unnest(generate_series(TIMESTAMP '2025-10-04 12:00:00', TIMESTAMP '2025-10-07 00:00:00', INTERVAL 12 HOUR)) AS ref_time),
s AS (SELECT t.ref_time, f.date_beg >= t.ref_time AS later, row_number() OVER (PARTITION BY t.ref_time, f.date_beg >= t.ref_time ORDER BY abs(epoch_us(f.date_beg) - epoch_us(t.ref_time)), f.file_id) AS rn
FROM t JOIN f ON f.level = '{level}' AND f.file_type IN ({types}) AND f.date_beg IS NOT NULL AND {extra})
SELECT ref_time, count(*) FILTER (WHERE later) AS after, count(*) FILTER (WHERE NOT later) AS before, count(*) FILTER (WHERE later) > 10 AND count(*) FILTER (WHERE NOT later) > 10 AS ready FROM s WHERE rn <= {most} GROUP BY ref_time"""


def _halves(spark, d, level, types, extra, most):
    """Inputs on each side of a grid of reference times; strictly more than ten a side make a model."""
    grid = F.explode(F.expr("sequence(timestamp_ntz'2025-10-04 12:00:00', timestamp_ntz'2025-10-07 00:00:00', interval 12 hour)"))
    f = files(spark, d).where((F.col("level") == level) & F.col("file_type").isin(*types) & F.col("date_beg").isNotNull()).where(extra).select("file_id", micros("date_beg").alias("us"))
    near = f.withColumn("ref_time", grid).withColumn("gap", F.abs(F.col("us") - micros("ref_time"))).withColumn("later", F.col("us") >= micros("ref_time"))
    rank = F.row_number().over(Window.partitionBy("ref_time", "later").orderBy("gap", "file_id"))
    c = near.withColumn("rn", rank).where(F.col("rn") <= most).groupBy("ref_time").agg(F.count_if("later").alias("after"), F.count_if(~F.col("later")).alias("before"))
    return c.select("ref_time", "after", "before", ((F.col("after") > 10) & (F.col("before") > 10)).alias("ready"))


@query(_halves_sql("1", "'PM', 'PZ', 'PP', 'CR'", "NOT coalesce(f.bad_packets, FALSE)", 40))
def stray_light_inputs(spark, d):
    return _halves(spark, d, "1", ("PM", "PZ", "PP", "CR"), "NOT coalesce(bad_packets, false)", 40)


@query(_halves_sql("2", "'PM', 'CR'", "coalesce(f.outlier, 0) = 0", 25))
def background_inputs(spark, d):
    return _halves(spark, d, "2", ("PM", "CR"), "coalesce(outlier, 0) = 0", 25)


@query(_halves_sql("3", "'PM', 'CR', 'PZ', 'PP'", "coalesce(f.outlier, 0) = 0", 30))
def starfield_inputs(spark, d):
    return _halves(spark, d, "3", ("PM", "CR", "PZ", "PP"), "coalesce(outlier, 0) = 0", 30)


@query("SELECT make_timestamp(epoch_us(TIMESTAMP '2025-10-04') + i * 240000000) AS ref_time, CAST(i % 8 AS INTEGER) AS phase FROM range(0, 360) t(i)")
def simulation_times(spark, d):
    t = spark.range(360).select((F.col("id") * 240_000_000 + 1_759_536_000_000_000).alias("us"), (F.col("id") % 8).cast("int").alias("phase"))
    return t.select(F.timestamp_micros("us").cast("timestamp_ntz").alias("ref_time"), "phase")


# --- Images ---


@query(PX + NEAR.format(r=1) + """, s AS (SELECT image_id, y, x, bool_or(v > 0.15) AS near_full FROM nb GROUP BY image_id, y, x), f AS (SELECT image_id, y, count(*) FILTER (WHERE v > 0.15) AS n FROM px GROUP BY image_id, y)
SELECT s.image_id, s.y, s.x FROM s JOIN f ON f.image_id = s.image_id AND f.y = s.y WHERE near_full OR n > 3""")
def saturated_pixels(spark, d):
    """Saturated pixels, their neighbours, and whole rows with too many of them."""
    px = pixels(spark, d).withColumn("full", F.col("v") > 0.15)
    rows = px.groupBy("image_id", "y").agg(F.count_if("full").alias("n"))
    return stencils.dilate(px, "full", 1, 8, 8).join(rows, ["image_id", "y"]).where("full OR n > 3").select(*KEY)


@query(PX + """, n AS (SELECT obs, image_id, y, x, v, lead(image_id) OVER (PARTITION BY obs, y, x ORDER BY image_id) AS nxt FROM px),
c AS (SELECT n.image_id, CAST(n.x // 4 AS INTEGER) AS band, k.lag_, avg(n.v * a.v) AS corr FROM n JOIN (SELECT unnest([-2, -1, 0, 1, 2]) AS lag_) k ON TRUE JOIN px a ON a.image_id = n.nxt AND a.y = greatest(0, least(7, n.y + k.lag_)) AND a.x = n.x GROUP BY ALL)
SELECT image_id, band, CAST(arg_max(lag_, round(corr, 9) * 1000 - lag_ * 1e-9) AS INTEGER) AS lag, round(max(corr), 6) AS corr FROM c GROUP BY image_id, band""")
def velocity_peaks(spark, d):
    """The lag of greatest correlation of successive images in each band of x."""
    px = pixels(spark, d)
    b = px.withColumn("nxt", F.lead("image_id").over(Window.partitionBy("obs", "y", "x").orderBy("image_id"))).where("nxt IS NOT NULL")
    b = b.withColumn("lag", F.explode(F.sequence(F.lit(-2), F.lit(2)))).select("image_id", "nxt", "lag", "x", "v", F.greatest(F.lit(0), F.least(F.lit(7), F.col("y") + F.col("lag"))).alias("y"))
    a = px.select(F.col("image_id").alias("nxt"), "y", "x", F.col("v").alias("v2"))
    c = b.join(a, ["nxt", "y", "x"]).groupBy("image_id", F.floor(F.col("x") / 4).cast("int").alias("band"), "lag").agg(F.avg(F.col("v") * F.col("v2")).alias("corr"))
    return c.groupBy("image_id", "band").agg(F.max_by("lag", F.round("corr", 9) * 1000 - F.col("lag") * 1e-9).cast("int").alias("lag"), r6(F.max("corr"), "corr"))


SKY = """, sky AS (SELECT image_id, y, x, v, bad, y + CAST(image_id % 3 AS INTEGER) AS sy, x + CAST(image_id % 2 AS INTEGER) AS sx FROM px), m AS (SELECT sy, sx, median(v) AS star, count(*) AS n FROM sky WHERE NOT bad GROUP BY sy, sx)
"""


def _sky(spark, d):
    return pixels(spark, d).withColumn("sy", F.col("y") + (F.col("image_id") % 3).cast("int")).withColumn("sx", F.col("x") + (F.col("image_id") % 2).cast("int"))


@query(PX + SKY + "SELECT sy, sx, round(star, 6) AS star, n FROM m")
def starfield_model(spark, d):
    """The usual value of each sky cell over all pointings."""
    return _sky(spark, d).where("NOT bad").groupBy("sy", "sx").agg(r6(F.median("v"), "star"), F.count("*").alias("n"))


@query(PX + SKY + "SELECT sky.image_id, sky.y, sky.x, round(v - coalesce(star, 0), 6) AS v FROM sky LEFT JOIN m ON m.sy = sky.sy AND m.sx = sky.sx")
def star_subtracted(spark, d):
    sky = _sky(spark, d)
    m = sky.where("NOT bad").groupBy("sy", "sx").agg(F.median("v").alias("star"))  # one row a sky cell: gathered back by a join
    return sky.join(m, ["sy", "sx"], "left").select(*KEY, r6(F.col("v") - F.coalesce("star", F.lit(0.0)), "v"))


@query(PX + "SELECT y, x, round(avg(v) / (SELECT avg(v) FROM px WHERE NOT bad), 6) AS flat FROM px WHERE NOT bad GROUP BY y, x")
def flat_average(spark, d):
    good = pixels(spark, d).where("NOT bad")
    mean = good.agg(F.avg("v")).scalar()
    return good.groupBy("y", "x").agg(F.avg("v").alias("a")).select("y", "x", r6(F.col("a") / mean, "flat"))


@query("""WITH a AS (SELECT observatory, crota, degrees(atan2(avg(sin(radians(crota))) OVER w, avg(cos(radians(crota))) OVER w)) AS centre FROM files WHERE crota IS NOT NULL WINDOW w AS (PARTITION BY observatory))
SELECT observatory, round(median(crota - centre - 360 * round((crota - centre) / 360, 0)), 4) AS median_offset, count(*) AS n FROM a GROUP BY observatory""")
def pointing_offsets(spark, d):
    """Median of angles around their circular mean, so that the wrap at 180 degrees doesn't matter."""
    a = load(spark, d, "files").where("crota IS NOT NULL").select("observatory", "crota")
    mean = a.groupBy("observatory").agg(F.degrees(F.atan2(F.avg(F.sin(F.radians("crota"))), F.avg(F.cos(F.radians("crota"))))).alias("centre"))
    off = F.col("crota") - F.col("centre")
    return a.join(mean, "observatory").groupBy("observatory").agg(F.round(F.median(off - 360 * F.round(off / 360)), 4).alias("median_offset"), F.count("*").alias("n"))


@query(PX + """, b AS (SELECT image_id, min(y) AS y0, max(y) AS y1, min(x) AS x0, max(x) AS x1 FROM px WHERE NOT bad AND v > 0.1 GROUP BY image_id)
SELECT px.image_id, px.y, px.x, CASE WHEN px.y BETWEEN y0 AND y1 AND px.x BETWEEN x0 AND x1 THEN round(v, 6) ELSE 0 END AS v FROM px JOIN b ON b.image_id = px.image_id""")
def cropped_and_embedded(spark, d):
    """Cut to the box of usable pixels, both ends inclusive, and set back into the full frame."""
    px = pixels(spark, d)
    b = px.where("NOT bad AND v > 0.1").groupBy("image_id").agg(F.min("y").alias("y0"), F.max("y").alias("y1"), F.min("x").alias("x0"), F.max("x").alias("x1"))
    inside = F.col("y").between(F.col("y0"), F.col("y1")) & F.col("x").between(F.col("x0"), F.col("x1"))
    return px.join(b, "image_id").select(*KEY, F.when(inside, F.round("v", 6)).otherwise(F.lit(0.0)).alias("v"))


@query(PX + """, s AS (SELECT image_id, median(greatest(v, 0)) AS m FROM px GROUP BY image_id)
SELECT px.image_id, px.y, px.x, round(least(1, pow(greatest(v, 0), 0.5) / pow(m, 0.5) / 2), 6) AS shade FROM px JOIN s ON s.image_id = px.image_id WHERE m > 0""")
def gamma_scaled(spark, d):
    px = pixels(spark, d)
    s = px.groupBy("image_id").agg(F.median(F.greatest("v", F.lit(0.0))).alias("m"))
    shade = F.least(F.lit(1.0), F.pow(F.greatest("v", F.lit(0.0)), F.lit(0.5)) / F.pow("m", F.lit(0.5)) / 2)
    return px.join(s, "image_id").where("m > 0").select(*KEY, r6(shade, "shade"))


@query()
def motion_filtered(spark, d):
    """Cubes of eight successive images, cut in frequency between two speeds."""
    e = load(spark, d, "embeddings").select(F.col("vec_id").alias("image_id"), F.floor(F.col("vec_id") / 8).alias("cube"), "embedding")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("image_id")
        a = np.array(pdf["embedding"].tolist(), float).reshape(len(pdf), 8, 8)
        return pd.DataFrame({"image_id": pdf["image_id"], "power": [float(round((x * x).sum(), 6)) for x in kernels.motion_filter(a, 0.1, 2.0)]})

    return e.groupBy("cube").applyInPandas(run, "image_id long, power double")  # eight images a group


QUERIES = Q
