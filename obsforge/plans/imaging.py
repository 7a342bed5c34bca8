"""Queries on images: calibration with uncertainties, despiking and voting in full, destreaking, merging with missing parts, frames."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from obsforge.catalog import load, micros
from obsforge.functions import physics as ph
from obsforge.operators import kernels, stacks, stencils
from obsforge.plans.pixels import KEY, PX, r6
from obsforge.plans.views import FILES, files, pixels, query_into, with_

Q: dict = {}
ORACLE: dict[str, str] = {}
query = query_into(Q, ORACLE)
N = 8


# --- Calibration ---


@query(PX + """, w AS (SELECT image_id, y, x, v, unc, CAST(image_id % 10 AS DOUBLE) / 10 AS part FROM px)
SELECT image_id, y, x, round(v / ((1 - part) * (1 + 0.01 * y) + part * (1 + 0.02 * x)), 6) AS v, round(unc / ((1 - part) * (1 + 0.01 * y) + part * (1 + 0.02 * x)), 6) AS unc FROM w""")
def flat_between(spark, d):
    """Division by a flat between two flats, weighted by the image's place in time between them."""
    part = (F.col("image_id") % 10) / F.lit(10.0)
    flat = (1 - part) * (1 + 0.01 * F.col("y")) + part * (1 + 0.02 * F.col("x"))
    return pixels(spark, d).select(*KEY, r6(F.col("v") / flat, "v"), r6(F.col("unc") / flat, "unc"))


@query(PX + """, m AS (SELECT y, x, avg(v) AS mv, sqrt(sum(unc * unc)) / count(*) AS mu FROM px WHERE NOT bad GROUP BY y, x)
SELECT px.image_id, px.y, px.x, round(v - mv, 6) AS v, round(sqrt(unc * unc + mu * mu), 6) AS unc FROM px JOIN m ON m.y = px.y AND m.x = px.x""")
def background_with_uncertainty(spark, d):
    """The mean image taken off, both uncertainties in quadrature.  One background row a detector pixel, joined by pixel."""
    px = pixels(spark, d)
    m = px.where("NOT bad").groupBy("y", "x").agg(F.avg("v").alias("mv"), (F.sqrt(F.sum(F.col("unc") * F.col("unc"))) / F.count("*")).alias("mu"))
    return px.join(m, ["y", "x"]).select(*KEY, r6(F.col("v") - F.col("mv"), "v"), r6(ph.quadrature(F.col("unc"), F.col("mu")), "unc"))


@query(PX + """, c AS (SELECT image_id, y, x, CAST(greatest(0, least(1023, floor(abs(v) * 1000))) AS BIGINT) AS code FROM px)
SELECT image_id, y, x, code, round(pow(code, 2) / 64 * CASE WHEN y < 4 THEN 4.9 ELSE 4.8 END, 4) AS v FROM c""")
def halves_decoded(spark, d):
    """Codes to photons through the table of the detector half that the row belongs to, without noise put back."""
    code = F.greatest(F.lit(0), F.least(F.lit(1023), F.floor(F.abs("v") * 1000)))
    px = pixels(spark, d).withColumn("code", code.cast("long"))
    half = lambda gain: F.pow(F.col("code"), 2) / 64 * gain
    return px.select(*KEY, "code", F.round(F.when(F.col("y") < N // 2, half(4.9)).otherwise(half(4.8)), 4).alias("v"))


def synthetic_noise(spark, d):
    """Photon, dark and read noise drawn by a seed; the draw follows rows and partitions, so only its spread is fixed."""
    gain = ph.ccd_gain(F.col("y"), N, 4.9, 4.8)
    sigma = ph.initial_uncertainty(F.col("v"), gain, 0.5, 2.0)
    return pixels(spark, d).select(*KEY, r6(F.col("v") + sigma * F.randn(1), "v"))


Q["synthetic_noise"] = synthetic_noise


# --- Frames ---


@query(with_(FILES) + """SELECT file_id, round(cos(radians(crota)), 9) AS pc11, round(-sin(radians(crota)) * 0.025 / 0.02, 9) AS pc12, round(sin(radians(crota)) * 0.02 / 0.025, 9) AS pc21,
round(cos(radians(crota)), 9) AS pc22 FROM f WHERE crota IS NOT NULL""")
def pc_matrices(spark, d):
    pc = ph.pc_matrix(F.col("crota"), 0.02, 0.025)
    return files(spark, d).where("crota IS NOT NULL").select("file_id", *[F.round(c, 9).alias(n) for c, n in zip(pc, ("pc11", "pc12", "pc21", "pc22"))])


@query(with_(FILES) + """, s AS (SELECT file_id, unnest([epoch_us(date_beg), (epoch_us(date_beg) + epoch_us(date_end)) // 2, epoch_us(date_end)]) AS us FROM f WHERE date_beg < date_end),
a AS (SELECT file_id, us, degrees(acos(greatest(-1, least(1, sin(radians(5)) * sin(radians(10)) + cos(radians(5)) * cos(radians(10)) * cos(radians((us // 1000000 % 86400) / 240.0 - 180)))))) AS gap FROM s)
SELECT file_id, count(*) FILTER (WHERE gap <= 40) AS inside, round(min(gap), 5) AS nearest FROM a GROUP BY file_id""")
def body_in_field(spark, d):
    """How often a body lies in the field at the begin, middle and end of an exposure, and how near; its places come from a rate."""
    f = files(spark, d).where("date_beg < date_end").select("file_id", micros("date_beg").alias("b"), micros("date_end").alias("e"))
    s = f.select("file_id", F.explode(F.array("b", F.floor((F.col("b") + F.col("e")) / 2), "e")).alias("us"))
    along = F.pmod(F.floor(F.col("us") / 1_000_000), F.lit(86400)) / 240.0
    gap = ph.separation(along, F.lit(5.0), F.lit(180.0), F.lit(10.0))
    return s.groupBy("file_id").agg(F.count_if(gap <= 40).alias("inside"), F.round(F.min(gap), 5).alias("nearest"))


@query("""WITH q AS (SELECT vec_id, embedding[1]::DOUBLE AS w, embedding[2]::DOUBLE AS x, embedding[3]::DOUBLE AS y, embedding[4]::DOUBLE AS z FROM embeddings),
n AS (SELECT vec_id, w / s AS w, x / s AS x, y / s AS y, z / s AS z FROM (SELECT *, sqrt(w * w + x * x + y * y + z * z) AS s FROM q) WHERE s > 0),
p AS (SELECT n.*, lead(w) OVER o AS w2, lead(x) OVER o AS x2, lead(y) OVER o AS y2, lead(z) OVER o AS z2 FROM n WINDOW o AS (ORDER BY vec_id)),
c AS (SELECT *, w * w2 + x * x2 + y * y2 + z * z2 AS dot FROM p WHERE w2 IS NOT NULL), g AS (SELECT *, CASE WHEN dot < 0 THEN -1 ELSE 1 END AS sg, acos(least(1, abs(dot))) AS th FROM c),
k AS (SELECT *, CASE WHEN th < 1e-6 THEN 0.75 ELSE sin(0.75 * th) / sin(th) END AS a, CASE WHEN th < 1e-6 THEN 0.25 ELSE sin(0.25 * th) / sin(th) END AS b FROM g)
SELECT vec_id, round(a * w + b * sg * w2, 6) AS w, round(a * x + b * sg * x2, 6) AS x, round(a * y + b * sg * y2, 6) AS y, round(a * z + b * sg * z2, 6) AS z FROM k""")
def slerp_quarters(spark, d):
    """A quarter of the way from each attitude to the next along the great circle, the shorter way round.

    The next attitude comes by the number that follows, joined, so the sequence needs no one task.
    """
    e = load(spark, d, "embeddings").select("vec_id", *[F.element_at("embedding", i + 1).cast("double").alias(c) for i, c in enumerate("wxyz")])
    norm = F.sqrt(F.col("w") * F.col("w") + F.col("x") * F.col("x") + F.col("y") * F.col("y") + F.col("z") * F.col("z"))
    n = e.withColumn("s", norm).where("s > 0").select("vec_id", *[(F.col(c) / F.col("s")).alias(c) for c in "wxyz"]).withColumn("slot", F.floor(F.col("vec_id") / 1000))
    after = Window.partitionBy("slot").orderBy("vec_id")
    row = F.struct(*"wxyz")
    # The first of each slot is what follows the last of the slot before.
    heads = n.groupBy("slot").agg(F.min_by(row, "vec_id").alias("head"))
    heads = heads.select("slot", F.lead("head").over(Window.orderBy("slot")).alias("then"))  # one row a thousand
    p = n.join(heads, "slot").withColumn("b", F.coalesce(F.lead(row).over(after), F.col("then"))).where("b IS NOT NULL")
    q = ph.slerp([F.col(c) for c in "wxyz"], [F.col(f"b.{c}") for c in "wxyz"], 0.25)
    return p.select("vec_id", *[r6(c, n) for c, n in zip(q, "wxyz")])


@query("SELECT CAST(i AS INTEGER) AS band, round(5 + i * 1.75::DOUBLE, 6) AS lo, round(5 + (i + 1) * 1.75::DOUBLE, 6) AS hi, round(5 + (i + 0.5) * 1.75::DOUBLE, 6) AS mid FROM range(8) t(i)")
def band_limits(spark, d):
    """The radial bands in which speeds are measured."""
    i = F.col("id")
    return spark.range(8).select(i.cast("int").alias("band"), *[r6(5 + (i + k) * 1.75, n) for k, n in ((0, "lo"), (1, "hi"), (0.5, "mid"))])


_ANGLE = "radians(image_id * 7 % 31 - 15)"


@query(PX + f""", g AS (SELECT image_id, y, x, 3.5 + (cos({_ANGLE}) * (x - 3.5) - sin({_ANGLE}) * (y - 3.5)) * 1.1 AS ix, 3.5 + (sin({_ANGLE}) * (x - 3.5) + cos({_ANGLE}) * (y - 3.5)) * 1.1 AS iy FROM px),
k AS (SELECT *, CAST(floor(ix) AS INTEGER) AS x0, CAST(floor(iy) AS INTEGER) AS y0 FROM g)
SELECT k.image_id, k.y, k.x, round(sum(p.v * (1 - abs(iy - p.y)) * (1 - abs(ix - p.x))), 6) AS v FROM k JOIN px p ON p.image_id = k.image_id AND p.y BETWEEN y0 AND y0 + 1 AND p.x BETWEEN x0 AND x0 + 1
GROUP BY k.image_id, k.y, k.x HAVING count(*) = 4""")
def reprojected_linear(spark, d):
    """Each image from its own frame (a rotation and a step) onto a common one, between its four nearest pixels; places beyond its edge are left out.

    The frame's matrix maps each target pixel back; four source pixels are joined to it, so no image is gathered.
    """
    px = pixels(spark, d)
    angle = F.radians(F.col("image_id") * 7 % 31 - 15)
    a, b, c, e = ph.pc_matrix(F.degrees(angle), 1.0, 1.0)
    dx, dy = F.col("x") - 3.5, F.col("y") - 3.5
    g = px.select(*KEY, (3.5 + (a * dx + b * dy) * 1.1).alias("ix"), (3.5 + (c * dx + e * dy) * 1.1).alias("iy"))
    side = F.explode(F.array(F.lit(0), F.lit(1)))
    four = g.withColumn("sy", side).withColumn("sx", side).withColumn("sy", (F.floor("iy") + F.col("sy")).cast("int")).withColumn("sx", (F.floor("ix") + F.col("sx")).cast("int"))
    source = px.select("image_id", F.col("y").alias("sy"), F.col("x").alias("sx"), "v")
    weight = (1 - F.abs(F.col("iy") - F.col("sy"))) * (1 - F.abs(F.col("ix") - F.col("sx")))
    got = four.join(source, ["image_id", "sy", "sx"]).groupBy(*KEY).agg(F.count("*").alias("n"), F.sum(F.col("v") * weight).alias("v"))
    return got.where("n = 4").select(*KEY, r6(F.col("v"), "v"))


@query("""WITH s AS (SELECT vec_id, 4 + 12 * embedding[1]::DOUBLE AS x, 4 + 12 * embedding[2]::DOUBLE AS y, 6 + 20 * embedding[3]::DOUBLE AS magnitude FROM embeddings)
SELECT vec_id, round(x, 6) AS x, round(y, 6) AS y FROM s WHERE magnitude < 7 AND x >= -0.5 AND x < 7.5 AND y >= -0.5 AND y < 7.5""")
def stars_in_frame(spark, d):
    """Catalogue stars brighter than a limit whose place falls onto the detector."""
    e = lambda i: F.element_at("embedding", i).cast("double")
    s = load(spark, d, "embeddings").select("vec_id", (4 + 12 * e(1)).alias("x"), (4 + 12 * e(2)).alias("y"), (6 + 20 * e(3)).alias("magnitude"))
    return s.where("magnitude < 7 AND x >= -0.5 AND x < 7.5 AND y >= -0.5 AND y < 7.5").select("vec_id", r6(F.col("x"), "x"), r6(F.col("y"), "y"))


# --- Stacks ---


@query(PX + """, p AS (SELECT image_id // 3 AS g, image_id % 3 AS k, y, x, v, unc FROM px WHERE NOT bad),
t AS (SELECT g, y, x, max(v) FILTER (WHERE k = 0) AS m, max(v) FILTER (WHERE k = 1) AS z, max(v) FILTER (WHERE k = 2) AS p, count(*) AS n FROM p GROUP BY g, y, x)
SELECT g, y, x, round(coalesce(m, 0), 6) AS m, round(coalesce(z, 0), 6) AS z, round(coalesce(p, 0), 6) AS p, CAST(3 - n AS BIGINT) AS missing,
round(2.0::DOUBLE / 3 * (coalesce(m, 0) + coalesce(z, 0) + coalesce(p, 0)), 6) AS total FROM t""")
def merged_angles(spark, d):
    """The three angles of a group side by side, a missing one as zero, and their two thirds' sum."""
    px = pixels(spark, d).where("NOT bad").withColumn("g", F.floor(F.col("image_id") / 3)).withColumn("k", F.col("image_id") % 3)
    t = px.groupBy("g", "y", "x").agg(*[F.coalesce(F.max(F.when(F.col("k") == i, F.col("v"))), F.lit(0.0)).alias(c) for i, c in enumerate("mzp")], (3 - F.count("*")).alias("missing"))
    return t.select("g", "y", "x", *[r6(F.col(c), c) for c in "mzp"], "missing", r6((F.col("m") + F.col("z") + F.col("p")) * (2.0 / 3), "total"))


WINDOW_US = 1_920_000_000


@query(with_(FILES) + f""", g AS (SELECT observatory, epoch_us(date_beg) // {WINDOW_US} AS slot, file_id, epoch_us(date_beg) AS us, coalesce(outlier, 0) <> 0 AS out FROM f WHERE level = '2' AND date_beg IS NOT NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY observatory, slot ORDER BY us, file_id) - 1 AS i, count(*) OVER (PARTITION BY observatory, slot) AS n FROM g WHERE NOT out),
d AS (SELECT observatory, slot, bool_or(out) AS outlier FROM g GROUP BY observatory, slot)
SELECT r.observatory, r.slot, min(us) AS beg_us, max(us) AS end_us, CAST(floor(avg(us)) AS BIGINT) AS obs_us, max(file_id) FILTER (WHERE i = greatest(0, n // 2 - 1)) AS reference, count(*) AS n, any_value(d.outlier) AS outlier
FROM r JOIN d ON d.observatory = r.observatory AND d.slot = r.slot GROUP BY r.observatory, r.slot""")
def low_noise_headers(spark, d):
    """Per averaging window: first, last and mean time, the reference frame in the middle, and whether an outlier was dropped."""
    f = files(spark, d).where("level = '2' AND date_beg IS NOT NULL AND observatory IS NOT NULL").withColumn("us", micros("date_beg")).withColumn("slot", F.floor(F.col("us") / WINDOW_US))
    out = F.coalesce("outlier", F.lit(0)) != 0
    w = Window.partitionBy("observatory", "slot")
    f = f.withColumn("any_out", F.bool_or(out).over(w)).where(~out)
    r = f.withColumn("i", F.row_number().over(w.orderBy("us", "file_id")) - 1).withColumn("n", F.count("*").over(w))
    middle = F.col("i") == F.greatest(F.lit(0), F.floor(F.col("n") / 2) - 1)
    return r.groupBy("observatory", "slot").agg(
        F.min("us").alias("beg_us"), F.max("us").alias("end_us"), F.floor(F.avg("us")).cast("long").alias("obs_us"), F.max(F.when(middle, F.col("file_id"))).alias("reference"),
        F.count("*").alias("n"), F.bool_or("any_out").alias("outlier"),
    )


# --- Neighbourhoods ---


@query(PX + """, q AS (SELECT image_id, y, x, v > 0.15 AS hit FROM px), s AS (SELECT a.image_id, a.y, a.x, bool_or(b.hit) AS near FROM q a JOIN q b ON b.image_id = a.image_id AND abs(a.y - b.y) + abs(a.x - b.x) <= 1 GROUP BY ALL),
n AS (SELECT *, count(*) FILTER (WHERE near) OVER (PARTITION BY image_id, y) AS n FROM s) SELECT image_id, y, x FROM n WHERE near OR n > 5""")
def saturated_grown(spark, d):
    """Saturated pixels grown by one step along rows and columns; then whole rows that hold more than five of them."""
    grown = stencils.dilate(pixels(spark, d).withColumn("hit", F.col("v") > 0.15), "hit", 1, N, N, cross=True)
    n = F.count_if("hit").over(Window.partitionBy("image_id", "y"))
    return grown.withColumn("n", n).where("hit OR n > 5").select(*KEY)


EXPOSURE, READOUT, RESET = 1.5, 0.02, 0.01
_INVERSE = stacks.destreak_matrix(N, EXPOSURE, READOUT, RESET)


@query(PX + f", m AS (SELECT * FROM (VALUES {', '.join(f'({i}, {k}, {float(_INVERSE[k, i])!r}::DOUBLE)' for i in range(N) for k in range(N))}) t(i, k, w))"
       + f"SELECT image_id, CAST(i AS INTEGER) AS y, x, round({EXPOSURE} * sum(w * v), 6) AS v FROM px JOIN m ON m.k = px.y GROUP BY image_id, i, x")
def destreaked_exposure(spark, d):
    """The transposed inverse exposure matrix times each image, brought back to the exposure's scale."""
    m = spark.createDataFrame([(i, k, float(_INVERSE[k, i])) for i in range(N) for k in range(N)], "i int, k int, w double")
    return stacks.matrix_times(pixels(spark, d), m).select(*KEY, r6(F.col("v") * EXPOSURE, "v"))


_BLUR = "exp(-((a.y - b.y) * (a.y - b.y) + (a.x - b.x) * (a.x - b.x)) / {two}::DOUBLE)"


@query(PX + """, g AS (SELECT obs, image_id, y, x, v, unc, row_number() OVER (PARTITION BY obs, y, x ORDER BY image_id) AS i FROM px),
t AS (SELECT a.image_id, a.y, a.x, a.v, count(*) AS n, count(*) FILTER (WHERE abs(a.v - b.v) > 0.2) AS yes FROM g a JOIN g b ON a.obs = b.obs AND a.y = b.y AND a.x = b.x AND b.i <> a.i AND abs(a.i - b.i) <= 3 GROUP BY ALL),
s AS (SELECT image_id, y, x, yes > 4 AND n - yes <= 1 AS hit FROM t),
d AS (SELECT a.image_id, a.y, a.x, bool_or(b.hit) AS hit FROM s a JOIN s b ON b.image_id = a.image_id AND abs(a.y - b.y) + abs(a.x - b.x) <= 1 GROUP BY ALL),
e AS (SELECT a.image_id, a.y, a.x, sum(""" + _BLUR.format(two=2.0) + """ * CAST(b.hit AS INTEGER)) / sum(""" + _BLUR.format(two=2.0) + """) AS share FROM d a JOIN d b ON b.image_id = a.image_id AND abs(a.y - b.y) <= 4 AND abs(a.x - b.x) <= 4 GROUP BY ALL)
SELECT image_id, y, x FROM e WHERE share > 0.15""")
def spike_areas(spark, d):
    """Voting with an absolute threshold; the spikes grown by one step, blurred, and cut at 0.15."""
    px = stacks.spike_votes(pixels(spark, d), ["obs", "y", "x"], "image_id", "v", "unc", 3, 0.0, 4, 1, absolute=0.2)
    grown = stencils.dilate(px, "spike", 1, N, N, cross=True).select(*KEY, F.col("spike").cast("double").alias("v"))
    return stencils.gaussian(grown, 1.0, N, N).where("v > 0.15").select(*KEY)


@query(PX + """, h AS (SELECT a.image_id, a.y, a.x, any_value(a.v) AS v, any_value(a.v) - sum(""" + _BLUR.format(two=4.5) + """ * b.v) / sum(""" + _BLUR.format(two=4.5) + """) AS high FROM px a JOIN px b ON b.image_id = a.image_id AND abs(a.y - b.y) <= 6 AND abs(a.x - b.x) <= 6 GROUP BY a.image_id, a.y, a.x),
g AS (SELECT image_id // 5 AS seq, *, row_number() OVER (PARTITION BY image_id // 5, y, x ORDER BY high DESC, image_id DESC) AS r FROM h),
dim AS (SELECT seq, y, x, median(high) AS m, stddev_pop(high) AS s, count(*) AS n FROM g WHERE r > 1 GROUP BY ALL),
k AS (SELECT g.image_id, g.y, g.x, g.v, n BETWEEN 2 AND 6 AND s > 0 AND high - m >= 3 * s AS spike FROM g JOIN dim ON dim.seq = g.seq AND dim.y = g.y AND dim.x = g.x)
SELECT a.image_id, a.y, a.x, round(avg(b.v), 6) AS v FROM k a JOIN k b ON b.image_id = a.image_id AND abs(a.y - b.y) <= 1 AND abs(a.x - b.x) <= 1 AND NOT b.spike WHERE a.spike GROUP BY a.image_id, a.y, a.x""")
def despiked_filled(spark, d):
    """Spikes of the high-passed sequence, each filled with the mean of the untouched pixels around it."""
    px = pixels(spark, d)
    low = stencils.gaussian(px, 1.5, N, N).withColumnRenamed("v", "low")
    high = px.join(low, KEY).withColumn("high", F.col("v") - F.col("low")).withColumn("seq", F.floor(F.col("image_id") / 5))
    marked = stacks.despike(high, ["seq", "y", "x"], "image_id", "high", 3.0).select(*KEY, "v", "spike")
    fill = stencils.neighbours(marked.where("NOT spike"), 1, N, N).groupBy(*KEY).agg(r6(F.avg("v"), "v"))
    return marked.where("spike").select(*KEY).join(fill, KEY)


@query(PX + """, b AS (SELECT obs, image_id % 4 AS bin, y, x, min(v) AS v FROM px WHERE NOT bad GROUP BY ALL),
m AS (SELECT a.obs, a.bin, a.y, a.x, median(c.v) AS v FROM b a JOIN b c ON c.obs = a.obs AND c.bin = a.bin AND abs(a.y - c.y) <= 2 AND abs(a.x - c.x) <= 2 GROUP BY ALL)
SELECT a.obs, CAST(a.bin AS BIGINT) AS bin, a.y, a.x, round(sum(""" + _BLUR.format(two=2.0).replace("b.", "c.") + """ * c.v) / sum(""" + _BLUR.format(two=2.0).replace("b.", "c.") + """), 6) AS v FROM m a JOIN m c ON c.obs = a.obs AND c.bin = a.bin AND abs(a.y - c.y) <= 4 AND abs(a.x - c.x) <= 4 GROUP BY a.obs, a.bin, a.y, a.x""")
def stray_light_by_roll(spark, d):
    """Per observatory and roll bin the lowest value of each pixel over time, smoothed by a 5 x 5 median and a Gaussian."""
    px = pixels(spark, d).where("NOT bad").groupBy("obs", (F.col("image_id") % 4).alias("bin"), "y", "x").agg(F.min("v").alias("v"))
    one = px.select(F.struct("obs", "bin").alias("image_id"), "y", "x", "v")
    middle = stencils.neighbours(one, 2, N, N).groupBy("image_id", "y", "x").agg(F.median("v").alias("v"))
    return stencils.gaussian(middle, 1.0, N, N).select("image_id.obs", "image_id.bin", "y", "x", r6(F.col("v"), "v"))


@query(PX + """, q AS (SELECT image_id, y, x, NOT bad AS fine FROM px)
SELECT a.image_id, a.y, a.x FROM q a JOIN q b ON b.image_id = a.image_id AND abs(a.y - b.y) + abs(a.x - b.x) <= 1 GROUP BY a.image_id, a.y, a.x HAVING count(*) FILTER (WHERE b.fine) = 5""")
def edges_trimmed(spark, d):
    """Usable pixels all of whose four neighbours are there and usable: the mask without its rim."""
    near = stencils.neighbours(pixels(spark, d).withColumn("fine", ~F.col("bad")), 1, N, N, cols=("fine",))
    return near.where(F.abs("dy") + F.abs("dx") <= 1).groupBy(*KEY).agg(F.count_if("fine").alias("n")).where("n = 5").select(*KEY)


def holes_filled(spark, d):
    """Masks with the stretches filled that no path joins to the edge."""
    px = pixels(spark, d).withColumn("v", (F.col("v") > 0.05).cast("double"))
    return stencils.on_tiles(stencils.tiles(px, N, N, N, 0), kernels.fill_holes, N).where("v > 0").select(*KEY)


Q["holes_filled"] = holes_filled


HSV = "round(val - val * sat * greatest(0, least(k{n}, 4 - k{n}, 1)), 6) AS {c}"


@query(PX + """, t AS (SELECT image_id, y, x, (degrees(atan2(v, unc)) + 360) % 360 AS hue, least(1, unc / 1.3) AS sat, greatest(0, least(1, abs(v) * 4)) AS val FROM px),
k AS (SELECT *, (5 + hue / 60) % 6 AS k5, (3 + hue / 60) % 6 AS k3, (1 + hue / 60) % 6 AS k1 FROM t)
SELECT image_id, y, x, """ + ", ".join(HSV.format(n=n, c=c) for n, c in ((5, "red"), (3, "green"), (1, "blue"))) + " FROM k")
def colour_map(spark, d):
    """Direction as hue, degree as saturation and brightness as value, to red, green and blue."""
    hue = F.pmod(F.degrees(F.atan2("v", "unc")) + 360, F.lit(360.0))
    t = pixels(spark, d).select(*KEY, hue.alias("hue"), F.least(F.lit(1.0), F.col("unc") / 1.3).alias("sat"), F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.abs("v") * 4)).alias("val"))
    rgb = ph.hsv_to_rgb(F.col("hue"), F.col("sat"), F.col("val"))
    return t.select(*KEY, *[r6(c, n) for c, n in zip(rgb, ("red", "green", "blue"))])


def scattered_filled(spark, d):
    """Missing pixels by a cubic through the known ones, two ways: along each row and column, averaged."""
    px = pixels(spark, d).withColumn("v", F.when((F.col("image_id") + F.col("y") * 3 + F.col("x")) % 7 != 0, F.col("v")))
    return stencils.on_tiles(stencils.tiles(px, N, N, N, 0), kernels.cubic_fill, N).select(*KEY, r6(F.col("v"), "v"))


Q["scattered_filled"] = scattered_filled


def coaligned(spark, d):
    """Images of one group turned by their own angles onto the first one's frame, in parallel by image."""
    e = load(spark, d, "embeddings").select(F.col("vec_id").alias("image_id"), F.transform("embedding", lambda x: x.cast("double")).alias("data"))
    out = None
    for k, angle in enumerate((0.0, 15.0, -15.0)):
        part = kernels.per_image(e.where(F.col("image_id") % 3 == k), kernels.rotate(angle), N, N)
        out = part if out is None else out.unionByName(part)
    return kernels.to_pixels(out, N).select(*KEY, r6(F.col("v"), "v"))


Q["coaligned"] = coaligned


@query("""SELECT vec_id AS image_id, len(embedding) AS n, len(list_filter(embedding, lambda x: isnan(x) OR isinf(x))) AS broken FROM embeddings WHERE len(embedding) <> 64 OR len(list_filter(embedding, lambda x: isnan(x) OR isinf(x))) > 0""")
def misshapen(spark, d):
    """Images that aren't of the stated shape or hold values that are no numbers."""
    broken = F.size(F.filter("embedding", lambda x: F.isnan(x) | (F.abs(x) == float("inf"))))
    return load(spark, d, "embeddings").select(F.col("vec_id").alias("image_id"), F.size("embedding").cast("long").alias("n"), broken.cast("long").alias("broken")).where("n <> 64 OR broken > 0")


QUERIES = Q
