"""Queries over pixels: calibration algebra, stack statistics, neighbourhoods."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from obsforge.catalog import load, micros
from obsforge.functions import physics as ph
from obsforge.operators import stacks, stencils
from obsforge.plans.views import FILES, PIXELS, files, pixels, query_into, with_

Q: dict = {}
ORACLE: dict[str, str] = {}


query = query_into(Q, ORACLE)
r6 = lambda c, name: F.round(c, 6).alias(name)
PX = with_(PIXELS)
ONCE = PX.replace("px AS (", "px AS MATERIALIZED (")
KEY = ["image_id", "y", "x"]


@query("SELECT o_orderkey, CAST(floor(sqrt(round_even(greatest(round_even(o_totalprice / 10, 0), 0) * 64, 0))) AS BIGINT) AS coded FROM orders")
def sqrt_encoded(spark, d):
    return load(spark, d, "orders").select("o_orderkey", ph.sqrt_encode(F.col("o_totalprice") / 10).alias("coded"))


@query("SELECT o_orderkey, round_even(pow(greatest(round_even(o_custkey % 2048, 0), 0), 2) / 64, 0) AS decoded FROM orders")
def sqrt_decoded(spark, d):
    return load(spark, d, "orders").select("o_orderkey", ph.sqrt_decode((F.col("o_custkey") % 2048).cast("double")).alias("decoded"))


@query(PX + """SELECT image_id, y, x, round(v * (CASE WHEN y < 4 THEN 4.9 ELSE 4.8 END), 6) AS photons,
round(sqrt(power(sqrt(greatest(v, 0) * g) / g, 2) + 0.25 + power(2.0 / g, 2)), 6) AS sigma FROM (SELECT *, CASE WHEN y < 4 THEN 4.9::DOUBLE ELSE 4.8::DOUBLE END AS g FROM px)""")
def initial_uncertainty(spark, d):
    gain = ph.ccd_gain(F.col("y"), 8, 4.9, 4.8)
    return pixels(spark, d).select(*KEY, r6(F.col("v") * gain, "photons"), r6(ph.initial_uncertainty(F.col("v"), gain, 0.5, 2.0), "sigma"))


@query(PX + "SELECT image_id, y, x, round((((1e-3 * v + 2e-3) * v - 0.01 * (y + 1)) * v + 1.02) * v + 0.5, 6) AS v FROM px")
def quartic_fit(spark, d):
    c = [F.lit(1e-3), F.lit(2e-3), -0.01 * (F.col("y") + 1), F.lit(1.02), F.lit(0.5)]
    return pixels(spark, d).select(*KEY, r6(ph.polynomial(c, F.col("v")), "v"))


@query(PX + """SELECT image_id, y, x, round(v / CASE obs WHEN 1 THEN 1.1 WHEN 2 THEN 0.9 ELSE 1.0 END, 6) AS v, round(greatest(v, 0), 6) AS clipped,
round(v * 1.7e-3 * 0.04, 9) AS msb FROM px""")
def alpha_scaled(spark, d):
    alpha = F.create_map(F.lit(1), F.lit(1.1), F.lit(2), F.lit(0.9))
    v = F.col("v")
    return pixels(spark, d).select(*KEY, r6(v / F.coalesce(F.try_element_at(alpha, F.col("obs")), F.lit(1.0)), "v"), r6(F.greatest(v, F.lit(0.0)), "clipped"), F.round(v * 1.7e-3 * 0.04, 9).alias("msb"))


@query(PX + """SELECT a.image_id, a.y, a.x, round(a.v / (1 + 0.01 * f.y), 6) AS v, round(a.unc / (1 + 0.01 * f.y), 6) AS unc FROM px a JOIN (SELECT DISTINCT y, x FROM px) f ON f.y = a.y AND f.x = a.x""")
def flat_fielded(spark, d):
    """Division by a flat that is joined by pixel; the flat has one row per detector pixel."""
    px = pixels(spark, d)
    flat = spark.range(64).select(F.floor(F.col("id") / 8).cast("int").alias("y"), (F.col("id") % 8).cast("int").alias("x")).withColumn("flat", 1 + 0.01 * F.col("y"))
    return px.join(flat, ["y", "x"]).select(*KEY, r6(F.col("v") / F.col("flat"), "v"), r6(F.col("unc") / F.col("flat"), "unc"))


@query(PX + """, t AS (SELECT image_id, y, x, obs, v, unc, lead(v) OVER w AS v2, lead(unc) OVER w AS u2, lead(image_id) OVER w AS i2 FROM px WINDOW w AS (PARTITION BY obs, y, x ORDER BY image_id))
SELECT image_id, y, x, round(v + (v2 - v) * 0.25, 6) AS model, round(sqrt(unc * unc + u2 * u2), 6) AS sigma FROM t WHERE i2 IS NOT NULL""")
def interpolated_models(spark, d):
    """Models a quarter of the way between two successive ones of an observatory, uncertainties in quadrature."""
    w = Window.partitionBy("obs", "y", "x").orderBy("image_id")
    t = pixels(spark, d).select("*", *[F.lead(c).over(w).alias(n) for c, n in (("v", "v2"), ("unc", "u2"), ("image_id", "i2"))]).where("i2 IS NOT NULL")
    quarter = F.col("image_id") + (F.col("i2") - F.col("image_id")) * 0.25
    return t.select(*KEY, r6(ph.interpolate_linear(F.col("v"), F.col("v2"), F.col("image_id"), F.col("i2"), quarter), "model"), r6(ph.quadrature(F.col("unc"), F.col("u2")), "sigma"))


@query(PX + """, m AS (SELECT y, x, quantile_cont(v, 0.03) AS mv FROM px WHERE NOT bad GROUP BY y, x)
SELECT px.image_id, px.y, px.x, CASE WHEN bad THEN 0.0::DOUBLE ELSE round(v - mv, 6) END AS v FROM px JOIN m ON m.y = px.y AND m.x = px.x""")
def background_subtracted(spark, d):
    """The low percentile over time taken off; masked pixels stay 0."""
    px = pixels(spark, d)
    m = px.where("NOT bad").groupBy("y", "x").agg(F.percentile("v", F.lit(0.03)).alias("mv"))
    return px.join(m, ["y", "x"]).select(*KEY, F.when(F.col("bad"), F.lit(0.0)).otherwise(F.round(F.col("v") - F.col("mv"), 6)).alias("v"))


@query(with_(FILES) + """SELECT file_id, CAST((epoch_us(date_beg) - epoch_us(TIMESTAMP '2024-12-31 23:56:00')) // 60000000 % 8 AS BIGINT) AS phase,
CAST(floor((crota + 180) * 24 / 360) AS BIGINT) % 24 AS roll_bin, CAST(len(list_filter(range(30), lambda i: abs(((crota - (i * 12 - 180) + 180) - 360 * floor((crota - (i * 12 - 180) + 180) / 360)) - 180) <= 22.5)) AS INTEGER) AS bins_45
FROM f WHERE date_beg IS NOT NULL AND crota IS NOT NULL""")
def roll_bins(spark, d):
    f = files(spark, d).where("date_beg IS NOT NULL AND crota IS NOT NULL")
    start = 1735689600000000 - 240000000
    return f.select("file_id", ph.roll_phase(micros("date_beg"), start).alias("phase"), ph.roll_bin(F.col("crota")).alias("roll_bin"), F.size(ph.overlapping_bins(F.col("crota"))).alias("bins_45"))


@query(with_(FILES) + """, b AS (SELECT file_id, crota, CAST(floor((crota + 180) / 15) AS BIGINT) % 24 AS lo, (crota + 180) / 15 - floor((crota + 180) / 15) AS part FROM f WHERE crota IS NOT NULL)
SELECT file_id, round((1 - part) * (lo * 10 + 1) + part * ((lo + 1) % 24 * 10 + 1), 6) AS model FROM b""")
def roll_interpolation(spark, d):
    """Model value between two neighbouring roll bins, around the circle; -180 and 180 are one direction."""
    x = (F.col("crota") + 180) / 15
    lo = F.pmod(F.floor(x), F.lit(24))
    part = x - F.floor(x)
    value = lambda i: i * 10 + 1
    return files(spark, d).where("crota IS NOT NULL").select("file_id", r6((1 - part) * value(lo) + part * value((lo + 1) % 24), "model"))


@query(with_(FILES) + """SELECT file_id, epoch_us(date_beg) - greatest(CAST(ceil((epoch_us(date_beg) - epoch_us(TIMESTAMP '2025-01-01')) / 31556736000000.0) AS BIGINT), 0) * 31556736000000 AS us FROM f WHERE date_beg IS NOT NULL""")
def year_wrapped(spark, d):
    return files(spark, d).where("date_beg IS NOT NULL").select("file_id", ph.year_wrap(micros("date_beg"), 1735689600000000).alias("us"))


KNOTS = [(0.0, 90.0), (40.0, 60.0), (80.0, 20.0), (100.0, 5.0)]


@query("""WITH h AS (SELECT health_id, memory_percentage AS x, disk_percentage AS y FROM health WHERE memory_percentage IS NOT NULL AND disk_percentage IS NOT NULL),
c AS (SELECT *, CASE WHEN x <= 0 THEN 90 WHEN x <= 40 THEN 90 + (x - 0) * -0.75 WHEN x <= 80 THEN 60 + (x - 40) * -1.0 WHEN x <= 100 THEN 20 + (x - 80) * -0.75 ELSE 5 END AS bound FROM h)
SELECT health_id, y < bound AS good, y >= bound AND x > 50 AS both FROM c""")
def limits(spark, d):
    h = load(spark, d, "health").where("memory_percentage IS NOT NULL AND disk_percentage IS NOT NULL")
    x, y = F.col("memory_percentage"), F.col("disk_percentage")
    return h.select("health_id", ph.within_limit(x, y, KNOTS, "<").alias("good"), (ph.within_limit(x, y, KNOTS, ">=") & (x > 50)).alias("both"))


@query("SELECT id, CAST((acquisition_settings >> 4) & 255 AS INTEGER) AS exposure, CAST(acquisition_settings & 15 AS INTEGER) AS mode, CAST((compression_settings >> 3) & 1 AS INTEGER) AS coded FROM sci_xfi")
def register_fields(spark, d):
    a, c = F.col("acquisition_settings"), F.col("compression_settings")
    return load(spark, d, "sci_xfi").select("id", ph.bits(a, 4, 8).alias("exposure"), ph.bits(a, 0, 4).alias("mode"), ph.bits(c, 3, 1).alias("coded"))


@query(with_(FILES) + """, b AS (SELECT processing_flow, CAST(bit_or(CASE WHEN coalesce(outlier, 0) <> 0 THEN 1 << CAST(observatory AS INTEGER) ELSE 0 END) AS INTEGER) AS code
FROM f WHERE observatory IN ('1', '2', '3', '4') AND processing_flow IS NOT NULL GROUP BY processing_flow) SELECT processing_flow, code, CAST((code >> 4) & 1 AS INTEGER) AS of_4, CAST((code >> 1) & 1 AS INTEGER) AS of_1 FROM b""")
def outlier_codes(spark, d):
    f = files(spark, d).where("observatory IN ('1', '2', '3', '4') AND processing_flow IS NOT NULL")
    b = f.groupBy("processing_flow").agg(ph.outlier_bits(F.coalesce("outlier", F.lit(0)) != 0, F.col("observatory").cast("int")).alias("code"))
    return b.select("processing_flow", "code", ph.outlier_bit(F.col("code"), 4).alias("of_4"), ph.outlier_bit(F.col("code"), 1).alias("of_1"))


TRIPLE = """, t AS (SELECT image_id // 3 AS g, y, x, max(v) FILTER (WHERE image_id % 3 = 0) AS m, max(v) FILTER (WHERE image_id % 3 = 1) AS z, max(v) FILTER (WHERE image_id % 3 = 2) AS p FROM px GROUP BY ALL)
"""


@query(PX + TRIPLE + """SELECT g, y, x, round((m + z + p) * 2 / 3, 6) AS total, round((2 * z - m - p) * 2 / 3, 6) AS q, round((p - m) * 2 / sqrt(3), 6) AS u,
round(0.5 * ((m + z + p) * 2 / 3 + (2 * z - m - p) * 2 / 3 * cos(0.6) + (p - m) * 2 / sqrt(3) * sin(0.6)), 6) AS at_angle FROM t WHERE m IS NOT NULL AND z IS NOT NULL AND p IS NOT NULL""")
def polarized_brightness(spark, d):
    """Total and polarized brightness of M, Z and P triplets, and the intensity at another polarizer angle."""
    px = pixels(spark, d).withColumn("g", F.floor(F.col("image_id") / 3)).withColumn("k", F.col("image_id") % 3)
    t = px.groupBy("g", "y", "x").agg(*[F.max(F.when(F.col("k") == i, F.col("v"))).alias(n) for i, n in enumerate("mzp")]).dropna(subset=["m", "z", "p"])
    m, z, p = F.col("m"), F.col("z"), F.col("p")
    total, q, u = ph.polarizer_solve(m, z, p)
    return t.select("g", "y", "x", r6(total, "total"), r6(q, "q"), r6(u, "u"), r6(ph.resolve_polarizer(m, z, p, F.lit(0.3)), "at_angle"))


@query(PX + """SELECT image_id, y, x, round(v * pow(sqrt((y - 3.5) * (y - 3.5) + (x - 3.5) * (x - 3.5)), 2.5), 6) AS filtered,
round(pow((greatest(0, least(1, v)) - 0) / 1.0, 0.5), 6) AS scaled, round(0.0225 * CASE WHEN x = 0 AND y = 0 THEN 1 ELSE sin(radians(sqrt(x * x + y * y) * 0.15)) / radians(sqrt(x * x + y * y) * 0.15) END, 9) AS area
FROM px WHERE sqrt((y - 3.5) * (y - 3.5) + (x - 3.5) * (x - 3.5)) BETWEEN 1 AND 4""")
def radial_trim(spark, d):
    """An annulus, its radial filter, display scaling and the pixels' solid angle."""
    r = F.sqrt((F.col("y") - 3.5) * (F.col("y") - 3.5) + (F.col("x") - 3.5) * (F.col("x") - 3.5))
    x, y = F.col("x").cast("double"), F.col("y").cast("double")
    return pixels(spark, d).where(r.between(1, 4)).select(*KEY, r6(F.col("v") * F.pow(r, F.lit(2.5)), "filtered"), r6(ph.power_scale(F.col("v"), 0.0, 1.0, 0.5), "scaled"), F.round(ph.pixel_solid_angle(x, y, 0.15), 9).alias("area"))


@query(PX + """, k AS (SELECT *, CASE WHEN bad THEN 0.0 ELSE v / unc END AS packed FROM px)
SELECT image_id, y, x, round(packed, 6) AS packed, CASE WHEN packed = 0 THEN 'infinity'::DOUBLE ELSE round(v / packed, 6) END AS unpacked FROM k""")
def uncertainty_codec(spark, d):
    unc = F.when(F.col("bad"), F.lit(float("inf"))).otherwise(F.col("unc"))
    k = pixels(spark, d).withColumn("packed", ph.pack_uncertainty(F.col("v"), unc))
    back = ph.unpack_uncertainty(F.col("v"), F.when(F.col("packed") != 0, F.col("packed")))
    return k.select(*KEY, r6(F.col("packed"), "packed"), F.when(back == float("inf"), back).otherwise(F.round(back, 6)).alias("unpacked"))


@query("""SELECT id, round(((1e-9 * n + 2e-6) * n - 0.01) * n + 20, 6) AS temperature, CAST(list_position(g, list_min(g)) - 1 AS INTEGER) AS state FROM
(SELECT id, CAST(ccsds_packet_length AS DOUBLE) AS n, [least((p - s + 16384) % 16384, (s - p + 16384) % 16384) FOR s IN [0, 3000, 6000, 9000, 12000]] AS g FROM (SELECT *, ccsds_sequence_count AS p FROM eng_ceb))""")
def thermistor_and_polarizer(spark, d):
    e = load(spark, d, "eng_ceb")
    return e.select("id", r6(ph.cubic(F.col("ccsds_packet_length").cast("double"), 1e-9, 2e-6, -0.01, 20.0), "temperature"), ph.nearest_state(F.col("ccsds_sequence_count"), [0, 3000, 6000, 9000, 12000], 16384).alias("state"))


@query("""WITH q AS (SELECT vec_id, embedding[1]::DOUBLE AS w, embedding[2]::DOUBLE AS x, embedding[3]::DOUBLE AS y, embedding[4]::DOUBLE AS z FROM embeddings),
n AS (SELECT vec_id, w / s AS w, x / s AS x, y / s AS y, z / s AS z FROM (SELECT *, sqrt(w * w + x * x + y * y + z * z) AS s FROM q) WHERE s > 0),
r AS (SELECT vec_id, degrees(atan2(2 * (x * y + w * z), 1 - 2 * (y * y + z * z))) AS a, degrees(asin(greatest(-1, least(1, 2 * (x * z - w * y))))) AS dec FROM n)
SELECT vec_id, round(CASE WHEN a < 0 THEN a + 360 ELSE a END, 5) AS ra, round(dec, 5) AS dec FROM r""")
def quaternion_pointing(spark, d):
    e = load(spark, d, "embeddings").select("vec_id", *[F.element_at("embedding", i + 1).cast("double").alias(c) for i, c in enumerate("wxyz")])
    ra, dec = ph.quaternion_pointing(*[F.col(c) for c in "wxyz"])
    return e.where("w * w + x * x + y * y + z * z > 0").select("vec_id", F.round(ra, 5).alias("ra"), F.round(dec, 5).alias("dec"))


# --- Stacks ---

MERGE = """SELECT {keys}, round(coalesce(sum(v * w) / sum(w), 0), 5) AS v, coalesce(round(sqrt(avg(CASE WHEN good THEN u * u END)), 5), 'infinity'::DOUBLE) AS unc
FROM (SELECT *, CASE WHEN good THEN 1 / (u * u) WHEN v <> 0 THEN 1e-24 END AS w FROM (SELECT *, u > 0 AS good FROM (SELECT *, CASE WHEN bad THEN 0.0 ELSE unc END AS u FROM px))) GROUP BY {keys}"""


def _with_bad(spark, d):
    return pixels(spark, d).withColumn("unc", F.when(F.col("bad"), F.lit(0.0)).otherwise(F.col("unc")))


def _rounded(df, *keys):
    return df.select(*keys, F.round("v", 5).alias("v"), F.when(F.col("unc") == float("inf"), F.col("unc")).otherwise(F.round("unc", 5)).alias("unc"))


@query(PX + MERGE.format(keys="obs, y, x"))
def merge_inverse_variance(spark, d):
    return _rounded(stacks.merge_inverse_variance(_with_bad(spark, d), ["obs", "y", "x"]), "obs", "y", "x")


@query(PX.replace("AS bad FROM", "AS bad, CAST(vec_id % 3 AS INTEGER) AS pol FROM") + MERGE.format(keys="pol, y, x"))
def merge_polarized(spark, d):
    px = _with_bad(spark, d).withColumn("pol", (F.col("image_id") % 3).cast("int"))
    return _rounded(stacks.merge_inverse_variance(px, ["pol", "y", "x"]), "pol", "y", "x")


@query(PX.replace("AS bad FROM", "AS bad, vec_id // 8 AS slot FROM").replace("range(1, 65) AS t(i)", "range(1, 65) AS t(i) WHERE NOT embedding[1]::DOUBLE > 0.2::DOUBLE") + MERGE.format(keys="slot, y, x"))
def low_noise_average(spark, d):
    """Merged windows of eight images without the outliers, here those whose first pixel is too bright."""
    px = _with_bad(spark, d)
    outliers = px.where("y = 0 AND x = 0 AND v > 0.2").select("image_id")
    px = px.join(outliers, "image_id", "left_anti").withColumn("slot", F.floor(F.col("image_id") / 8))
    return _rounded(stacks.merge_inverse_variance(px, ["slot", "y", "x"]), "slot", "y", "x")


_PCT = ", ".join(f"coalesce(round(quantile_cont(nz, {p / 100}), 6), -999) AS p{p:02d}" for p in (1, 10, 25, 50, 75, 90, 95, 98, 99))


@query(PX + f""", n AS (SELECT image_id, v, CASE WHEN v <> 0 AND NOT bad THEN v END AS nz, CASE WHEN bad THEN 0 ELSE v END AS w FROM px)
SELECT image_id, count(*) FILTER (WHERE w = 0) AS zeros, count(*) FILTER (WHERE w >= 1) AS saturated, coalesce(round(avg(nz), 6), -999) AS mean, coalesce(round(stddev_pop(nz), 6), -999) AS deviation,
coalesce(min(nz), 0) AS low, coalesce(max(nz), 0) AS high, {_PCT} FROM n GROUP BY image_id""")
def image_statistics(spark, d):
    px = pixels(spark, d).withColumn("v", F.when(F.col("bad"), F.lit(0.0)).otherwise(F.col("v")))
    s = stacks.image_statistics(px, ["image_id"], saturation=1.0)
    exact = ("image_id", "zeros", "saturated", "low", "high")
    return s.select(*[c if c in exact else F.round(c, 6).alias(c) for c in s.columns])


@query(PX + "SELECT y, x, round(quantile_cont(v, 0.03), 6) AS p03, round(quantile_cont(v, 0.5), 6) AS p50 FROM px WHERE NOT bad GROUP BY y, x")
def stack_percentile(spark, d):
    v = F.when(~F.col("bad"), F.col("v"))
    return pixels(spark, d).groupBy("y", "x").agg(r6(F.percentile(v, F.lit(0.03)), "p03"), r6(F.percentile(v, F.lit(0.5)), "p50"))


@query(PX + """SELECT obs, y, x, image_id, CAST(row_number() OVER (PARTITION BY obs, y, x ORDER BY bad, v, image_id) AS INTEGER) AS rank, CASE WHEN NOT bad THEN round(v, 6) END AS v
FROM (SELECT * REPLACE (CASE WHEN NOT bad THEN v END AS v) FROM px)""")
def stack_sorted(spark, d):
    """The whole stack of each pixel in order, masked values last, in the long form: no stack is gathered."""
    px = pixels(spark, d).withColumn("v", F.when(~F.col("bad"), F.col("v")))
    rank = F.row_number().over(Window.partitionBy("obs", "y", "x").orderBy("bad", F.asc_nulls_last("v"), "image_id"))
    return px.select("obs", "y", "x", "image_id", rank.alias("rank"), r6(F.col("v"), "v"))


@query(PX + """SELECT y, x, round(avg(v) FILTER (WHERE NOT bad), 6) AS mean, round(sqrt(sum(unc * unc) FILTER (WHERE NOT bad)) / count(*) FILTER (WHERE NOT bad), 6) AS sigma FROM px GROUP BY y, x""")
def masked_mean(spark, d):
    good = ~F.col("bad")
    return pixels(spark, d).groupBy("y", "x").agg(r6(F.avg(F.when(good, F.col("v"))), "mean"), r6(F.try_divide(F.sqrt(F.sum(F.when(good, F.col("unc") * F.col("unc")))), F.count_if(good)), "sigma"))


@query(PX + """, h AS (SELECT *, unnest(CASE WHEN image_id % 24 < 6 AND image_id >= 24 THEN [image_id // 24, image_id // 24 - 1] ELSE [image_id // 24] END) AS slot FROM px WHERE NOT bad)
SELECT slot, y, x, round(quantile_cont(v, 0.05), 6) AS v FROM h GROUP BY slot, y, x HAVING count(*) >= 20""")
def hopping_background(spark, d):
    """Windows of 30 images every 24, low percentile, where there are enough frames."""
    px = pixels(spark, d).where("NOT bad")
    i = F.col("image_id")
    slots = F.when((i % 24 < 6) & (i >= 24), F.array(F.floor(i / 24), F.floor(i / 24) - 1)).otherwise(F.array(F.floor(i / 24)))
    return px.withColumn("slot", F.explode(slots)).groupBy("slot", "y", "x").agg(F.count("*").alias("n"), r6(F.percentile("v", F.lit(0.05)), "v")).where("n >= 20").drop("n")


@query(PX + """, g AS (SELECT p.obs, p.image_id, p.y, p.x, p.v, p.unc, p.bad, row_number() OVER w AS i FROM px p WINDOW w AS (PARTITION BY obs, y, x ORDER BY image_id)),
n AS (SELECT a.image_id, a.y, a.x, a.v, any_value(a.unc) AS unc, count(*) AS n, stddev_pop(CASE WHEN b.unc < 1 THEN b.v END) AS s, list(b.v) AS vs
FROM g a JOIN g b ON a.obs = b.obs AND a.y = b.y AND a.x = b.x AND b.i <> a.i AND abs(a.i - b.i) <= 3 GROUP BY a.image_id, a.y, a.x, a.v)
SELECT image_id, y, x FROM n WHERE len(list_filter(vs, lambda q: abs(v - q) > 1.5 * s)) > 4 AND n - len(list_filter(vs, lambda q: abs(v - q) > 1.5 * s)) <= 2""")
def spike_votes(spark, d):
    px = stacks.spike_votes(pixels(spark, d), ["obs", "y", "x"], "image_id", "v", "unc", 3, 1.5, 4, 2)
    return px.where("spike").select(*KEY)


@query(PX + """, g AS (SELECT image_id // 5 AS seq, image_id, y, x, v, row_number() OVER (PARTITION BY image_id // 5, y, x ORDER BY v DESC, image_id DESC) AS r FROM px),
dim AS (SELECT seq, y, x, median(v) AS m, stddev_pop(v) AS s, count(*) AS n FROM g WHERE r > 1 GROUP BY ALL)
SELECT g.image_id, g.y, g.x FROM g JOIN dim ON dim.seq = g.seq AND dim.y = g.y AND dim.x = g.x WHERE n BETWEEN 2 AND 6 AND s > 0 AND g.v - m >= 3 * s""")
def despiked(spark, d):
    px = pixels(spark, d).withColumn("seq", F.floor(F.col("image_id") / 5))
    return stacks.despike(px, ["seq", "y", "x"], "image_id", "v", 3.0).where("spike").select(*KEY)


def _matrix(spark):
    m = stacks.destreak_matrix(8, 1.0, 0.02, 0.01)
    return spark.createDataFrame([(i, k, float(m[k, i])) for i in range(8) for k in range(8)], "i int, k int, w double")


_INVERSE = stacks.destreak_matrix(8, 1.0, 0.02, 0.01)


@query(PX + f", m AS (SELECT * FROM (VALUES {', '.join(f'({i}, {k}, {float(_INVERSE[k, i])!r}::DOUBLE)' for i in range(8) for k in range(8))}) t(i, k, w))"
       + "SELECT image_id, CAST(i AS INTEGER) AS y, x, round(sum(w * v), 6) AS v FROM px JOIN m ON m.k = px.y GROUP BY image_id, i, x")
def destreaked(spark, d):
    """The transposed inverse exposure matrix times each image."""
    return stacks.matrix_times(pixels(spark, d), _matrix(spark)).select(*KEY, r6(F.col("v"), "v"))


@query(PX + """, m AS (SELECT i, k, CASE WHEN i = k THEN 1.0::DOUBLE WHEN k < i THEN 0.02::DOUBLE ELSE 0.01::DOUBLE END AS w FROM range(8) a(i), range(8) b(k))
SELECT image_id, CAST(i AS INTEGER) AS y, x, round(sum(w * v), 6) AS v FROM px JOIN m ON m.k = px.y GROUP BY image_id, i, x""")
def smeared(spark, d):
    """The forward exposure matrix times each image: what destreaking undoes."""
    m = spark.createDataFrame([(i, k, 1.0 if i == k else 0.02 if k < i else 0.01) for i in range(8) for k in range(8)], "i int, k int, w double")
    return stacks.matrix_times(pixels(spark, d), m).select(*KEY, r6(F.col("v"), "v"))


@query(PX + """, a AS (SELECT image_id, y, x, v FROM px), b AS (SELECT obs, image_id, y, x, v, lead(image_id) OVER (PARTITION BY obs, y, x ORDER BY image_id) AS nxt FROM px),
c AS (SELECT b.image_id, k.lag, avg(b.v * a.v) AS corr FROM b JOIN range(-2, 3) AS k(lag) ON TRUE JOIN a ON a.image_id = b.nxt AND a.y = greatest(0, least(7, b.y + k.lag)) AND a.x = b.x GROUP BY ALL)
SELECT image_id, CAST(lag AS INTEGER) AS lag, round(corr, 6) AS corr FROM c""")
def lagged_correlation(spark, d):
    """Mean product of successive images of an observatory, the second moved along y by each lag and clamped at the edge."""
    px = pixels(spark, d)
    b = px.withColumn("nxt", F.lead("image_id").over(Window.partitionBy("obs", "y", "x").orderBy("image_id"))).where("nxt IS NOT NULL")
    b = b.withColumn("lag", F.explode(F.sequence(F.lit(-2), F.lit(2)))).select("image_id", "nxt", "lag", "x", "v", F.greatest(F.lit(0), F.least(F.lit(7), F.col("y") + F.col("lag"))).alias("y"))
    a = px.select(F.col("image_id").alias("nxt"), "y", "x", F.col("v").alias("v2"))
    return b.join(a, ["nxt", "y", "x"]).groupBy("image_id", "lag").agg(r6(F.avg(F.col("v") * F.col("v2")), "corr"))


@query("""SELECT observatory, round(degrees(atan2(avg(sin(radians(crota))), avg(cos(radians(crota))))), 4) AS mean_angle, round(sqrt(avg(crota * crota)), 4) AS rms FROM files WHERE crota IS NOT NULL GROUP BY observatory""")
def circular_mean(spark, d):
    a = F.radians("crota")
    return load(spark, d, "files").where("crota IS NOT NULL").groupBy("observatory").agg(F.round(F.degrees(F.atan2(F.avg(F.sin(a)), F.avg(F.cos(a)))), 4).alias("mean_angle"), F.round(F.sqrt(F.avg(F.col("crota") * F.col("crota"))), 4).alias("rms"))


@query(PX + "SELECT CAST(floor(unc * 5) AS BIGINT) AS iy, CAST(floor(v * 4) AS BIGINT) AS ix, round(median(v - unc), 6) AS median_offset, count(*) AS n FROM px GROUP BY ALL")
def binned_median(spark, d):
    return pixels(spark, d).groupBy(F.floor(F.col("unc") * 5).alias("iy"), F.floor(F.col("v") * 4).alias("ix")).agg(r6(F.median(F.col("v") - F.col("unc")), "median_offset"), F.count("*").alias("n"))


@query(PX + "SELECT obs, CAST(least(19, floor((v + 1) * 10)) AS BIGINT) AS bin, count(*) AS n FROM px WHERE v BETWEEN -1 AND 1 GROUP BY ALL")
def histogram(spark, d):
    """Twenty bins over [-1, 1], the last closed."""
    return pixels(spark, d).where("v BETWEEN -1 AND 1").groupBy("obs", F.least(F.lit(19), F.floor((F.col("v") + 1) * 10)).alias("bin")).agg(F.count("*").alias("n"))


@query(PX + """SELECT obs, CAST(floor((degrees(atan2(y - 3.5, x - 3.5)) + 180) / 30) AS BIGINT) % 12 AS sector, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS deviation FROM px GROUP BY ALL""")
def azimuth_statistics(spark, d):
    sector = F.floor((F.degrees(F.atan2(F.col("y") - 3.5, F.col("x") - 3.5)) + 180) / 30) % 12
    return pixels(spark, d).groupBy("obs", sector.alias("sector")).agg(r6(F.avg("v"), "mean"), r6(F.stddev_pop("v"), "deviation"))


@query("SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS brightest, CAST(list_position(embedding, list_min(embedding)) - 1 AS INTEGER) AS dimmest FROM embeddings")
def extreme_positions(spark, d):
    at = lambda f: (F.array_position("embedding", f("embedding")) - 1).cast("int")
    return load(spark, d, "embeddings").select("vec_id", at(F.array_max).alias("brightest"), at(F.array_min).alias("dimmest"))


# --- Neighbourhoods ---

NEAR = """, nb AS (SELECT a.image_id, a.y, a.x, b.v, b.bad, b.y - a.y AS dy, b.x - a.x AS dx FROM px a JOIN px b ON a.image_id = b.image_id AND abs(a.y - b.y) <= {r} AND abs(a.x - b.x) <= {r})
"""


@query(PX + NEAR.format(r=1) + "SELECT image_id, y, x, round(quantile_cont(v, 0.25), 6) AS v FROM nb WHERE NOT bad GROUP BY image_id, y, x")
def percentile_filter(spark, d):
    px = pixels(spark, d).withColumn("v", F.when(~F.col("bad"), F.col("v")))
    return stencils.percentile_filter(px, 1, 0.25, 8, 8).where("v IS NOT NULL").select(*KEY, r6(F.col("v"), "v"))


_GAUSS = PX + NEAR.format(r=4) + "SELECT image_id, y, x, round(sum(exp(-(dy * dy + dx * dx) / 2.0) * v) / sum(exp(-(dy * dy + dx * dx) / 2.0)), 6) AS v FROM nb WHERE NOT bad GROUP BY image_id, y, x"


@query(_GAUSS)
def gaussian_filter(spark, d):
    px = pixels(spark, d).withColumn("v", F.when(~F.col("bad"), F.col("v")))
    return stencils.gaussian(px, 1.0, 8, 8).select(*KEY, r6(F.col("v"), "v"))


@query(_GAUSS)
def gaussian_on_tiles(spark, d):
    """The same smoothing on array tiles with a halo, in an Arrow kernel."""
    px = pixels(spark, d).withColumn("v", F.when(~F.col("bad"), F.col("v")))
    return stencils.on_tiles(stencils.tiles(px, 8, 8, 4, 4), stencils.gaussian_kernel(1.0), 4).select(*KEY, r6(F.col("v"), "v"))


@query(PX + NEAR.format(r=1) + "SELECT image_id, y, x, bool_or(bad) AS grown, bool_and(bad) AS shrunk FROM nb GROUP BY image_id, y, x")
def dilated_mask(spark, d):
    px = pixels(spark, d)
    return stencils.dilate(px, "bad", 1, 8, 8).withColumnRenamed("bad", "grown").join(stencils.dilate(px, "bad", 1, 8, 8, erode=True).withColumnRenamed("bad", "shrunk"), KEY)


def _fill_sql(how: str) -> str:
    return PX + NEAR.format(r=3) + f""", lost AS (SELECT image_id, y, x FROM px WHERE bad), near AS (SELECT nb.*, greatest(abs(dy), abs(dx)) AS ring FROM nb JOIN lost USING (image_id, y, x) WHERE NOT nb.bad),
c AS (SELECT image_id, y, x, ring, sum(count(*)) OVER (PARTITION BY image_id, y, x ORDER BY ring) AS cum FROM near GROUP BY image_id, y, x, ring),
w AS (SELECT image_id, y, x, min(ring) AS least FROM c WHERE cum >= 3 GROUP BY image_id, y, x)
SELECT near.image_id, near.y, near.x, round({how}(v), 6) AS v FROM near JOIN w ON w.image_id = near.image_id AND w.y = near.y AND w.x = near.x WHERE ring <= least GROUP BY near.image_id, near.y, near.x"""


@query(_fill_sql("avg"))
def deficient_filled_mean(spark, d):
    return stencils.fill_deficient(pixels(spark, d), "bad", 3, 3, 8, 8, F.avg).where("bad").select(*KEY, r6(F.col("v"), "v"))


@query(_fill_sql("median"))
def deficient_filled_median(spark, d):
    return stencils.fill_deficient(pixels(spark, d), "bad", 3, 3, 8, 8, F.median).where("bad").select(*KEY, r6(F.col("v"), "v"))


@query()
def inpainted(spark, d):
    """Missing pixels filled ring by ring on whole-image tiles."""
    px = pixels(spark, d).withColumn("v", F.when((F.col("image_id") + F.col("y")) % 5 != 0, F.col("v")))
    return stencils.on_tiles(stencils.tiles(px, 8, 8, 8, 0), stencils.inpaint, 8).select(*KEY, r6(F.col("v"), "v"))


@query(ONCE + "SELECT g.image_id, g.y, g.x, round(coalesce(m.v, -1), 6) AS v FROM px g LEFT JOIN px m ON m.image_id = g.image_id AND m.y + CAST(g.image_id % 3 AS INTEGER) = g.y AND m.x - 1 = g.x")
def shift_aligned(spark, d):
    px = pixels(spark, d)
    return stencils.shift_onto(px, px.select(*KEY), (F.col("image_id") % 3).cast("int"), F.lit(-1), -1.0).select(*KEY, r6(F.col("v"), "v"))


@query(PX + "SELECT image_id, CAST(y * 3 // 8 AS INTEGER) AS y, CAST(x * 4 // 8 AS INTEGER) AS x, round(sum(v), 6) AS v FROM px GROUP BY image_id, y * 3 // 8, x * 4 // 8")
def binned_down(spark, d):
    return stencils.bin_down(pixels(spark, d), 8, 8, 3, 4).select(*KEY, r6(F.col("v"), "v"))


@query(PX + """SELECT image_id, min(y) AS y0, max(y) AS y1, min(x) AS x0, max(x) AS x1 FROM px WHERE NOT bad AND v > 0.1 GROUP BY image_id""")
def finite_box(spark, d):
    """Bounding box of the usable pixels, both ends inclusive."""
    return pixels(spark, d).where("NOT bad AND v > 0.1").groupBy("image_id").agg(F.min("y").alias("y0"), F.max("y").alias("y1"), F.min("x").alias("x0"), F.max("x").alias("x1"))


@query(ONCE + """, c AS MATERIALIZED (SELECT image_id, y, x, v FROM px WHERE y % 2 = 0 AND x % 2 = 0), t AS (SELECT image_id, y, x, y // 2 * 2 AS y0, x // 2 * 2 AS x0 FROM px)
SELECT t.image_id, t.y, t.x, round((1 - (t.y - y0) / 2.0) * ((1 - (t.x - x0) / 2.0) * a.v + (t.x - x0) / 2.0 * coalesce(b.v, a.v)) + (t.y - y0) / 2.0 * ((1 - (t.x - x0) / 2.0) * coalesce(c2.v, a.v) + (t.x - x0) / 2.0 * coalesce(e.v, c2.v, b.v, a.v)), 6) AS v
FROM t JOIN c a ON a.image_id = t.image_id AND a.y = y0 AND a.x = x0 LEFT JOIN c b ON b.image_id = t.image_id AND b.y = y0 AND b.x = x0 + 2
LEFT JOIN c c2 ON c2.image_id = t.image_id AND c2.y = y0 + 2 AND c2.x = x0 LEFT JOIN c e ON e.image_id = t.image_id AND e.y = y0 + 2 AND e.x = x0 + 2""")
def bilinear_upsampled(spark, d):
    """A grid of every second pixel brought back to full size; one copy of each knot to the pixels that see it."""
    px = pixels(spark, d)
    t = px.select(*KEY, (F.floor(F.col("y") / 2) * 2).alias("y0"), (F.floor(F.col("x") / 2) * 2).alias("x0"))
    c = px.where("y % 2 = 0 AND x % 2 = 0").select("image_id", F.col("y").alias("ky"), F.col("x").alias("kx"), "v")
    side = F.explode(F.array(F.lit(0), F.lit(1)))
    seen = c.withColumn("dy", side).withColumn("dx", side).select("image_id", (F.col("ky") - 2 * F.col("dy")).cast("long").alias("y0"), (F.col("kx") - 2 * F.col("dx")).cast("long").alias("x0"), (F.col("dy") * 2 + F.col("dx")).alias("corner"), "v")
    four = seen.groupBy("image_id", "y0", "x0").agg(*[F.max(F.when(F.col("corner") == k, F.col("v"))).alias(n) for k, n in enumerate(("a", "b", "c", "e"))])
    fy, fx = (F.col("y") - F.col("y0")) / 2.0, (F.col("x") - F.col("x0")) / 2.0
    v = (1 - fy) * ((1 - fx) * F.col("a") + fx * F.coalesce("b", "a")) + fy * ((1 - fx) * F.coalesce("c", "a") + fx * F.coalesce("e", "c", "b", "a"))
    return t.join(four, ["image_id", "y0", "x0"]).select(*KEY, r6(v, "v"))


@query(PX + """SELECT image_id, y, x, ((y - 2) * (y - 2) + (x - 2) * (x - 2) <= 4 OR (y - 5) * (y - 5) + (x - 5) * (x - 5) <= 2.25) AND y <= 6 AS glint FROM px""")
def glint_mask(spark, d):
    """Two discs and a cut."""
    y, x = F.col("y"), F.col("x")
    disc = lambda cy, cx, r2: (y - cy) * (y - cy) + (x - cx) * (x - cx) <= r2
    return pixels(spark, d).select(*KEY, ((disc(2, 2, 4.0) | disc(5, 5, 2.25)) & (y <= 6)).alias("glint"))


@query(with_(PIXELS) + """, p AS (SELECT obs, image_id, y, x, v, lead(v) OVER (PARTITION BY obs, y, x ORDER BY image_id) - v AS diff FROM px)
SELECT obs, y, x, round(median(diff), 6) AS model, count(diff) AS pairs FROM p WHERE diff IS NOT NULL GROUP BY obs, y, x HAVING count(diff) >= 7""")
def stray_light_model(spark, d):
    """Median difference of successive images by roll bin and pixel; fewer than seven pairs give no model."""
    w = Window.partitionBy("obs", "y", "x").orderBy("image_id")
    p = pixels(spark, d).withColumn("diff", F.lead("v").over(w) - F.col("v")).where("diff IS NOT NULL")
    return p.groupBy("obs", "y", "x").agg(r6(F.median("diff"), "model"), F.count("*").alias("pairs")).where("pairs >= 7")


QUERIES = Q
