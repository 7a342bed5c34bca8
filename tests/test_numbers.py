"""Small numeric anchors, and kernels against numpy."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from obsforge.functions import physics as ph
from obsforge.operators import asof, filters, kernels, sequences, stacks, stencils


def one(spark, col, **values):
    return spark.createDataFrame([tuple(values.values())], list(values)).select(col.alias("r")).collect()[0].r


def test_interpolation_midpoint(spark):
    c = [F.col(x) for x in "abstu"]
    f = ph.interpolate_linear(*c)
    assert one(spark, f, a=1.0, b=2.0, s=0, t=10, u=5) == 1.5
    assert one(spark, f, a=1.0, b=2.0, s=0, t=10, u=0) == 1.0
    assert one(spark, f, a=1.0, b=2.0, s=0, t=10, u=11) is None


def test_outlier_bits(spark):
    df = spark.createDataFrame([(1, False), (2, True), (3, False), (4, True)], "o int, f boolean")
    code = df.agg(ph.outlier_bits(F.col("f"), F.col("o")).alias("c")).collect()[0].c
    assert code == 20
    assert [one(spark, ph.outlier_bit(F.col("c"), n), c=20) for n in (1, 2, 3, 4)] == [0, 1, 0, 1]


def test_sqrt_codec_stays_within_shot_noise(spark):
    df = spark.range(151, 60000, 37).select(F.col("id").cast("double").alias("v"))
    got = df.select("v", ph.sqrt_decode(ph.sqrt_encode(F.col("v")).cast("double")).alias("d")).toPandas()
    assert (np.abs(got.v - got.d) <= np.sqrt(got.v) + 32).all()


def test_destreak_anchor(spark):
    m = stacks.destreak_matrix(3, 1, 2, 3)
    np.testing.assert_allclose(m, [[-0.38461538, 0.23076923, 0.46153846], [0.30769231, -0.38461538, 0.23076923], [0.15384615, 0.30769231, -0.38461538]], atol=1e-8)
    px = spark.createDataFrame([(0, y, x, float(3 * y + x)) for y in range(3) for x in range(3)], "image_id long, y int, x int, v double")
    # The anchor is the plain product; images are corrected with the transposed matrix.
    mt = spark.createDataFrame([(i, k, float(m[i, k])) for i in range(3) for k in range(3)], "i int, k int, w double")
    got = np.zeros((3, 3))
    for r in stacks.matrix_times(px, mt).collect():
        got[r.y, r.x] = r.v
    np.testing.assert_allclose(got, [[3.46153846, 3.76923077, 4.07692308], [0.23076923, 0.38461538, 0.53846154], [-1.38461538, -1.30769231, -1.23076923]], atol=1e-8)


def test_statistics_of_zeros(spark):
    r = stacks.image_statistics(spark.createDataFrame([(1, 0.0)] * 16, "i int, v double"), ["i"]).collect()[0]
    assert r.zeros == 16 and r.mean == r.p50 == r.deviation == -999 and r.low == r.high == 0


def test_merge_branches(spark):
    rows = [(1, 10.0, 1.0), (1, 20.0, 2.0), (2, 5.0, 0.0), (3, 0.0, 0.0), (4, None, 1.0), (4, 4.0, 1.0), (5, None, None)]
    got = {r.k: (r.v, r.unc) for r in stacks.merge_inverse_variance(spark.createDataFrame(rows, "k int, v double, unc double"), ["k"]).collect()}
    assert got[1] == (pytest.approx(12.0), pytest.approx(np.sqrt(2.5)))
    assert got[2] == (5.0, np.inf) and got[3] == (0.0, np.inf) and got[5] == (0.0, np.inf)
    assert got[4] == (2.0, 1.0)  # a missing value with a usable uncertainty still counts in the weights


def test_admission(spark):
    flows = spark.createDataFrame([(1, 5, 1.0), (2, 2, 2.0), (3, 100, 2.0)], "id int, priority int, weight double").withColumn("share", F.lit(1.0))
    take = lambda w, n: {r.id for r in sequences.admit(flows, [F.desc("priority")], "weight", "share", w, n).collect()}
    assert take(6, 3) == {1, 2, 3} and take(3, 3) == {1, 3}
    assert sequences.admit(flows.limit(0), [F.desc("priority")], "weight", "share", 3, 3).count() == 0


def test_replay_ring():
    merge = lambda *r, **kw: sequences.ring_requests(pd.DataFrame([("2025-01-01", *x) for x in r], columns=["start_time", "start_block", "replay_length"]), **kw)
    assert merge((20949, 20), (20952, 50), (21001, 5), (21002, 5)).values.tolist() == [["2025-01-01", 20949, 59]]
    assert merge((24570, 20 - 22528)).values.tolist() == [["2025-01-01", 24570, 20]]
    assert merge((24570, 20 - 22528), (2050, 100)).values.tolist() == [["2025-01-01", 24570, 109]]
    assert len(merge((24570, 20 - 22528), (3000, 100))) == 2 and len(merge()) == 0
    assert len(merge((100, 5), (2048, 5))) == 1 and len(merge((2048, 5), until=pd.Timestamp("2024-12-31"))) == 0


def test_limits(spark):
    k = [(0.0, 0.0), (10.0, 10.0)]
    x = F.col("x")
    assert [one(spark, ph.piecewise(x, k), x=v) for v in (-5.0, 2.5, 12.0)] == [0.0, 2.5, 10.0]
    assert one(spark, ph.within_limit(x, F.lit(3.0), k, ">"), x=2.5) is True
    assert one(spark, ph.within_limit(x, F.lit(3.0), k, "<"), x=float("nan")) is None


def test_filter_language_errors():
    with pytest.raises(ValueError):
        filters.parse("{a} similar 5")


def test_polarizers(spark):
    i = lambda a: 0.5 * (3.0 + 0.4 * np.cos(2 * a) + 0.7 * np.sin(2 * a))
    m, z, p = (float(i(np.radians(a))) for a in (-60, 0, 60))
    cols = [F.col(c) for c in "mzp"]
    assert [one(spark, c, m=m, z=z, p=p) for c in ph.polarizer_solve(*cols)] == pytest.approx([3.0, 0.4, 0.7])
    assert one(spark, ph.resolve_polarizer(*cols, F.lit(0.3)), m=m, z=z, p=p) == pytest.approx(i(0.3))


def test_tiles_of_any_size_agree(spark):
    rng = np.random.default_rng(4)
    a = rng.random((9, 7))
    a[2, 3] = np.nan
    px = spark.createDataFrame([(1, y, x, None if np.isnan(a[y, x]) else float(a[y, x])) for y in range(9) for x in range(7)], "image_id long, y int, x int, v double")
    grid = lambda df: {(r.y, r.x): r.v for r in df.collect()}
    long = grid(stencils.gaussian(px, 0.5, 9, 7))
    for size in (2, 4, 9):
        assert grid(stencils.on_tiles(stencils.tiles(px, 9, 7, size, 2), stencils.gaussian_kernel(0.5), size)) == pytest.approx(long)


def test_inpaint():
    a = np.ones((8, 8))
    a[1:6, 1:6] = np.nan
    assert np.allclose(stencils.inpaint(a), 1)
    assert np.isnan(stencils.inpaint(np.full((4, 4), np.nan))).all()


def test_deficient_fill(spark):
    px = spark.createDataFrame([(1, y, x, float(y * 5 + x), 0.1, (y, x) == (2, 2)) for y in range(5) for x in range(5)], "image_id long, y int, x int, v double, unc double, bad boolean")
    got = {(r.y, r.x): (r.v, r.unc) for r in stencils.fill_deficient(px, "bad", 3, 5, 5, 5, F.avg).collect()}
    assert got[2, 2] == (12.0, np.inf) and got[0, 0] == (0.0, 0.1) and len(got) == 25


def test_kernels():
    rng = np.random.default_rng(5)
    a = rng.random((8, 8))
    assert np.allclose(kernels.psf_kernel(8, 8, 0.5, 0.5, 0.0)(a), a)
    assert np.allclose(kernels.rotate(0.0)(a), a)
    assert np.allclose(kernels.rotate(90.0)(a), np.rot90(a, 1)) or np.allclose(kernels.rotate(90.0)(a), np.rot90(a, -1))
    cube = rng.random((4, 8, 8))
    assert np.allclose(kernels.motion_filter(cube, 0.0, np.inf), cube)
    mode, _ = kernels.mode_of_histogram(np.histogram(rng.normal(0.2, 0.1, 50_000), 50, (-1, 1))[0], np.linspace(-0.98, 0.98, 50))
    assert abs(mode - 0.2) < 0.03


def test_principal_residuals(spark):
    rng = np.random.default_rng(6)
    x = rng.random((30, 2)) @ rng.random((2, 12)) + 3
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "image_id long, data array<double>")
    got = kernels.principal_residual(df, 2).collect()
    assert max(abs(v) for r in got for v in r.data) < 1e-6


@pytest.mark.parametrize("strict", [True, False])
def test_before_after_over_slots(spark, strict):
    rng = np.random.default_rng(7)
    left = [(i, int(rng.integers(0, 2)), int(rng.integers(0, 60))) for i in range(80)] + [(900, None, 5), (901, 1, None)]
    right = [(k, int(t), 1000 * k + int(t)) for k in (0, 1) for t in rng.choice(60, 9, replace=False)]
    lf, rf = spark.createDataFrame(left, "id long, k int, t long"), spark.createDataFrame(right, "k int, rt long, rid long")
    got = {r.id: (r.before and r.before.id, r.after and r.after.id) for r in asof.before_after(lf, rf, ["k"], "t", "rt", "rid", strict, slot_us=7).collect()}
    for i, k, t in left:
        side = [(rt, rid) for rk, rt, rid in right if rk == k] if t is not None and k is not None else []
        b = max(((rt, rid) for rt, rid in side if rt < t or rt == t and not strict), default=(0, None))[1]
        a = min(((rt, rid) for rt, rid in side if rt > t or rt == t and not strict), default=(0, None))[1]
        assert got[i] == (b, a)


def test_anchored_groups(spark):
    t = [0, 4, 9, 11, 12, 30, 31, 41, 60]
    df = spark.createDataFrame([(1, x, i) for i, x in enumerate(t)], "k int, t long, id long")
    got = {r.t: r.anchor for r in sequences.anchored_groups(df, ["k"], "t", "id", 10, 3, "k int, t long, id long").collect()}
    assert got == {0: 0, 4: 0, 9: 0, 11: 11, 12: 11, 30: 30, 31: 30, 41: 41, 60: 60}
    assert sequences.anchored_groups(df.limit(0), ["k"], "t", "id", 10, 3, "k int, t long, id long").count() == 0


def test_holes_and_cubic_fill():
    from obsforge.operators import kernels

    a = np.zeros((7, 8))
    a[1:5, 1:5] = 1
    a[2:4, 2:4] = 0  # a hole
    a[5, 6] = 1
    want = a.copy()
    want[2:4, 2:4] = 1
    assert (kernels.fill_holes(a) == want).all()
    a[1, 2] = 0  # now open to the edge
    assert (kernels.fill_holes(a) == a).all()
    y, x = np.mgrid[0:8, 0:8].astype(float)
    cube = 2 * y**3 - y * x + x**3
    holed = cube.copy()
    holed[3, 4] = holed[5, 2] = np.nan
    assert np.allclose(kernels.cubic_fill(holed), cube)
    assert np.isnan(kernels.cubic_fill(np.full((3, 3), np.nan))).all()


@pytest.mark.parametrize("seed", range(3))
def test_ring_blocks_against_the_list(spark, seed):
    rng = np.random.default_rng(seed)
    rows = [("a" if rng.random() < 0.7 else "b", int(rng.integers(1900, 2200) if rng.random() < 0.5 else rng.integers(24400, 24700)), int(rng.integers(0, 12)) if rng.random() < 0.8 else int(rng.integers(-22520, -22300))) for _ in range(40)]
    got = {(r.k, r.start_block, r.replay_length) for r in sequences.ring_blocks(spark.createDataFrame([*rows, ("a", None, 3), ("b", 2050, None)], "k string, b int, len int"), ["k"], "b", "len").collect()}
    want = set()
    for k in "ab":
        own = pd.DataFrame([(b, n) for key, b, n in rows if key == k], columns=["start_block", "replay_length"])
        want |= {(k, int(b), int(n)) for b, n in sequences.ring_requests(own)[["start_block", "replay_length"]].itertuples(index=False)}
    assert got == want
