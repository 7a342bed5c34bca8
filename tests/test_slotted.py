import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from obsforge.operators import asof, slotted


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    keys = ["a", "a", "a", "b", None]
    out = [(keys[rng.integers(0, 5)], None if rng.random() < 0.05 else int(rng.integers(0, 300)), i, None if rng.random() < 0.3 else int(rng.integers(0, 9))) for i in range(400)]
    return spark.createDataFrame(out, "k string, t long, id long, v long").cache()


def pairs(df, *cols):
    return sorted((r.id, *[r[c] for c in cols]) for r in df.collect())


def test_against_plain_windows(rows):
    w = Window.partitionBy("k").orderBy(F.asc_nulls_first("t"), "id")
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    d = Window.partitionBy("k").orderBy(F.desc_nulls_last("t"), F.desc("id")).rowsBetween(Window.unboundedPreceding, 0)
    want = rows.select("id", F.lag("v").over(w).alias("p"), F.lead("v").over(w).alias("n"), F.last("v", True).over(so_far).alias("l"), F.sum("id").over(so_far).alias("s"), F.sum("id").over(d).alias("r"))
    got = slotted.previous(rows, ["k"], "t", "id", ["v"], "p0", slot_us=7)
    got = slotted.previous(got, ["k"], "t", "id", ["v"], "n0", following=True, slot_us=7)
    got = slotted.last_value(got, ["k"], "t", "id", F.col("v"), "l", slot_us=7)
    got = slotted.running_sum(got, ["k"], "t", "id", F.col("id"), "s", slot_us=7)
    got = slotted.running_sum(got, ["k"], "t", "id", F.col("id"), "r", down=True, slot_us=7)
    got = got.withColumn("p", F.col("p0.v")).withColumn("n", F.col("n0.v"))
    for c in "pnlsr":
        a, b = pairs(got, c), pairs(want, c)
        assert sorted(a, key=repr) == sorted(b, key=repr), c


def test_time_mean(rows):
    w = Window.partitionBy("k").orderBy("t").rangeBetween(-19, 20)
    want = rows.where("t IS NOT NULL").select("id", F.round(F.avg("v").over(w), 9).alias("m"))
    got = slotted.time_mean(rows, ["k"], "t", "v", 20, 20, "m", slot_us=7).select("id", F.round("m", 9).alias("m"))
    assert sorted(pairs(got, "m"), key=repr) == sorted(pairs(want, "m"), key=repr)
    assert slotted.time_mean(rows.limit(0), ["k"], "t", "v", 20, 20, "m").count() == 0


def test_count_within(rows):
    left, right = rows.where("id % 2 = 0"), rows.where("id % 2 = 1").select("k", F.col("t").alias("t2"))
    data = [(r.k, r.t) for r in rows.where("id % 2 = 1").collect()]
    got = {r.id: r.n for r in asof.count_within(left, right, ["k"], "id", "t", "t2", 12).collect()}
    for r in left.collect():
        want = sum(1 for k, t in data if k == r.k and k is not None and t is not None and r.t is not None and abs(t - r.t) <= 12)
        assert got[r.id] == want, r


def test_nearest_anywhere(spark):
    rng = np.random.default_rng(5)
    a, b = rng.normal(0, 5, (60, 2)), rng.normal(0, 1, (15, 2))
    left = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(a)], "i long, x double, y double")
    right = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(b)], "j long, u double, w double")
    got = {r.i: r.j for r in asof.nearest_anywhere(left, right, "i", ("x", "y"), "j", ("u", "w"), 0.1).collect()}
    assert got == {i: int(((b - p) ** 2).sum(1).argmin()) for i, p in enumerate(a)}
    assert [r.j for r in asof.nearest_anywhere(left.limit(1), right.limit(0), "i", ("x", "y"), "j", ("u", "w"), 0.1).collect()] == [None]
