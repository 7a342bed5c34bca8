"""Matching records by nearest time: for each left row the nearest right row of its entity within a tolerance.

Time is cut into buckets as wide as the tolerance, so a partner lies in the same
or an adjacent bucket.  Of an adjacent bucket only its nearest edge can matter:
each bucket's first and last right row (one each, aggregated before the shuffle)
are sent to its neighbours.  Left and right rows then meet by (entity, bucket) in
one ordered pass each way, which yields for every left row the right row before
and after it; the nearer one is kept, the smaller id of equal distances.  No
pairs are formed, so a dense bucket costs no more than its rows.

Buckets fuller than 1/20000 of all rows (and 50,000) are cut into equal slices of
time; a slice still too full of left rows (equal timestamps) is salted, and the
right rows of that slice are copied to each salt.  Both lists have at most 20,000
entries by construction and are broadcast.

Defined cases: null entities, times and ids match nothing; equal times match at
distance 0; the distance may equal the tolerance; right rows of one entity and
time count as the one with the smallest id; repeated left rows give equal rows,
which come out once; an empty table on either side gives no rows; other columns
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obsforge.catalog import micros

FULL, SHARE = 50_000, 20_000


def _narrow(df: DataFrame, entity: str, ts: str, id_col: str) -> DataFrame:
    return df.select(F.col(entity).alias("entity"), micros(ts).alias("us"), F.col(id_col).cast("long").alias("id")).where("entity IS NOT NULL AND us IS NOT NULL AND id IS NOT NULL")


def nearest(left: DataFrame, rights: dict[str, DataFrame], tolerance_us: int, entity: str, ts: str, id_col: str) -> DataFrame:
    """(right_name, right_id, left_id) of each left row and each right table that has a row near enough."""
    names = list(rights)
    bucket = F.floor(F.col("us") / tolerance_us)
    lefts = _narrow(left, entity, ts, id_col).withColumn("bucket", bucket)
    right = None
    for k, n in enumerate(names):
        part = _narrow(rights[n], entity, ts, id_col).withColumn("kind", F.lit(k))
        right = part if right is None else right.unionByName(part)
    right = right.groupBy("kind", "entity", "us").agg(F.min("id").alias("id")).withColumn("bucket", bucket)

    per = lefts.select("entity", "bucket").unionByName(right.select("entity", "bucket")).groupBy("entity", "bucket").agg(F.count("*").alias("n"))
    # One row per occupied bucket; only the total comes to the driver.
    total = per.agg(F.sum("n")).collect()[0][0] or 0
    full = max(FULL, total // SHARE)
    hot = F.broadcast(per.where(F.col("n") > full).select("entity", "bucket", F.least(F.ceil(F.col("n") / full), F.lit(tolerance_us)).alias("slices")))

    def sliced(df: DataFrame) -> DataFrame:
        at = F.floor((F.col("us") - F.col("bucket") * tolerance_us) * F.col("slices") / tolerance_us)
        return df.join(hot, ["entity", "bucket"], "left").withColumn("slice", F.coalesce(at, F.lit(0)).cast("int"))

    lefts, right = sliced(lefts), sliced(right)
    # Edges: of each bucket to its neighbours, and inside sliced buckets from each slice to the next that need it.
    row = F.struct("us", "id")
    edges = right.groupBy("kind", "entity", "bucket").agg(F.min(row).alias("first"), F.max(row).alias("last"))
    moved = edges.select("kind", "entity", F.explode(F.array(F.struct((F.col("bucket") - 1).alias("bucket"), F.col("first").alias("x")), F.struct((F.col("bucket") + 1).alias("bucket"), F.col("last").alias("x")))).alias("m"))
    all_slices = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("slices") - 1, F.lit(0)).cast("int")))
    between = moved.select("kind", "entity", "m.bucket", "m.x.us", "m.x.id").join(hot, ["entity", "bucket"], "left").withColumn("slice", all_slices).drop("slices")
    kinds = F.explode(F.sequence(F.lit(0), F.lit(len(names) - 1))).alias("kind")
    grid = hot.select("entity", "bucket", kinds, F.explode(F.sequence(F.lit(0), (F.col("slices") - 1).cast("int"))).alias("slice"))
    cells = right.where("slices IS NOT NULL").groupBy("kind", "entity", "bucket", "slice").agg(F.min(row).alias("first"), F.max(row).alias("last"))
    along = Window.partitionBy("kind", "entity", "bucket").orderBy("slice")
    back = Window.partitionBy("kind", "entity", "bucket").orderBy(F.desc("slice"))
    upto = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    near = grid.join(cells, ["kind", "entity", "bucket", "slice"], "left").select(
        "kind", "entity", "bucket", "slice",
        F.array(F.last("last", True).over(upto(along)), F.last("first", True).over(upto(back))).alias("xs"),
    ).withColumn("x", F.explode("xs")).where("x IS NOT NULL")
    right = right.select("kind", "entity", "bucket", "slice", "us", "id").unionByName(between.select("kind", "entity", "bucket", "slice", "us", "id")).unionByName(
        near.select("kind", "entity", "bucket", "slice", "x.us", "x.id")
    )

    crowded = lefts.where("slices IS NOT NULL").groupBy("entity", "bucket", "slice").agg(F.count("*").alias("n")).where(F.col("n") > 2 * full)
    crowded = F.broadcast(crowded.select("entity", "bucket", "slice", F.ceil(F.col("n") / full).cast("int").alias("salts")))
    cell = ["entity", "bucket", "slice"]
    lefts = lefts.join(crowded, cell, "left").withColumn("salt", F.coalesce(F.pmod(F.hash("id"), F.col("salts")), F.lit(0)))
    right = right.join(crowded, cell, "left").withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("salts") - 1, F.lit(0)))))

    cols = [*cell, "salt", "us", "id", "kind"]
    both = lefts.withColumn("kind", F.lit(None).cast("int")).select(cols).unionByName(right.select(cols))
    part = Window.partitionBy(*cell, "salt")
    before = part.orderBy("us", F.col("kind").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    after = part.orderBy(F.desc("us"), F.col("kind").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    seen = lambda k, w: F.last(F.when(F.col("kind") == k, row), True).over(w)
    matched = both.select(*cols, *[seen(k, before).alias(f"b{k}") for k in range(len(names))]).select(
        "*", *[seen(k, after).alias(f"a{k}") for k in range(len(names))]
    )

    def best(k: int) -> Column:
        d = lambda c: F.when(F.col(c).isNotNull(), F.struct(F.abs(F.col("us") - F.col(c)["us"]).alias("d"), F.col(c)["id"].alias("id")))
        return F.least(d(f"b{k}"), d(f"a{k}"))

    out = matched.where("kind IS NULL").select(F.col("id").alias("left_id"), F.explode(F.array(*[F.struct(F.lit(n).alias("right_name"), best(k).alias("m")) for k, n in enumerate(names)])).alias("x"))
    return out.select(F.col("x.right_name"), F.col("x.m.id").alias("right_id"), "left_id", F.col("x.m.d").alias("d")).where(F.col("d") <= tolerance_us).drop("d")
