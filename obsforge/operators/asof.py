"""Joins in time and space: as-of, bracketing, k nearest, overlap, within a distance.

None of them is a nested loop.  As-of joins are one ordered pass over the union
of both sides; distance joins meet in buckets of the distance's width, the right
side being copied to the neighbouring buckets.

Null keys and times match nothing.  The right side of ``before_after`` must have
one row per key and time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obsforge.operators import slotted
from obsforge.session import materialize

SLOT_US = 86_400_000_000


def _carried(rows: DataFrame, keys: Sequence[str], value: str, forward: bool, pick) -> DataFrame:
    """(keys, _slot, value): for each occupied slot what ``pick`` makes of the earlier (later, if not ``forward``) slots' values.

    One row a slot: bounded by the calendar, so the window over a key's slots stays small however many rows a key has.
    """
    per = rows.groupBy(*keys, "_slot").agg(pick(value).alias(value))
    w = Window.partitionBy(*keys).orderBy("_slot" if forward else F.desc("_slot")).rowsBetween(Window.unboundedPreceding, -1)
    return per.withColumn(value, pick(value).over(w)).where(F.col(value).isNotNull())


def before_after(left: DataFrame, right: DataFrame, keys: Sequence[str], at: str, right_at: str, right_id: str, strict: bool = False, slot_us: int = SLOT_US) -> DataFrame:
    """``left`` with structs ``before`` and ``after`` (us, id): the last right row at or before, the first at or after.

    With ``strict`` equal times don't count.  The ordered pass runs per key and slot of time; what precedes and follows a
    slot is carried into it, so one key with most of the rows spreads over its slots.
    """
    cols = left.columns
    kind = "struct<us:bigint,id:bigint>"
    a = left.select(*keys, F.col(at).alias("_at"), F.struct(*cols).alias("_left"), F.lit(None).cast(kind).alias("_right"))
    b = right.where(F.col(right_at).isNotNull()).select(*keys, F.col(right_at).alias("_at"), F.lit(None).cast(a.schema["_left"].dataType).alias("_left"), F.struct(F.col(right_at).alias("us"), F.col(right_id).alias("id")).cast(kind).alias("_right"))
    both = a.unionByName(b).withColumn("_slot", F.floor(F.col("_at") / slot_us))
    carried = None
    for forward, pick in ((True, F.max), (False, F.min)):
        c = _carried(both, keys, "_right", forward, pick).select(*keys, F.col("_right.us").alias("_at"), F.lit(None).cast(a.schema["_left"].dataType).alias("_left"), "_right", "_slot")
        carried = c if carried is None else carried.unionByName(c)
    both = both.unionByName(carried).withColumn("_side", F.col("_right").isNull() if not strict else F.col("_right").isNotNull())
    up = Window.partitionBy(*keys, "_slot").orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy(*keys, "_slot").orderBy(F.desc("_at"), "_side").rowsBetween(Window.unboundedPreceding, 0)
    seen = both.withColumn("before", F.last("_right", True).over(up)).withColumn("after", F.last("_right", True).over(down))
    ok = F.col("_at").isNotNull()
    for k in keys:
        ok = ok & F.col(k).isNotNull()
    return seen.where("_right IS NULL").select("_left.*", F.when(ok, F.col("before")).alias("before"), F.when(ok, F.col("after")).alias("after"))


def asof_best(left: DataFrame, right: DataFrame, keys: Sequence[str], at: str, right_at: str, order: Column, direction: str, slot_us: int = SLOT_US) -> DataFrame:
    """``left`` with ``best``: the greatest ``order`` struct among the right rows at or before (backward) or at or after (forward)."""
    cols = left.columns
    back = direction == "backward"
    a = left.select(*keys, F.col(at).alias("_at"), F.struct(*cols).alias("_left"))
    b = right.where(F.col(right_at).isNotNull()).select(*keys, F.col(right_at).alias("_at"), order.alias("_order"))
    both = a.withColumn("_order", F.lit(None).cast(b.schema["_order"].dataType)).unionByName(b.withColumn("_left", F.lit(None).cast(a.schema["_left"].dataType)))
    both = both.withColumn("_slot", F.floor(F.col("_at") / slot_us))
    edge = F.col("_slot") * slot_us if back else (F.col("_slot") + 1) * slot_us
    carried = _carried(both, keys, "_order", back, F.max).select(*keys, edge.alias("_at"), "_order", F.lit(None).cast(a.schema["_left"].dataType).alias("_left"), "_slot")
    both = both.unionByName(carried)
    first = F.col("_at") if back else F.desc("_at")
    w = Window.partitionBy(*keys, "_slot").orderBy(first, F.col("_order").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn("best", F.max("_order").over(w)).where("_order IS NULL").select("_left.*", "best")


def bracket(left: DataFrame, right: DataFrame, keys: Sequence[str], left_id: str, at: str, right_at: str, right_id: str, impossible: str) -> DataFrame:
    """(left_id, kind, first, second): ``bracket`` with the models around, ``nearest`` with the two nearest possible ones, or ``wait``."""
    plain = before_after(left, right, keys, at, right_at, right_id)
    bad = right.where(F.col(impossible)).select(*keys, F.col(right_at).alias("_us"), F.lit(True).alias("_bad"))
    good = right.where(~F.col(impossible))
    w = Window.partitionBy(*keys).orderBy(right_at)
    good = good.withColumn("_prev", F.lag(F.struct(F.col(right_at).alias("us"), F.col(right_id).alias("id"))).over(w)).withColumn("_next", F.lead(F.struct(F.col(right_at).alias("us"), F.col(right_id).alias("id"))).over(w))
    marked = plain
    for c in ("before", "after"):
        side = bad.select(*[F.col(k).alias(f"_{c}_{k}") for k in keys], F.col("_us").alias(f"_{c}us"), F.col("_bad").alias(f"_{c}bad"))
        on = F.col(f"{c}.us") == F.col(f"_{c}us")
        for k in keys:
            on = on & (F.col(k) == F.col(f"_{c}_{k}"))
        marked = marked.join(side, on, "left").drop(*[f"_{c}_{k}" for k in keys], f"_{c}us")
    # The two nearest possible models are among the two before and the two after.
    one = before_after(left, good, keys, at, right_at, right_id).select(left_id, *keys, at, F.col("before").alias("b1"), F.col("after").alias("a1"))
    links = good.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col(right_at).alias("_g"), "_prev", "_next")
    for c, side in (("b1", "_prev"), ("a1", "_next")):
        on = F.col(f"{c}.us") == F.col("_g")
        for k in keys:
            on = on & (F.col(k) == F.col(f"_{k}"))
        one = one.join(links.select(*[f"_{k}" for k in keys], "_g", F.col(side).alias(f"{c}x")), on, "left").drop("_g", *[f"_{k}" for k in keys])
    around = F.array_distinct(F.filter(F.array("b1", "a1", "b1x", "a1x"), lambda x: x.isNotNull()))
    ranked = F.array_sort(F.transform(around, lambda x: F.struct(F.abs(x["us"] - F.col(at)).alias("gap"), x["us"].alias("us"), x["id"].alias("id"))))
    two = one.select(left_id, F.try_element_at(ranked, F.lit(1))["id"].alias("_n1"), F.try_element_at(ranked, F.lit(2))["id"].alias("_n2"))
    got = marked.join(two, left_id)
    exact = (F.col("before.us") == F.col(at)) | (F.col("after.us") == F.col(at))
    wait = F.coalesce(exact, F.lit(False)) | F.col("before").isNull() | F.col("after").isNull()
    fallback = F.coalesce("_beforebad", F.lit(False)) | F.coalesce("_afterbad", F.lit(False))
    kind = F.when(wait, "wait").when(fallback, "nearest").otherwise("bracket")
    pick = lambda near, plain: F.when(wait, None).when(fallback, F.col(near)).otherwise(F.col(plain))
    return got.select(left_id, kind.alias("kind"), pick("_n1", "before.id").alias("first"), pick("_n2", "after.id").alias("second"))


def within(left: DataFrame, right: DataFrame, keys: Sequence[str], at: str, right_at: str, distance: int, strict: bool = False) -> DataFrame:
    """All pairs of equal keys at most ``distance`` apart (less, with ``strict``), through buckets of that width.

    Gives as many rows as there are such pairs: use it where the distance holds few.
    """
    a = left.withColumn("_b", F.floor(F.col(at) / distance))
    b = right.withColumn("_b", F.explode(F.sequence(F.floor(F.col(right_at) / distance) - 1, F.floor(F.col(right_at) / distance) + 1)))
    gap = F.abs(F.col(at) - F.col(right_at))
    return a.join(b, [*keys, "_b"]).where(gap < distance if strict else gap <= distance).drop("_b")


def nearest_k(left: DataFrame, right: DataFrame, keys: Sequence[str], left_id: str, at: str, right_at: str, right_id: str, k: int, distance: int) -> DataFrame:
    """(left_id, right_id, rank) of the k nearest within less than ``distance``; of equal gaps the earlier, then the smaller id.

    Only the k rows before and the k after can be among them; each right row brings its k predecessors and successors.
    """
    w = Window.partitionBy(*keys).orderBy(right_at, right_id)
    row = F.struct(F.col(right_at).alias("us"), F.col(right_id).alias("id"))
    chain = right.where(F.col(right_at).isNotNull()).withColumn("_row", row)
    one = chain.withColumn("_back", F.collect_list("_row").over(w.rowsBetween(-k, 0))).withColumn("_on", F.collect_list("_row").over(w.rowsBetween(0, k)))
    # Several rows of one time: the first of them brings what follows, the last what precedes.
    at_time = one.groupBy(*keys, right_at).agg(F.max_by("_back", right_id).alias("_back"), F.min_by("_on", right_id).alias("_on"))
    numbered = at_time.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(right_at)).cast("long"))
    got = before_after(left, numbered, keys, at, right_at, "_n")
    link = numbered.select(*[F.col(x).alias(f"_{x}") for x in keys], "_n", "_back", "_on")
    for c in ("before", "after"):
        part = link.select(*[f"_{x}" for x in keys], F.col("_n").alias("_m"), F.col("_back" if c == "before" else "_on").alias(f"_{c}"))
        on = F.col(f"{c}.id") == F.col("_m")
        for x in keys:
            on = on & (F.col(x) == F.col(f"_{x}"))
        got = got.join(part, on, "left").drop("_m", *[f"_{x}" for x in keys])
    rows = F.array_distinct(F.concat(F.coalesce("_before", F.array().cast("array<struct<us:bigint,id:bigint>>")), F.coalesce("_after", F.array().cast("array<struct<us:bigint,id:bigint>>"))))
    ranked = F.array_sort(F.filter(F.transform(rows, lambda x: F.struct(F.abs(x["us"] - F.col(at)).alias("gap"), x["us"].alias("us"), x["id"].alias("id"))), lambda x: x["gap"] < distance))
    return got.select(left_id, F.posexplode(F.slice(ranked, 1, k)).alias("_p", "_x")).select(left_id, F.col("_x.id").alias(right_id), (F.col("_p") + 1).cast("int").alias("rank"))


def overlap_join(left: DataFrame, right: DataFrame, keys: Sequence[str], span: tuple[str, str], right_span: tuple[str, str], slot: int) -> DataFrame:
    """All pairs of overlapping or touching spans of equal keys, each once: they meet in the first slot that both have."""
    slots = lambda b, e: F.explode(F.sequence(F.floor(F.col(b) / slot), F.floor(F.col(e) / slot)))
    a, b = left.withColumn("_s", slots(*span)), right.withColumn("_s", slots(*right_span))
    first = F.greatest(F.floor(F.col(span[0]) / slot), F.floor(F.col(right_span[0]) / slot))
    hit = (F.col(right_span[0]) <= F.col(span[1])) & (F.col(right_span[1]) >= F.col(span[0])) & (F.col("_s") == first)
    return a.join(b, [*keys, "_s"]).where(hit).drop("_s")


def nearest_in_grid(left: DataFrame, right: DataFrame, left_id: str, xy: tuple[str, str], right_id: str, right_xy: tuple[str, str], box: float) -> DataFrame:
    """(left_id, right_id): the nearest right point no further than ``box`` in either coordinate; null if there is none."""
    cell = lambda c: F.floor(F.col(c) / box)
    near = F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1)))
    a = left.select(left_id, *xy, cell(xy[0]).alias("_i"), cell(xy[1]).alias("_j"))
    b = right.select(right_id, *right_xy, (cell(right_xy[0])).alias("_i0"), cell(right_xy[1]).alias("_j0")).withColumn("_di", near).withColumn("_dj", near)
    b = b.select(right_id, *right_xy, (F.col("_i0") + F.col("_di")).alias("_i"), (F.col("_j0") + F.col("_dj")).alias("_j"))
    dx, dy = F.col(right_xy[0]) - F.col(xy[0]), F.col(right_xy[1]) - F.col(xy[1])
    pairs = a.join(b, ["_i", "_j"]).where((F.abs(dx) <= box) & (F.abs(dy) <= box))
    best = pairs.groupBy(left_id).agg(F.min(F.struct((dx * dx + dy * dy).alias("d"), F.col(right_id))).alias("m"))
    return left.select(left_id).join(best, left_id, "left").select(left_id, F.col("m")[right_id].alias(right_id))


def nearest_anywhere(left: DataFrame, right: DataFrame, left_id: str, xy: tuple[str, str], right_id: str, right_xy: tuple[str, str], box: float) -> DataFrame:
    """(left_id, right_id): the nearest right point of each left point, however far; null only if there are none at all.

    Points without one in a box of width ``box`` are looked up again in a box twice as wide, until all have one; a point
    found farther than the box is looked up once more, as a nearer one may lie beside the box.
    """
    span = right.agg(*[f(c) for c in right_xy for f in (F.min, F.max)]).collect()[0]
    todo, out = materialize(left.select(left_id, *xy), "points"), None
    far = left.agg(*[f(c) for c in xy for f in (F.min, F.max)]).collect()[0]
    if None in tuple(span) or None in tuple(far):
        return left.select(left_id, F.lit(None).cast(right.schema[right_id].dataType).alias(right_id))
    widest = max(max(span[1], far[1]) - min(span[0], far[0]), max(span[3], far[3]) - min(span[2], far[2]))
    at = right.select(F.col(right_id).alias("_r"), *[F.col(c).alias(f"_{i}") for i, c in enumerate(right_xy)])
    while True:
        got = nearest_in_grid(todo, right, left_id, xy, right_id, right_xy, box).join(todo, left_id).join(at, F.col(right_id) == F.col("_r"), "left")
        gap = F.sqrt((F.col(xy[0]) - F.col("_0")) * (F.col(xy[0]) - F.col("_0")) + (F.col(xy[1]) - F.col("_1")) * (F.col(xy[1]) - F.col("_1")))
        got = materialize(got.select(left_id, right_id, *xy, F.coalesce(gap <= box, F.lit(False)).alias("_sure")), "nearest")
        last = box > widest * 2
        done = got.where("_sure" if not last else "true").select(left_id, right_id)
        out = done if out is None else out.unionByName(done)
        todo = got.where("NOT _sure").select(left_id, *xy)
        if last or todo.isEmpty():
            return out
        box *= 2


def count_within(left: DataFrame, right: DataFrame, keys: Sequence[str], left_id: str, at: str, right_at: str, distance: int, name: str = "n") -> DataFrame:
    """(left_id, n): how many right rows of equal keys lie at most ``distance`` (whole numbers) away, without making the pairs.

    The running count of right rows is looked up at both ends of each left row's span.
    """
    per = right.where(F.col(right_at).isNotNull()).groupBy(*keys, right_at).agg(F.count("*").alias("_c")).withColumn("_tie", F.lit(0))
    upto = slotted.running_sum(per, keys, right_at, "_tie", F.col("_c"), "_upto")
    ends = left.select(left_id, *keys, F.col(at).alias("_t"), F.posexplode(F.array(F.col(at) - distance - 1, F.col(at) + distance)).alias("_end", "_at"))
    seen = before_after(ends, upto, keys, "_at", right_at, "_upto")
    n = F.coalesce("before.id", F.lit(0))
    return seen.groupBy(left_id).agg((F.sum(F.when(F.col("_end") == 1, n)) - F.sum(F.when(F.col("_end") == 0, n))).alias(name))
