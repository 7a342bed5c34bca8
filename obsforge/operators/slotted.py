"""Ordered windows over a key, cut into slots of time so that no key is one task.

Within a (key, slot) an ordinary window runs.  What a slot needs from the slots
before it (a last row, a running total) is made once per slot, carried along the
slots of a key, and joined to the slot's rows: one row a slot, bounded by the
calendar.  ``tie`` must make the order unique; null times come first, in one slot.
Null keys are a key of their own, as in a window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAY_US = 86_400_000_000


def _cut(df: DataFrame, at: str, slot_us: int) -> DataFrame:
    return df.withColumn("_slot", F.coalesce(F.floor(F.col(at) / slot_us), F.lit(-(1 << 40))))


def _attach(df: DataFrame, per: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    named = per.select(*[F.col(k).alias(f"_of_{k}") for k in keys], F.col("_slot").alias("_of_slot"), value)
    on = F.col("_slot") == F.col("_of_slot")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    return df.join(named, on, "left").drop("_of_slot", *[f"_of_{k}" for k in keys])


def _order(at: str, tie: str, down: bool) -> list[Column]:
    return [F.desc_nulls_last(at), F.desc(tie)] if down else [F.asc_nulls_first(at), F.asc(tie)]


def previous(df: DataFrame, keys: Sequence[str], at: str, tie: str, cols: Sequence[str], name: str, following: bool = False, slot_us: int = DAY_US) -> DataFrame:
    """``df`` with a struct of ``cols`` of the row before (after, if ``following``), null at a key's end."""
    cut, row = _cut(df, at, slot_us), F.struct(*cols)
    edge = (F.min_by if following else F.max_by)(row, F.struct(at, tie))
    along = Window.partitionBy(*keys).orderBy(F.desc("_slot") if following else "_slot")
    per = cut.groupBy(*keys, "_slot").agg(edge.alias("_edge")).withColumn("_carried", F.lag("_edge").over(along))
    near = F.lag(row).over(Window.partitionBy(*keys, "_slot").orderBy(*_order(at, tie, following)))
    return _attach(cut.withColumn(name, near), per, keys, "_carried").withColumn(name, F.coalesce(name, "_carried")).drop("_carried", "_slot")


def last_value(df: DataFrame, keys: Sequence[str], at: str, tie: str, value: Column, name: str, slot_us: int = DAY_US) -> DataFrame:
    """``df`` with the last non-null ``value`` up to and including each row."""
    cut = _cut(df, at, slot_us).withColumn("_v", value)
    own = Window.partitionBy(*keys, "_slot").orderBy(*_order(at, tie, False)).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*keys).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    edge = F.max_by("_v", F.when(F.col("_v").isNotNull(), F.struct(at, tie)))
    per = cut.groupBy(*keys, "_slot").agg(edge.alias("_edge")).withColumn("_carried", F.last("_edge", True).over(before))
    seen = cut.withColumn(name, F.last("_v", True).over(own))
    return _attach(seen, per, keys, "_carried").withColumn(name, F.coalesce(name, "_carried")).drop("_carried", "_slot", "_v")


def running_sum(df: DataFrame, keys: Sequence[str], at: str, tie: str, value: Column, name: str, down: bool = False, slot_us: int = DAY_US) -> DataFrame:
    """``df`` with the sum of ``value`` up to and including each row, from the first (from the last, if ``down``)."""
    cut = _cut(df, at, slot_us).withColumn("_v", value)
    own = Window.partitionBy(*keys, "_slot").orderBy(*_order(at, tie, down)).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*keys).orderBy(F.desc("_slot") if down else "_slot").rowsBetween(Window.unboundedPreceding, -1)
    per = cut.groupBy(*keys, "_slot").agg(F.sum("_v").alias("_all")).withColumn("_carried", F.coalesce(F.sum("_all").over(before), F.lit(0)))
    return _attach(cut.withColumn(name, F.sum("_v").over(own)), per, keys, "_carried").withColumn(name, F.col(name) + F.col("_carried")).drop("_carried", "_slot", "_v")


def started(df: DataFrame, keys: Sequence[str], at: str, tie: str, cut: Column, name: str, slot_us: int = DAY_US) -> DataFrame:
    """``df`` with a struct (at, tie) of the row with which each row's stretch begins; a stretch begins where ``cut`` holds."""
    return last_value(df, keys, at, tie, F.when(cut, F.struct(F.col(at).alias("at"), F.col(tie).alias("tie"))), name, slot_us)


def time_mean(df: DataFrame, keys: Sequence[str], us: str, value: str, before_us: int, after_us: int, name: str, slot_us: int = DAY_US) -> DataFrame:
    """``df`` with the mean of ``value`` over the times in (t - before_us, t + after_us]; rows without a time have none.

    Rows near a slot's border are copied to the slots whose rows look at them.
    """
    timed = df.where(F.col(us).isNotNull())
    slot = F.floor(F.col(us) / slot_us)
    reach = F.sequence(F.floor((F.col(us) - after_us) / slot_us), F.floor((F.col(us) + before_us) / slot_us))
    spread = timed.withColumn("_own", slot).withColumn("_slot", F.explode(reach))
    w = Window.partitionBy(*keys, "_slot").orderBy(us).rangeBetween(-before_us + 1, after_us)
    return spread.withColumn(name, F.avg(value).over(w)).where("_slot = _own").drop("_slot", "_own")
