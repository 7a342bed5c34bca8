"""Overlapping and gapped intervals per entity.

An ordered map of disjoint intervals per entity is kept as keyed state: each
insertion finds the overlapped stretch by binary search and merges it.  The map
runs in three places: per task, before any shuffle (arrivals are nearly in order,
so this leaves few intervals); per (entity, slot of time), so that an entity with
a third of all rows spreads over many tasks; and, in ``obsforge.streaming.ingest``,
per entity over a stream.  Intervals are cut at slot borders and joined again
across them through one summary row a slot.

Defined cases: intervals with a null entity, null ends or begin not before end
are passed over; touching intervals are one; repeated rows change nothing; an
empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from obsforge.catalog import micros
from obsforge.session import materialize

SLOT_US = 7 * 86_400_000_000


class IntervalMap:
    """Disjoint intervals in order; those that overlap or touch are merged on insertion."""

    def __init__(self, begs: list[int] | None = None, ends: list[int] | None = None):
        self.begs, self.ends = begs or [], ends or []

    def insert(self, beg: int, end: int) -> None:
        if not self.ends or beg > self.ends[-1]:
            self.begs.append(beg)
            self.ends.append(end)
            return
        lo = bisect_left(self.ends, beg)  # the first that ends at or after beg
        hi = bisect_right(self.begs, end)  # the first that begins after end
        if lo < hi:
            beg, end = min(beg, self.begs[lo]), max(end, self.ends[hi - 1])
        self.begs[lo:hi] = [beg]
        self.ends[lo:hi] = [end]

    def gaps(self):
        return zip(self.ends[:-1], self.begs[1:])

    def __len__(self) -> int:
        return len(self.begs)


def _per_task(batches):
    maps: dict[str, IntervalMap] = {}
    held = 0
    for pdf in batches:
        for e, b, f in zip(pdf["entity"], pdf["beg"].tolist(), pdf["end"].tolist()):
            maps.setdefault(e, IntervalMap()).insert(b, f)
        held = sum(map(len, maps.values()))
        if held > 500_000:
            yield _frame(maps)
            maps = {}
    yield _frame(maps)


def _frame(maps: dict) -> pd.DataFrame:
    rows = [(e, b, f) for e, m in maps.items() for b, f in zip(m.begs, m.ends)]
    return pd.DataFrame(rows, columns=["entity", "beg", "end"])


def _merge_sorted(batches):
    """Rows come sorted by (entity, slot); one map at a time."""
    at, m = None, IntervalMap()
    for pdf in batches:
        out = []
        for e, s, b, f in zip(pdf["entity"], pdf["slot"].tolist(), pdf["beg"].tolist(), pdf["end"].tolist()):
            if (e, s) != at:
                out += [(*at, x, y) for x, y in zip(m.begs, m.ends)] if at else []
                at, m = (e, s), IntervalMap()
            elif len(m) > 1 and b > m.ends[-1]:  # sorted by begin: all but the last are final
                out += [(*at, x, y) for x, y in zip(m.begs[:-1], m.ends[:-1])]
                m = IntervalMap(m.begs[-1:], m.ends[-1:])
            m.insert(b, f)
        yield pd.DataFrame(out, columns=["entity", "slot", "beg", "end"])
    yield pd.DataFrame([(*at, x, y) for x, y in zip(m.begs, m.ends)] if at else [], columns=["entity", "slot", "beg", "end"])


def merged(df: DataFrame, entity: str, beg: str, end: str, slot_us: int = SLOT_US) -> DataFrame:
    """(entity, slot, beg, end): disjoint per entity, cut at slot borders; written to the shared folder."""
    spans = df.select(F.col(entity).cast("string").alias("entity"), micros(beg).alias("beg"), micros(end).alias("end")).where("entity IS NOT NULL AND beg < end")
    local = spans.mapInPandas(_per_task, "entity string, beg long, end long")
    slot = F.explode(F.sequence(F.floor(F.col("beg") / slot_us), F.floor((F.col("end") - 1) / slot_us)))
    cut = local.withColumn("slot", slot).select(
        "entity", "slot", F.greatest("beg", F.col("slot") * slot_us).alias("beg"), F.least("end", (F.col("slot") + 1) * slot_us).alias("end")
    )
    whole = cut.repartition("entity", "slot").sortWithinPartitions("entity", "slot", "beg").mapInPandas(_merge_sorted, "entity string, slot long, beg long, end long")
    return materialize(whole, "intervals")


def periods_and_gaps(df: DataFrame, entity: str, beg: str, end: str, longest_gap_us: int | None = None, slot_us: int = SLOT_US) -> DataFrame:
    """(entity, span_kind, beg_us, end_us): the continuous periods, and the gaps of at most ``longest_gap_us`` between successive ones."""
    parts = merged(df, entity, beg, end, slot_us)
    per = parts.groupBy("entity", "slot").agg(F.min("beg").alias("first"), F.max("end").alias("last"))
    # One row a slot: bounded by the calendar, not by the rows.
    w = Window.partitionBy("entity").orderBy("slot")
    per = per.withColumn("prev_last", F.lag("last").over(w)).withColumn("next_first", F.lead("first").over(w))
    inner = parts.join(per.select("entity", "slot", "first", "last", "prev_last", "next_first"), ["entity", "slot"])
    joined_back = (F.col("beg") == F.col("first")) & F.coalesce(F.col("prev_last") == F.col("beg"), F.lit(False))
    joined_on = (F.col("end") == F.col("last")) & F.coalesce(F.col("next_first") == F.col("end"), F.lit(False))
    marked = inner.withColumn("back", joined_back).withColumn("on", joined_on)
    alone = marked.where("NOT back AND NOT `on`").select("entity", F.col("beg").alias("beg_us"), F.col("end").alias("end_us"))
    # Pieces that touch a border: at most two a slot.
    chain = marked.where("back OR `on`").withColumn("island", F.sum((~F.col("back")).cast("int")).over(Window.partitionBy("entity").orderBy("beg")))
    chained = chain.groupBy("entity", "island").agg(F.min("beg").alias("beg_us"), F.max("end").alias("end_us")).drop("island")
    within = parts.select("entity", F.col("end").alias("beg_us"), F.lead("beg").over(Window.partitionBy("entity", "slot").orderBy("beg")).alias("end_us"))
    across = per.select("entity", F.col("last").alias("beg_us"), F.col("next_first").alias("end_us"))
    gaps = within.unionByName(across).where("end_us > beg_us")
    if longest_gap_us is not None:
        gaps = gaps.where(F.col("end_us") - F.col("beg_us") <= longest_gap_us)
    kind = lambda d, k: d.select("entity", F.lit(k).alias("span_kind"), "beg_us", "end_us")
    return kind(alone.unionByName(chained), "period").unionByName(kind(gaps, "gap"))
