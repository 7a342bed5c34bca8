"""Ordered-sequence operators: cycles, anchored groups, admission, merging of block requests.

What compares a row with its neighbours is a window expression, cut into slots of
time (``slotted``).  Anchored groups
depend on all rows since the group's start, so they are a fold; the fold runs per
key and per *stretch*, a stretch being cut off by a pause longer than the group
may last, after which a new group begins whatever came before.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obsforge.operators import slotted


def cycles(df: DataFrame, keys: Sequence[str], at: str, code: str, per_step_us: int, id_col: str) -> DataFrame:
    """``df`` with ``cycle``, the first row (at, tie) of each row's polarization cycle: a new one begins where the code doesn't rise or the pause is too long for the rise."""
    near = slotted.previous(df, keys, at, id_col, [code, at], "_before")
    rise = F.col(code) - F.col(f"_before.{code}")
    cut = F.coalesce((rise <= 0) | (F.col(at) - F.col(f"_before.{at}") > per_step_us * rise), F.lit(True))
    return slotted.started(near, keys, at, id_col, cut, "cycle").drop("_before")


def anchored_groups(df: DataFrame, keys: Sequence[str], at: str, id_col: str, longest: int, most: int, schema: str) -> DataFrame:
    """``df`` with ``anchor``, the time of the first row of the group that each row falls into.

    A group begins at its first row and takes rows while they are at most ``longest`` after it and fewer than ``most`` were
    taken.  Nulls in ``at`` are dropped.  A stretch is read in order in batches, never as a whole; without keys all rows
    are one sequence, which still spreads over its stretches.
    """
    near = slotted.previous(df.where(F.col(at).isNotNull()), keys, at, id_col, [at], "_before")
    pause = F.coalesce(F.col(at) - F.col(f"_before.{at}") > longest, F.lit(True))
    marked = slotted.started(near.withColumn("_start", pause), keys, at, id_col, F.col("_start"), "_stretch").drop("_before")
    spread = marked.repartition(*keys, "_stretch").sortWithinPartitions(*keys, "_stretch", at, id_col).drop("_stretch")
    names = [*df.columns, "anchor"]

    def fold(batches):
        anchor, n = None, 0
        for pdf in batches:
            t, start, out = pdf[at].to_numpy(), pdf["_start"].to_numpy(), np.empty(len(pdf), np.int64)
            for i in range(len(pdf)):
                if start[i] or anchor is None or t[i] - anchor > longest or n >= most:
                    anchor, n = t[i], 0
                n += 1
                out[i] = anchor
            pdf["anchor"] = out
            yield pdf[names]

    return spread.mapInPandas(fold, f"{schema}, anchor long")


def admit(df: DataFrame, order: Sequence[Column], weight: str, share: str, most_weight: float, most_share: float) -> DataFrame:
    """The rows taken in order while the weight and share taken before stay under their limits; the last may overshoot.

    The running sums need one order over all rows, so only as many rows as could be admitted are kept first:
    with weights of at least the smallest one, that is most_weight / smallest + 1.
    """
    least = df.agg(F.min(weight)).collect()[0][0]
    if least is None or least <= 0:
        head = df
    else:
        head = df.orderBy(*order).limit(int(most_weight / least) + 1)
    w = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c: F.coalesce(F.sum(c).over(w), F.lit(0))
    return head.withColumn("_w", before(weight)).withColumn("_s", before(share)).where((F.col("_w") < most_weight) & (F.col("_s") < most_share)).drop("_w", "_s")


def merge_blocks(df: DataFrame, keys: Sequence[str], start: str, length: str, tolerance: int = 0) -> DataFrame:
    """(keys, start, end, requests): requests [start, start + length) joined where they overlap, touch or are ``tolerance`` apart."""
    end = F.col(start) + F.col(length)
    w = Window.partitionBy(*keys).orderBy(start, "_end")
    spans = df.select(*keys, start, end.alias("_end"))
    reach = F.max("_end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    cut = spans.withColumn("_cut", F.coalesce((F.col(start) > reach + tolerance).cast("int"), F.lit(1)))
    return cut.withColumn("_i", F.sum("_cut").over(w)).groupBy(*keys, "_i").agg(F.min(start).alias("start"), F.max("_end").alias("end"), F.count("*").alias("requests")).drop("_i")


def ring_blocks(df: DataFrame, keys: Sequence[str], start: str, length: str, low: int = 2048, high: int = 24575) -> DataFrame:
    """(keys, start_block, replay_length, requests): replay requests on each key's ring of flash blocks, merged where they overlap or touch.

    Requests that begin outside the ring, and null ones, are left out; a negative length wraps around the ring's end, and
    what reaches beyond the end joins the requests at its beginning.  A merged request's length counts both its ends, a
    single one keeps its own.  Requests of one start are counted before the shuffle, so a key has at most one row a block.
    """
    size = high - low + 1
    whole = F.when(F.col(length) < 0, F.col(length) + size).otherwise(F.col(length)).cast("long")
    spans = df.where(F.col(start).between(low, high) & F.col(length).isNotNull()).groupBy(*keys, F.col(start).cast("long").alias("b")).agg(F.max(whole).alias("w"), F.count("*").alias("n"))
    own = Window.partitionBy(*keys)
    order = own.orderBy("b")
    reach = F.max(F.col("b") + F.col("w")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    cut = spans.withColumn("c", F.coalesce((F.col("b") > reach).cast("int"), F.lit(1))).withColumn("i", F.sum("c").over(order))
    groups = cut.groupBy(*keys, "i").agg(F.min("b").alias("b"), F.max(F.col("b") + F.col("w")).alias("e"), F.sum("n").alias("n"))
    last = groups.withColumn("last", F.max("i").over(own)).withColumn("over", F.max(F.when(F.col("i") == F.col("last"), F.col("e") - size)).over(own))
    taken = (F.col("i") < F.col("last")) & (F.col("over") > low) & (F.col("b") <= F.col("over"))
    shift = lambda c: F.when(taken, F.col(c) + size).otherwise(F.col(c)).alias(c)
    at = last.select(*keys, F.when(taken, F.col("last")).otherwise(F.col("i")).alias("i"), shift("b"), shift("e"), "n")
    done = at.groupBy(*keys, "i").agg(F.min("b").alias("b"), F.max("e").alias("e"), F.sum("n").alias("n"))
    return done.select(*keys, F.col("b").alias("start_block"), F.when(F.col("n") == 1, F.col("e") - F.col("b")).otherwise(F.col("e") - F.col("b") + 1).alias("replay_length"), F.col("n").alias("requests"))


def ring_requests(requests: pd.DataFrame, low: int = 2048, high: int = 24575, since=None, until=None) -> pd.DataFrame:
    """Replay requests (start_time, start_block, replay_length) on a ring of flash blocks, merged where they overlap or touch.

    Requests outside [since, until] or the ring are left out.  A negative length wraps around the ring's end; a wrapped
    request joins with one that its rest reaches.  A merged request's length counts both its ends, a single one keeps its
    own: that is what the receiving side expects.  The list is a command file of tens to hundreds of rows, on the driver.
    """
    r = requests[requests["start_block"].between(low, high)]
    if "start_time" in r:
        t = pd.to_datetime(r["start_time"])
        r = r[(t >= since if since is not None else t.notna()) & (t <= until if until is not None else t.notna())]
    size = high - low + 1
    spans = []  # begin, end, number of requests, raw length, time of the first
    for k, start, length in zip(r["start_time"] if "start_time" in r else range(len(r)), r["start_block"], r["replay_length"]):
        whole = length + size if length < 0 else length
        spans.append([start, start + whole, 1, whole, k])
    out: list[list] = []
    for s in sorted(spans, key=lambda s: s[0]):
        if out and s[0] <= out[-1][1]:
            out[-1] = [out[-1][0], max(out[-1][1], s[1]), out[-1][2] + s[2], None, min(out[-1][4], s[4])]
        else:
            out.append(s)
    # What reaches beyond the end comes back at the low end.
    while len(out) > 1 and out[-1][1] > high + 1 and out[-1][1] - size >= out[0][0]:
        head, last = out.pop(0), out[-1]
        out[-1] = [last[0], max(last[1], head[1] + size), last[2] + head[2], None, min(last[4], head[4])]
    rows = [(k, b, raw if raw is not None else e - b + 1) for b, e, _, raw, k in out]
    return pd.DataFrame(sorted(rows), columns=["start_time", "start_block", "replay_length"])
