"""Structured Streaming: packet ingest, windows, group completion, interval state.

The catalogue's polling loops become streams: new files are the file source with
its checkpoint; late packets are watermarks; groups that wait for members are
keyed state that ends on completion or after a timeout.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from obsforge.operators.intervals import IntervalMap


def read_table(spark: SparkSession, path: str, like: DataFrame, per_trigger: int = 1, bytes_per_trigger: int | None = None) -> DataFrame:
    """A folder of Parquet files as a stream, so many files a micro-batch, or as many as have so many bytes (one at least)."""
    limit = ("maxBytesPerTrigger", bytes_per_trigger) if bytes_per_trigger else ("maxFilesPerTrigger", per_trigger)
    return spark.readStream.schema(like.schema).option(*limit).parquet(path)


def once(df: DataFrame, keys: list[str], ts: str, late: str = "7 days") -> DataFrame:
    """Each identifier once among all rows no later than the watermark allows."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)


def tumbling_counts(df: DataFrame, ts: str, width: str, keys: list[str], late: str = "7 days", slide: str | None = None) -> DataFrame:
    timed = df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
    return timed.groupBy(F.window(ts, width, slide or width).alias("w"), *keys).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), *keys, "n")


def complete_groups(df: DataFrame, group: str, member: str, ts: str, size: int, timeout_ms: int, late: str = "7 days", buckets: int = 256) -> DataFrame:
    """(group, members, complete): a group is given out when it has ``size`` different members, or unfinished once the stream's
    time is ``timeout_ms`` past its last member.  A group is held as at most ``size`` member ids.

    The state is keyed by bucket, as a call and a state row for each group cost far more than its members.  A bucket holds its
    open groups as arrays, which are worked on together; ``buckets`` must stay as it is for the life of a checkpoint.
    """

    def step(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        mark = state.getCurrentWatermarkMs()
        groups, due, sizes, members = (np.array(x, np.int64) for x in (state.get if state.exists else [()] * 4))
        owners, seen, members = [np.repeat(groups, sizes)], [groups], [members]
        due = [due]
        for pdf in () if state.hasTimedOut else batches:
            g, known = pdf["grp"].to_numpy(np.int64), pdf["known"].to_numpy(bool)
            seen.append(g)
            due.append(np.maximum(pdf["ms"].to_numpy(np.int64), mark) + timeout_ms)
            owners.append(g[known])
            members.append(pdf["member"].to_numpy(np.int64)[known])
        groups, place = np.unique(np.concatenate(seen), return_inverse=True)
        last = np.full(len(groups), np.iinfo(np.int64).min)
        np.maximum.at(last, place, np.concatenate(due))
        owners, members = np.concatenate(owners), np.concatenate(members)
        order = np.lexsort((members, owners))
        owners, members = owners[order], members[order]
        new = np.ones(len(owners), bool)
        new[1:] = (np.diff(owners) != 0) | (np.diff(members) != 0)
        owners, members = owners[new], members[new]
        begs, ends = (np.searchsorted(owners, groups, side) for side in ("left", "right"))
        complete = ends - begs >= size
        out = complete | (last < mark)
        stay = ~out
        if stay.any():
            held = np.repeat(stay, ends - begs)
            state.update(tuple(x.tolist() for x in (groups[stay], last[stay], (ends - begs)[stay], members[held])))
            state.setTimeoutTimestamp(max(int(last[stay].min()), mark + 1))
        elif state.exists:
            state.remove()
        if out.any():
            names = groups[out] if key[0] >= 0 else [None]
            yield pd.DataFrame({"grp": names, "members": [members[b:e] for b, e in zip(begs[out], ends[out])], "complete": complete[out]})

    timed = df.select(F.col(group).cast("long").alias("grp"), F.col(member).cast("long").alias("member"), F.col(ts).cast("timestamp").alias("at")).withWatermark("at", late)
    bucket = F.when(F.col("grp").isNull(), -1).otherwise(F.pmod(F.xxhash64("grp"), F.lit(buckets))).cast("int")
    or_0 = lambda c: F.coalesce(c, F.lit(0).cast("long"))  # noqa: E731  (nulls would make a column of floats)
    keyed = timed.select(bucket.alias("bucket"), or_0(F.col("grp")).alias("grp"), F.col("member").isNotNull().alias("known"), or_0(F.col("member")).alias("member"), or_0(F.unix_millis("at")).alias("ms"), "at")
    held = "groups array<long>, due array<long>, sizes array<long>, members array<long>"
    return keyed.groupBy("bucket").applyInPandasWithState(step, "grp long, members array<long>, complete boolean", held, "update", GroupStateTimeout.EventTimeTimeout)


def interval_maps(df: DataFrame, entity: str, beg: str, end: str) -> DataFrame:
    """(entity, periods, gaps, covered_us) after each micro-batch that touches the entity.

    The ordered map of disjoint intervals is the entity's state; each insertion is a binary search and a merge.
    Give entity x slot of time as the entity to spread a busy one.
    """

    def step(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        m = IntervalMap(*(list(x) for x in state.get)) if state.exists else IntervalMap()
        for pdf in batches:
            for b, e in zip(pdf["beg"].tolist(), pdf["end"].tolist()):
                m.insert(int(b), int(e))
        state.update((m.begs, m.ends))
        yield pd.DataFrame({"entity": [key[0]], "periods": [len(m)], "gaps": [max(0, len(m) - 1)], "covered_us": [sum(m.ends) - sum(m.begs)]})

    us = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    spans = df.select(F.col(entity).alias("entity"), us(beg).alias("beg"), us(end).alias("end")).where("entity IS NOT NULL AND beg < end")
    return spans.groupBy("entity").applyInPandasWithState(step, "entity string, periods long, gaps long, covered_us long", "begs array<long>, ends array<long>", "update", GroupStateTimeout.NoTimeout)


def cycle_sessions(df: DataFrame, key: str, at: str, code: str, member: str, per_step_us: int, widest_step: int, late: str) -> DataFrame:
    """(key, start_us, n, first_member) of each finished cycle: rising codes with pauses of at most ``per_step_us`` a step.

    Rows wait in the state until the watermark has passed them, so they are taken in order of time however they arrive;
    rows later than ``late`` are dropped.  A cycle is finished by the row that begins the next one, or once the stream's
    time is past any row that could go on with it.  The state holds the rows of ``late`` and one open cycle.
    """
    longest = per_step_us * widest_step

    def step(name, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        waiting, now = [], None
        if state.exists:
            us, codes, members, *now = state.get
            waiting, now = list(zip(us, codes, members)), (list(now) if now[0] is not None else None)
        if not state.hasTimedOut:
            for pdf in batches:
                waiting += list(zip(pdf["us"].tolist(), pdf["code"].tolist(), pdf["member"].tolist()))
        mark, out = state.getCurrentWatermarkMs() * 1000, []
        waiting.sort(key=lambda w: (w[0], w[2]))
        ripe = sum(w[0] <= mark for w in waiting)
        for us, c, m in waiting[:ripe]:
            rise = c - now[0] if now else 0
            if rise <= 0 or us - now[1] > per_step_us * rise:
                out += [(name[0], *now[2:])] if now else []
                now = [c, us, us, 0, m]
            now[0], now[1], now[3] = c, us, now[3] + 1
        waiting = waiting[ripe:]
        if now and now[1] + longest < mark:
            out.append((name[0], *now[2:]))
            now = None
        if waiting or now:
            columns = [list(x) for x in zip(*waiting)] or [[], [], []]
            state.update((*columns, *(now or [None] * 5)))
            due = min([w[0] for w in waiting[:1]] + ([now[1] + longest] if now else []))
            state.setTimeoutTimestamp(max(due // 1000 + 1, state.getCurrentWatermarkMs() + 1))
        elif state.exists:
            state.remove()
        yield pd.DataFrame(out, columns=["key", "start_us", "n", "first_member"])

    timed = df.select(F.col(key).alias("key"), F.col(code).cast("int").alias("code"), F.col(member).alias("member"), F.col(at).cast("timestamp").alias("at")).dropna().withWatermark("at", late)
    held = "us array<long>, codes array<int>, members array<long>, code int, last_us long, start_us long, n long, first_member long"
    return timed.withColumn("us", F.unix_micros("at")).groupBy("key").applyInPandasWithState(step, "key string, start_us long, n long, first_member long", held, "append", GroupStateTimeout.EventTimeTimeout)


def run_to_table(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Process what is there and stop.  Each micro-batch is written under its own number, so a repeated one replaces itself."""

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(put).trigger(availableNow=True).start().awaitTermination()
