"""Implausible spikes, stuck values and impossible readings per source.

Three rules and one statistic:

* (a) plausibility: below 0, above 100 for a percentage, above the memory of the
  source, which its ordinary (usage, percentage) pairs show;
* (b) stuck: one of at least ``stuck`` consecutive non-null readings of one value;
* (c) spike: one to three consecutive readings that all lie above, or all below,
  both readings around them by more than ``factor`` usual steps.  Readings under
  (a) are passed over; those under (a) and (b) do not count for the usual step,
  the exact median step of the source and field;
* peaks over threshold: heights of local excursions of the seasonal residuals
  (reading minus the source's median of that hour of the day).
  Those over a threshold, per source and field the lower of a high quantile and half
  the bound of rule (c), are the peaks.  A generalised Pareto law fitted to the
  ordinary ones by probability-weighted moments gives the cutoff exceeded at a fixed risk.

Readings beyond the fitted cutoff are the candidates that go on to rule (c), whose
factor is fixed; where the cutoff lies above the rule's bound, or there is none, the
bound takes its place, so no case is lost.  ``beyond_tail`` is the fit's own verdict.

A source's sequence is cut into chunks of time that one task each works on.  The
first and last readings of each chunk come out marked as edges; whatever reaches
across a chunk's border is found in a second pass over the edges alone.

Defined cases: null readings, sources and times are passed over; ties in time
are ordered by id; a source without ordinary memory pairs has no memory limit; a
source with an unknown usual step has no spikes, and any excursion is one if the
step is zero; NaN counts as null; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from obsforge.catalog import micros
from obsforge.operators.ordered import chunk_width
from obsforge.session import materialize

FIELDS = ("cpu_usage", "memory_usage", "disk_percentage")
ROWS_PER_CHUNK = 100_000
FINE, TAIL_FINE = 4096, 64
KEYS = ["host", "field_name"]
REACH = 3  # a spike's longest run


def weighted_median(counts: DataFrame, keys: Sequence[str], value: str, n: str, name: str) -> DataFrame:
    """Exact median per keys of values given with counts: the mean of the two middle ones."""
    w = Window.partitionBy(*keys)
    c = counts.withColumn("_cum", F.sum(n).over(w.orderBy(value).rowsBetween(Window.unboundedPreceding, 0))).withColumn("_all", F.sum(n).over(w))
    lo, hi = F.floor((F.col("_all") + 1) / 2), F.floor((F.col("_all") + 2) / 2)
    return c.groupBy(*keys).agg(
        ((F.min(F.when(F.col("_cum") >= lo, F.col(value))) + F.min(F.when(F.col("_cum") >= hi, F.col(value)))) / 2).alias(name)
    )


def memory_of(health: DataFrame, source: str = "host") -> DataFrame:
    """(source, capacity): the memory of each source, from usage over percentage.

    The ratios are counted in bins of 1/4096 octave, so that one row a bin and source remains before
    the shuffle; the mean of the median bin and its neighbours is taken, and made whole if it is nearly so.
    """
    ok = (F.col("memory_usage") > 0) & (F.col("memory_percentage") > 0) & (F.col("memory_percentage") <= 100) & (F.col("memory_usage") < 1e9)
    ratio = F.col("memory_usage") / F.col("memory_percentage") * 100
    bins = health.where(ok).select(source, ratio.alias("r"), F.floor(F.log2(ratio) * FINE).alias("bin")).groupBy(source, "bin").agg(F.count("*").alias("n"), F.sum("r").alias("s"))
    own = Window.partitionBy(source)
    half = (F.sum("n").over(own) + 1) / 2
    c = bins.withColumn("cum", F.sum("n").over(own.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))).withColumn("half", half)
    mid = c.withColumn("mid", F.min(F.when(F.col("cum") >= F.floor("half"), F.col("bin"))).over(own))
    cap = mid.where(F.abs(F.col("bin") - F.col("mid")) <= 3).groupBy(source).agg((F.sum("s") / F.sum("n")).alias("c"))
    return cap.select(source, F.when(F.abs(F.col("c") - F.round("c")) <= 0.002 * F.col("c"), F.round("c")).otherwise(F.col("c")).alias("capacity"))


def _hour() -> Column:
    return F.floor(F.pmod("us", F.lit(86_400_000_000)) / 3_600_000_000)


def readings(health: DataFrame, fields: Sequence[str] = FIELDS) -> DataFrame:
    """(health_id, host, us, field_name, value, season, impossible): one row for each non-null reading."""
    cap = memory_of(health)
    number = lambda f: F.nanvl(F.col(f).cast("double"), F.lit(None).cast("double"))
    wide = health.select("health_id", "host", micros("datetime").alias("us"), *[number(f).alias(f) for f in fields]).where("host IS NOT NULL AND us IS NOT NULL AND health_id IS NOT NULL")
    wide = wide.withColumn("hour", _hour())
    # 24 rows a source.
    season = wide.groupBy("host", "hour").agg(*[F.percentile_approx(f, 0.5, 1000).alias(f"s_{f}") for f in fields])
    pairs = F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).alias("value"), F.col(f"s_{f}").alias("season")) for f in fields])
    long = wide.join(season, ["host", "hour"]).select("health_id", "host", "us", F.explode(pairs).alias("p")).select("health_id", "host", "us", "p.*").where("value IS NOT NULL")
    limit = F.when(F.col("field_name") == "memory_usage", F.col("capacity")).otherwise(F.lit(100.0))
    return long.join(cap, "host", "left").select("health_id", "host", "us", "field_name", "value", "season", ((F.col("value") < 0) | F.coalesce(F.col("value") > limit, F.lit(False))).alias("impossible"))


def heights(x: np.ndarray, longest: int = 3) -> np.ndarray:
    """For each reading the greatest height by which a run of up to ``longest`` readings around it stands off both its neighbours."""
    n, out = len(x), np.zeros(len(x))
    for m in range(1, longest + 1):
        if n < m + 2:
            break
        inner = np.lib.stride_tricks.sliding_window_view(x[1:-1], m)
        a, b = x[: n - m - 1], x[m + 1 :]
        up = inner.min(axis=1) - np.maximum(a, b)
        down = np.minimum(a, b) - inner.max(axis=1)
        h = np.maximum(up, down)
        for k in range(m):
            at = slice(1 + k, 1 + k + len(h))
            out[at] = np.maximum(out[at], h)
    return out


MARKED = "health_id long, host string, field_name string, chunk long, us long, value double, season double, impossible boolean, stuck boolean, edge boolean, place int, possible_place int, left int, step double, height double, residual double"


def _mark(run: int):
    """One chunk of one source and field by itself."""
    keep = run + REACH + 1

    def f(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["us", "health_id"], kind="stable")
        v, n = pdf["value"].to_numpy(), len(pdf)
        start = np.concatenate([[True], v[1:] != v[:-1]])
        size = np.diff(np.append(np.flatnonzero(start), n))
        stuck = np.repeat(size, size) >= run
        ok = ~pdf["impossible"].to_numpy(bool)
        at, m = np.flatnonzero(ok), int(ok.sum())
        place = np.arange(n)
        among, left = np.full(n, -1), np.full(n, -1)
        among[at], left[at] = np.arange(m), np.arange(m)[::-1]
        step, height, residual = np.full(n, np.nan), np.zeros(n), np.zeros(n)
        if m:
            w, held = v[at], stuck[at]
            d = np.abs(np.diff(w))
            d[held[1:] | held[:-1]] = np.nan
            step[at[1:]] = np.round(d, 9)
            height[at], residual[at] = heights(w), heights(w - pdf["season"].to_numpy()[at])
        pdf["stuck"], pdf["place"], pdf["possible_place"], pdf["left"] = stuck, place, among, left
        pdf["edge"] = (place < keep) | (place >= n - keep) | ok & ((among < keep) | (left < keep))
        pdf["step"], pdf["height"], pdf["residual"] = step, height, residual
        return pdf[[c.split()[0] for c in MARKED.split(", ")]]

    return f


@F.pandas_udf(DoubleType())
def _height_at(around: pd.Series, at: pd.Series) -> pd.Series:
    return pd.Series([heights(np.asarray(x, float))[k] for x, k in zip(around, at)], dtype=float)


def _edges(marked: DataFrame, run: int) -> DataFrame:
    """The edge readings with what reaches across the borders of chunks: at most a few dozen rows a chunk."""
    seq = Window.partitionBy(*KEYS).orderBy("us", "health_id")
    edge = marked.where("edge")
    lag = lambda c: F.lag(c).over(seq)
    joined = lambda place: (lag("chunk") != F.col("chunk")) | (lag(place) + 1 == F.col(place))
    new = ~F.coalesce(joined("place") & (lag("value") == F.col("value")), F.lit(False))
    island = edge.withColumn("island", F.sum(new.cast("int")).over(seq))
    edge = island.withColumn("stuck", F.col("stuck") | (F.count("*").over(Window.partitionBy(*KEYS, "island")) >= run)).drop("island")
    fine = edge.where("NOT impossible")
    free = ~F.col("stuck") & ~lag("stuck")
    step = F.when(lag("value").isNull(), None).when(joined("possible_place"), F.when(free, F.round(F.abs(F.col("value") - lag("value")), 9))).otherwise(F.col("step"))
    wide = seq.rowsBetween(-REACH - 1, REACH + 1)
    before = F.least(F.row_number().over(seq) - 1, F.lit(REACH + 1))
    off = F.col("value") - F.col("season")
    fine = fine.select("*", step.alias("_step"), F.collect_list("value").over(wide).alias("_near"), F.collect_list(off).over(wide).alias("_off"), before.cast("int").alias("_at"))
    border = (F.col("possible_place") <= REACH) | (F.col("left") <= REACH)
    again = lambda near, known: F.when(border, _height_at(F.when(border, F.col(near)).otherwise(F.array(F.lit(0.0))), F.when(border, F.col("_at")).otherwise(0))).otherwise(F.col(known))
    fine = fine.withColumn("height", again("_near", "height")).withColumn("residual", again("_off", "residual")).withColumn("step", F.col("_step")).drop("_step", "_near", "_off", "_at")
    return fine.unionByName(edge.where("impossible"))


def analyse(health: DataFrame, stuck: int = 20) -> DataFrame:
    """Each reading with its flags under (a) and (b), the step to it and the height of the excursion that it is in."""
    slim = health.select("host", micros("datetime").alias("us")).where("host IS NOT NULL AND us IS NOT NULL")
    width = chunk_width(slim, ["host"], "us", ROWS_PER_CHUNK)
    chunked = readings(health).withColumn("chunk", F.floor(F.col("us") / width))
    marked = materialize(chunked.groupBy(*KEYS, "chunk").applyInPandas(_mark(stuck), MARKED), "readings")
    edges = materialize(_edges(marked, stuck), "edges")
    cols = ["health_id", *KEYS, "us", "value", "season", "impossible", "stuck", "step", "height", "residual"]
    return marked.where("NOT edge").select(cols).unionByName(edges.select(cols))


def usual_steps(exc: DataFrame) -> DataFrame:
    """(host, field_name, usual): the exact median step; equal steps are counted before the shuffle."""
    counts = exc.where("step IS NOT NULL AND NOT isnan(step)").groupBy(*KEYS, "step").agg(F.count("*").alias("n"))
    return weighted_median(counts, KEYS, "step", "n", "usual")


def pot_cutoffs(exc: DataFrame, factor: float = 10.0, level: float = 0.98, risk: float = 1e-4) -> DataFrame:
    """(host, field_name, usual, n, threshold, shape, scale, cutoff): a generalised Pareto law of the heights over the threshold.

    Peaks that break rule (c) are no part of a source's normal behaviour and don't enter the fit; a source without other peaks has no cutoff.
    Heights are counted in bins of 1/64 octave, a mergeable table of bounded size per source, from which quantile
    and probability-weighted moments are read; nothing is gathered per source.
    """
    usual = usual_steps(exc)
    bins = exc.where("NOT impossible").groupBy(*KEYS, F.when(F.col("residual") > 0, F.floor(F.log2("residual") * TAIL_FINE)).alias("bin")).agg(F.count("*").alias("n"), F.sum("residual").alias("s"))
    own = Window.partitionBy(*KEYS)
    up = own.orderBy(F.col("bin").asc_nulls_first())
    c = bins.withColumn("all", F.sum("n").over(own)).withColumn("cum", F.sum("n").over(up.rowsBetween(Window.unboundedPreceding, 0)))
    low = F.coalesce(F.pow(F.lit(2.0), F.col("bin") / TAIL_FINE), F.lit(0.0))
    c = c.withColumn("high", F.min(F.when(F.col("cum") >= level * F.col("all"), low)).over(own)).join(usual, KEYS)
    c = c.withColumn("threshold", F.least("high", factor / 2 * F.col("usual"))).withColumn("mean", F.col("s") / F.col("n"))
    ordinary = F.when((F.col("mean") > F.col("threshold")) & (F.col("mean") <= factor * F.col("usual")), F.col("n"))
    c = c.withColumn("own", ordinary).withColumn("k", F.sum("own").over(own)).withColumn("rank", F.sum("own").over(up.rowsBetween(Window.unboundedPreceding, 0)) - F.col("own") / 2)
    x = F.col("mean") - F.col("threshold")
    m = c.groupBy(*KEYS, "usual", F.col("all").alias("n"), "threshold", "k").agg(
        (F.sum(F.col("own") * x) / F.first("k")).alias("m0"), (F.sum(F.col("own") * x * (1 - F.col("rank") / F.col("k"))) / F.first("k")).alias("m1")
    )
    gap = F.col("m0") - 2 * F.col("m1")
    m = m.withColumn("shape", F.coalesce(2 - F.try_divide(F.col("m0"), gap), F.lit(0.0))).withColumn("scale", F.coalesce(2 * F.try_divide(F.col("m0") * F.col("m1"), gap), F.col("m0")))
    t = F.lit(risk) * F.col("n") / F.col("k")
    cut = F.when(F.abs("shape") < 1e-6, F.col("threshold") - F.col("scale") * F.ln(t)).otherwise(F.col("threshold") + F.col("scale") / F.col("shape") * (F.pow(t, -F.col("shape")) - 1))
    return m.select(*KEYS, "usual", "n", "threshold", "shape", "scale", F.when(F.col("k") > 0, F.greatest(cut, F.col("threshold"))).alias("cutoff"))


def flags(health: DataFrame, factor: float = 10.0, stuck: int = 20, risk: float = 1e-4) -> DataFrame:
    """(health_id, field_name, impossible, stuck, spike, beyond_tail) of each flagged reading."""
    exc = analyse(health, stuck)
    limits = pot_cutoffs(exc, factor, risk=risk).select(*KEYS, "usual", "cutoff")
    no, bound = F.lit(False), factor * F.col("usual")
    candidate = F.coalesce(F.greatest("height", "residual") > F.least("cutoff", bound), no) & ~F.col("impossible")
    spike = candidate & (F.col("height") > bound)
    tail = candidate & F.coalesce(F.col("residual") > F.col("cutoff"), no)
    seen = exc.where("impossible OR stuck OR height > 0 OR residual > 0").join(limits, KEYS, "left")
    return seen.select("health_id", "field_name", "impossible", "stuck", spike.alias("spike"), tail.alias("beyond_tail")).where("impossible OR stuck OR spike OR beyond_tail")
