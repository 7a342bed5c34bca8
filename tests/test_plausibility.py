import datetime as dt

import numpy as np
import pytest

from obsforge.operators import plausibility

SCHEMA = "health_id long, datetime timestamp_ntz, cpu_usage double, memory_usage double, memory_percentage double, disk_usage double, disk_percentage double, num_pids int, host string, value double, us long"


def series(seed=0, n=600):
    rng = np.random.default_rng(seed)
    t, out = dt.datetime(2025, 1, 1), []
    for i in range(n):
        cpu = 40 + 5 * np.sin(i / 50) + rng.normal(0, 0.3)
        mem = 20 + rng.normal(0, 0.1)
        out.append([i + 1, t + dt.timedelta(seconds=60 * i), round(float(cpu), 3), round(float(mem), 3), round(float(mem) / 64 * 100, 1), 1.0, round(30 + float(rng.normal(0, 0.05)), 3), 5, "h", 1.0, 1])
    return out


def flagged(spark, rows):
    got = plausibility.flags(spark.createDataFrame([tuple(r) for r in rows], SCHEMA)).where("impossible OR stuck OR spike")
    return {(r.health_id, r.field_name) for r in got.collect()}


@pytest.mark.parametrize("chunk", [100_000, 10])
def test_rules(spark, monkeypatch, chunk):
    monkeypatch.setattr(plausibility, "ROWS_PER_CHUNK", chunk)
    rows = series()
    base = flagged(spark, rows)
    rows[50][2] = -3.0
    rows[60][2] = 120.0
    rows[70][3] = 70.0  # above the 64 GB of the host
    for i in range(100, 120):
        rows[i][6] = 33.3
    for i in range(200, 219):
        rows[i][6] = 33.31  # one short of stuck
    rows[300][2] += 40
    rows[400][2] -= 30
    rows[401][2] -= 31
    rows[500][2] = None
    rows[500][6] = float("nan")
    want = {(51, "cpu_usage"), (61, "cpu_usage"), (71, "memory_usage"), (301, "cpu_usage"), (401, "cpu_usage"), (402, "cpu_usage")} | {(i + 1, "disk_percentage") for i in range(100, 120)}
    assert flagged(spark, rows) - base == want
    assert not base


def test_empty_and_null(spark):
    assert plausibility.flags(spark.createDataFrame([], SCHEMA)).count() == 0
    assert plausibility.flags(spark.createDataFrame([(None,) * 11, (1, dt.datetime(2025, 1, 1), None, None, None, None, None, None, "h", None, None)], SCHEMA)).count() == 0


def test_heights():
    assert plausibility.heights(np.array([1.0, 5.0, 1.0])).tolist() == [0, 4, 0]
    assert plausibility.heights(np.array([1.0, 5.0, 6.0, 2.0])).tolist() == [0, 3, 3, 0]
    assert plausibility.heights(np.array([3.0])).tolist() == [0]


def plainly(rows, stuck=20, factor=10):
    """The rules by loops over one field."""
    out, seq = set(), sorted((r[1], r[0], r[2]) for r in rows if r[2] is not None)
    v = [x[2] for x in seq]
    held, i = set(), 0
    while i < len(v):
        j = i
        while j < len(v) and v[j] == v[i]:
            j += 1
        if j - i >= stuck:
            held |= set(range(i, j))
        i = j
    bad = {i for i, x in enumerate(v) if x < 0 or x > 100}
    at = [i for i in range(len(v)) if i not in bad]
    steps = [round(abs(v[b] - v[a]), 9) for a, b in zip(at, at[1:]) if a not in held and b not in held]
    usual = float(np.median(steps))
    w = [v[i] for i in at]
    for m in (1, 2, 3):
        for k in range(1, len(w) - m):
            run, a, b = w[k : k + m], w[k - 1], w[k + m]
            if max(min(run) - max(a, b), min(a, b) - max(run)) > factor * usual:
                out |= set(at[k : k + m])
    return {seq[i][1] for i in out | bad | held}


@pytest.mark.parametrize("seed", range(3))
def test_chunks_against_loops(spark, monkeypatch, seed):
    monkeypatch.setattr(plausibility, "ROWS_PER_CHUNK", [11, 45, 400][seed])
    rng, rows = np.random.default_rng(seed), series(seed, 1500)
    for r in rows:
        if rng.random() < 0.1:
            r[2] = [None, -1.0, 140.0, 40.0, 80.0][rng.integers(0, 5)]
    for _ in range(12):  # stuck and impossible stretches of about the limit's length
        a, n = int(rng.integers(0, 1400)), int(rng.integers(15, 45))
        for i in range(a, a + n):
            rows[i][2] = 150.0 if rng.random() < 0.2 and n > 30 else rows[a][2]
    got = {i for i, f in flagged(spark, rows) if f == "cpu_usage"}
    assert got == plainly(rows)
