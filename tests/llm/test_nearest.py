import datetime as dt

import numpy as np
import pytest

from obsforge.llm import nearest as m

SCHEMA = "id long, sc int, timestamp timestamp_ntz, us long, kind int, bucket string"
T0 = dt.datetime(2025, 1, 1)


def table(n, span, burst, seed):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        us = span // 2 + int(rng.integers(0, burst)) if i < n // 3 else int(rng.integers(0, span))
        out.append((i + 1, 1 if i < n // 3 else int(rng.integers(1, 3)), T0 + dt.timedelta(microseconds=us), 1, 1, "x"))
    return out + [(9001, None, T0, 1, 1, "x"), (9002, 1, None, 1, 1, "x"), (None, 1, T0, 1, 1, "x")]


def brute(left, right, tol):
    us = lambda t: int((t - T0) / dt.timedelta(microseconds=1))
    got = {}
    for i, sc, t, *_ in left:
        if None in (i, sc, t):
            continue
        c = [(abs(us(r[2]) - us(t)), r[0]) for r in right if None not in r[:3] and r[1] == sc]
        if c and min(c)[0] <= tol:
            got[i] = min(c)[1]
    return got


@pytest.mark.parametrize("burst_left, burst_right", [(1, 1), (3_000_000, 1), (1, 3_000_000)])
def test_against_brute_force(spark, monkeypatch, burst_left, burst_right):
    monkeypatch.setattr(m, "FULL", 20)
    left, a, b = table(400, 300_000_000, burst_left, 1), table(150, 300_000_000, burst_right, 2), table(60, 300_000_000, burst_right, 3)
    dfs = [spark.createDataFrame(x, SCHEMA) for x in (left, a, b)]
    got = m.nearest(dfs[0], {"a": dfs[1], "b": dfs[2]}, 12_000_000, "sc", "timestamp", "id").collect()
    assert {(r.right_name, r.left_id): r.right_id for r in got} == {("a", k): v for k, v in brute(left, a, 12_000_000).items()} | {("b", k): v for k, v in brute(left, b, 12_000_000).items()}
    assert len({(r.right_name, r.left_id) for r in got}) == len(got)


def test_edges(spark):
    at = lambda s: T0 + dt.timedelta(seconds=s)
    left = spark.createDataFrame([(10, 1, at(24), 0, 0, ""), (11, 1, at(100), 0, 0, ""), (12, 1, at(5), 0, 0, "")], SCHEMA)
    right = spark.createDataFrame([(3, 1, at(12), 0, 0, ""), (2, 1, at(36), 0, 0, ""), (4, 1, at(87.9), 0, 0, ""), (6, 1, at(5), 0, 0, ""), (5, 1, at(5), 0, 0, "")], SCHEMA)
    got = {(r.left_id, r.right_id) for r in m.nearest(left, {"r": right}, 12_000_000, "sc", "timestamp", "id").collect()}
    assert got == {(10, 2), (12, 5)}  # equal distances and times: the smaller id; 12.1 s is too far
    assert m.nearest(left.limit(0), {"r": right}, 12_000_000, "sc", "timestamp", "id").count() == 0
    assert m.nearest(left, {"r": right.limit(0)}, 12_000_000, "sc", "timestamp", "id").count() == 0
