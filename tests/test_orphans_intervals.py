import datetime as dt
import random

import pytest

from obsforge.operators.intervals import IntervalMap, periods_and_gaps
from obsforge.operators.orphans import orphans


def test_match_semantics(spark):
    refs = spark.createDataFrame([(1, 1, "a"), (2, 1, None), (3, 9, None), (4, None, None), (5, 9, "z"), (6, None, "a")], "id int, p int, q string")
    target = spark.createDataFrame([(1, "a", 0), (2, None, 0), (None, None, 0)], "k int, l string, id int")
    got = lambda m: {r.id for r in orphans(refs, target, ["p", "q"], ["k", "l"], m).collect()}
    assert got("simple") == {5}
    assert got("partial") == {3, 5}
    assert got("full") == {2, 3, 5, 6}
    assert {r.id for r in orphans(refs, target.limit(0), ["p"], ["k"]).collect()} == {1, 2, 3, 5}
    assert orphans(refs.limit(0), target, ["p"], ["k"]).count() == 0
    with pytest.raises(ValueError):
        orphans(refs, target, ["p"], ["k"], "none")


def brute(spans):
    out = []
    for b, e in sorted(spans):
        if out and b <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([b, e])
    return [tuple(x) for x in out]


def test_interval_map_in_any_order():
    rng = random.Random(1)
    for _ in range(200):
        spans = [(b, b + rng.randint(1, 12)) for b in (rng.randint(0, 80) for _ in range(rng.randint(1, 25)))]
        m = IntervalMap()
        for b, e in spans:
            m.insert(b, e)
        assert list(zip(m.begs, m.ends)) == brute(spans)
        assert list(m.gaps()) == [(a[1], b[0]) for a, b in zip(brute(spans), brute(spans)[1:])]


@pytest.mark.parametrize("slot_s", [3, 10_000])
def test_periods_over_slots(spark, slot_s):
    rng = random.Random(2)
    t0 = dt.datetime(2025, 1, 1)
    raw = [("ab"[rng.random() < 0.7], b, b + rng.randint(-2, 9)) for b in (rng.randint(0, 300) for _ in range(120))] + [(None, 1, 5), ("c", None, 3), ("c", 3, None), ("d", 7, 7)]
    at = lambda s: None if s is None else t0 + dt.timedelta(seconds=s)
    df = spark.createDataFrame([(e, at(b), at(x), 1, "k") for e, b, x in raw] * 2, "o string, b timestamp_ntz, e timestamp_ntz, slot int, entity string")
    got = periods_and_gaps(df, "o", "b", "e", 4_000_000, slot_us=slot_s * 1_000_000).collect()
    us = lambda s: int((at(s) - dt.datetime(1970, 1, 1)) / dt.timedelta(microseconds=1))
    want = set()
    for o in "ab":
        p = brute([(b, e) for x, b, e in raw if x == o and b is not None and e is not None and b < e])
        want |= {(o, "period", us(b), us(e)) for b, e in p} | {(o, "gap", us(x[1]), us(y[0])) for x, y in zip(p, p[1:]) if y[0] - x[1] <= 4}
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert periods_and_gaps(df.limit(0), "o", "b", "e").count() == 0
