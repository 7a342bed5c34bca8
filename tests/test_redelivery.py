import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from obsforge.operators import redelivery
from obsforge.operators.bloomstore import Layout, merge, mix, planes, positions

SCHEMA = "id long, sc int, sq int, ts timestamp_ntz, key string, cell long"


def brute(rows, tol=1_000_000):
    import datetime as dt

    us = lambda t: int((t - dt.datetime(1970, 1, 1)) / dt.timedelta(microseconds=1))
    good = sorted({(r[1], r[2], us(r[3]), r[0]) for r in rows if None not in r[:4]})
    drop, at = set(), []
    for r in good:
        if at and (r[:2] != at[-1][:2] or r[2] - at[-1][2] >= tol):
            drop |= {x[3] for x in at} - {min(x[3] for x in at)}
            at = []
        at.append(r)
    if at:
        drop |= {x[3] for x in at} - {min(x[3] for x in at)}
    return drop


def packets(n, seed):
    import datetime as dt

    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        ts = dt.datetime(2025, 1, 1) + dt.timedelta(microseconds=int(rng.integers(0, 40)) * 300_000 + int(rng.integers(0, 3)))
        row = [i + 1, int(rng.integers(1, 3)), int(rng.integers(0, 3)), ts, "x", 7]
        if rng.random() < 0.1:
            row[int(rng.integers(1, 4))] = None
        out.append(tuple(row))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rows = packets(400, seed)
    got = redelivery.redelivered(spark.createDataFrame(rows, SCHEMA).repartition(3), "id", ["sc", "sq"], "ts", bucket_us=4_000_000)
    assert {r.id for r in got.collect()} == brute(rows)


def test_hot_packet_and_clashing_names(spark):
    import datetime as dt

    t = dt.datetime(2025, 1, 1)
    rows = [(i, 1, 1, t + dt.timedelta(microseconds=i % 900), "a", i) for i in range(1, 3001)] + [(9000, 1, 1, t + dt.timedelta(seconds=60), "a", 1)]
    got = redelivery.redelivered(spark.createDataFrame(rows, SCHEMA), "id", ["sc", "sq"], "ts")
    assert {r.id for r in got.collect()} == set(range(2, 3001))
    assert {r.first_id for r in got.collect()} == {1}


def test_empty_and_all_null(spark):
    assert redelivery.redelivered(spark.createDataFrame([], SCHEMA), "id", ["sc", "sq"], "ts").count() == 0
    nulls = spark.createDataFrame([(None, None, None, None, None, None)] * 3, SCHEMA)
    assert redelivery.redelivered(nulls, "id", ["sc", "sq"], "ts").count() == 0
    assert redelivery.delivered_once(nulls, "id", ["sc", "sq"], "ts").count() == 3


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 2**62), min_size=1, max_size=200), st.lists(st.integers(0, 2**62), max_size=200))
def test_filters_never_forget(a, b):
    h = lambda x: mix(np.array(x, dtype=np.int64), np.zeros(len(x), np.int64))
    bits = 1024
    one, two = merge(planes(h(a), bits), planes(h(b), bits) if b else (bytes(128), bytes(128)))
    for plane, keys in ((one, [*a, *b]), (two, [x for x in set(a) | set(b) if [*a, *b].count(x) > 1])):
        if keys:
            p = positions(h(keys), np.full(len(keys), bits))
            got = (np.frombuffer(plane, np.uint8)[p >> 3] >> (7 - (p & 7)).astype(np.uint8)) & 1
            assert got.all()


def test_layout_cuts_full_buckets_by_time_then_by_key():
    hour = 3_600_000_000
    lay = Layout.of([(0, 10), (1, 10_000_000), (2, 10), (3, 1 << 33)], hour, 1_000_000)
    assert lay.slices.tolist() == [1, 10, 1, 3600] and lay.shards.tolist() == [1, 1, 1, 3] and lay.bits.max() <= 1 << 24
    rng = np.random.default_rng(1)
    us, kh = np.sort(rng.integers(0, 4 * hour, 50_000)), rng.integers(-(2**63), 2**63 - 1, 50_000)
    f, file, _ = lay.locate(us, kh)
    assert f.max() < lay.slices @ lay.shards and file.max() < lay.files and (np.diff(us // hour * 10**6 + f) >= -2).all()
    # Ten million rows of one hour in time order: each file is opened once.
    at = np.flatnonzero(us // hour == 1)
    assert (np.diff(file[at]) >= 0).all() and len(set(file[at])) == 10


def test_one_key_in_every_second_for_days(spark):
    import datetime as dt

    t = dt.datetime(2025, 1, 1, 23, 50)
    # A chain over midnight, one that ends at midnight, and far ones.
    at = [i * 0.9 for i in range(1400)] + [1500 + i * 2.0 for i in range(500)] + [90_000 + i * 0.5 for i in range(20)]
    rows = [(len(at) - i, 1, 1, t + dt.timedelta(seconds=s), "a", i) for i, s in enumerate(at)]
    got = redelivery.redelivered(spark.createDataFrame(rows, SCHEMA).repartition(3), "id", ["sc", "sq"], "ts")
    assert {r.id for r in got.collect()} == brute(rows)


def test_a_later_batch_is_screened_against_the_earlier_ones(spark, tmp_path):
    rows = [r for r in packets(600, 3) if None not in r]
    log = redelivery.DeliveryLog(spark, f"file://{tmp_path}/log", "id", ["sc", "sq"], "ts")
    parts = [rows[:200], rows[200:350], rows[350:]]
    drops = [{r.id: r.first_id for r in log.accept(spark.createDataFrame(p, SCHEMA)).collect()} for p in parts]
    kept = []
    for part, drop in zip(parts, drops):
        kept += [r for r in part if r[0] not in drop]
    for r in [x for p, d in zip(parts, drops) for x in p if x[0] in d]:
        assert any(k[1:3] == r[1:3] for k in kept)
    # What is left has no repeats but those that only a dropped row joined.
    assert len(kept) >= len(rows) - len(brute(rows)) and drops[1] and drops[2]
    assert not brute(parts[0]) ^ set(drops[0])
    assert set(brute(rows)) >= set().union(*[set(d) for d in drops])
