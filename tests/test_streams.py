"""Streams over folders of files: many files a micro-batch, and state that goes through several."""

import datetime as dt
import os

import duckdb
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from compare import canon
from obsforge.plans import streams
from obsforge.streaming import ingest


def put(folder, number, table):
    """A file later than those of smaller numbers: a stream takes files by their time."""
    folder.mkdir(exist_ok=True)
    path = folder / f"part-{number:05d}.parquet"
    pq.write_table(table, path)
    os.utime(path, (1_700_000_000 + number,) * 2)


def members(rows):
    """(group, member, seconds) as a table."""
    g, m, s = zip(*rows)
    return pa.table({"grp": pa.array(g, "int64"), "member": pa.array(m, "int64"), "at": pa.array([dt.datetime(2025, 10, 4) + dt.timedelta(seconds=x) for x in s], pa.timestamp("us"))})


@pytest.mark.parametrize("more", [{}, {"buckets": 1}])
def test_groups_across_batches(spark, tmp_path, more):
    hour, long = 3600, 2**60 + 1
    put(tmp_path / "in", 0, members([(1, 10, 0), (1, 10, 1), (1, None, 2), (2, 20, 0), (3, 31, 0), (3, 30, 0), (None, 40, 0), (4, long, 0), (4, None, 0), (7, None, 0)]))
    put(tmp_path / "in", 1, members([(1, 11, hour), (8, 80, hour)]))
    put(tmp_path / "in", 2, members([(5, 50, 4 * hour)]))
    put(tmp_path / "in", 3, members([(5, 50, 4 * hour), (6, 60, 4 * hour)]))
    like = spark.read.parquet(str(tmp_path / "in"))
    df = ingest.complete_groups(ingest.read_table(spark, str(tmp_path / "in"), like), "grp", "member", "at", 2, 2 * hour * 1000, "1 second", **more)
    ingest.run_to_table(df, f"{tmp_path}/rows", f"{tmp_path}/checkpoint", "update")
    got = [(r.grp, sorted(r.members), r.complete) for r in spark.read.parquet(f"{tmp_path}/rows").collect()]
    want = [(1, [10, 11], True), (3, [30, 31], True), (2, [20], False), (None, [40], False), (4, [long], False), (7, [], False), (8, [80], False)]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_groups_share_state_rows(spark, tmp_path):
    put(tmp_path / "in", 0, members([(k, k, 0) for k in range(3000)]))
    like = spark.read.parquet(str(tmp_path / "in"))
    df = ingest.complete_groups(ingest.read_table(spark, str(tmp_path / "in"), like), "grp", "member", "at", 2, 1000, "1 hour")
    q = df.writeStream.outputMode("update").option("checkpointLocation", f"{tmp_path}/checkpoint").format("noop").trigger(availableNow=True).start()
    q.awaitTermination()
    assert 0 < q.lastProgress["stateOperators"][0]["numRowsTotal"] <= 256


def over_folder(spark, sf, tmp_path, monkeypatch, query, table, batch_bytes, parts=12):
    """Micro-batches of a query over a table in many files; its result must equal its SQL."""
    rows = pq.read_table(f"{sf}/{table}.parquet")
    for k in range(parts):
        a, b = (len(rows) * x // parts for x in (k, k + 1))
        put(tmp_path / f"{table}.parquet", k, rows.slice(a, b - a))
    monkeypatch.setattr(streams, "scratch_path", lambda *_: f"file://{tmp_path}/out")
    if batch_bytes:
        monkeypatch.setattr(streams, "BATCH_BYTES", batch_bytes)
    got: pd.DataFrame = streams.QUERIES[query](spark, str(tmp_path)).toPandas()
    db = duckdb.connect()
    db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    assert canon(got) == canon(db.sql(streams.ORACLE[query]).df())
    return len(list((tmp_path / "out/rows").glob("batch=*")))


@pytest.mark.parametrize("query, table", [("stream_groups", "files"), ("stream_tumbling", "sci_xfi")])
def test_small_files_share_a_batch(spark, sf, tmp_path, monkeypatch, query, table):
    assert over_folder(spark, sf, tmp_path, monkeypatch, query, table, None) <= 2  # one of data, one of the watermark


@pytest.mark.parametrize("query, table", [("stream_groups", "files"), ("stream_tumbling", "sci_xfi")])
def test_many_batches(spark, sf, tmp_path, monkeypatch, query, table):
    assert over_folder(spark, sf, tmp_path, monkeypatch, query, table, 1) >= 12
