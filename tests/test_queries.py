"""Every query is registered once and has its columns named; a sample is held against its SQL."""

import duckdb
import pytest

import __spark_entry__ as entry
from compare import canon
from obsforge.plans import registry

SAMPLE = [
    "ready_files_filter", "filter_dsl_lists", "revivable_chain", "status_cards", "parents_without_child", "gap_filled_hours", "natural_key_twins", "asof_versioned", "bracket_pair", "nearest_two",
    "interval_overlap", "polarizer_triplets", "cycle_groups", "anchored_groups", "admit_prefix", "merged_replays", "merge_inverse_variance", "image_statistics", "spike_votes", "deficient_filled_median",
    "lagged_correlation", "revive_cascade", "p1_found", "p2_found", "p6_found", "p7_found",
    "p2_descendants", "p2_loops", "p4_found", "p6_partial", "p6_full", "complete_triplets", "rolling_mean", "last_valid_reading", "cache_eviction", "fits_compressed", "packet_archive", "mask_archive", "csv_archive",
    "spike_areas", "despiked_filled", "destreaked_exposure", "stray_light_by_roll", "slerp_quarters", "shift_aligned", "level1_quick_ready",
]


def test_names():
    q, sql = entry.queries(), entry.oracle_sql()
    assert len(q) > 120 and set(sql) <= set(q)
    assert {f"p{n}_found" for n in (1, 2, 4, 5, 6, 7)} <= set(registry.queries())


@pytest.fixture(scope="module")
def db(sf):
    from pathlib import Path

    c = duckdb.connect()
    for p in Path(sf).glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


@pytest.mark.parametrize("name", SAMPLE)
def test_against_sql(spark, sf, db, name):
    df = registry.queries()[name](spark, sf)
    assert len(set(df.columns)) == len(df.columns)
    assert canon(df.toPandas()) == canon(db.sql(registry.oracle_sql()[name]).df())


def test_entry(spark):
    assert entry.entry(spark).columns == ["observatory", "span_kind", "beg_us", "end_us"]


def test_stream(spark, sf, db):
    got = registry.queries()["stream_intervals"](spark, sf)
    assert canon(got.toPandas()) == canon(db.sql(registry.oracle_sql()["stream_intervals"]).df())
