import datetime as dt
from zoneinfo import ZoneInfo

import numpy as np
import pandas as pd
import pytest

from obsforge.operators import timestamps as ts
from obsforge.operators import zones


def us(*a, zone="UTC", micro=0):
    return int(dt.datetime(*a, tzinfo=ZoneInfo(zone)).timestamp()) * 1_000_000 + micro


CASES = {
    "2025-10-04T01:52:00.448Z": us(2025, 10, 4, 1, 52, 0, micro=448000),
    "  2025-10-05t09:13:32.729z ": us(2025, 10, 5, 9, 13, 32, micro=729000),
    "2025-10-04 06:12:56.123456789": us(2025, 10, 4, 6, 12, 56, micro=123456),
    "20251004061812": us(2025, 10, 4, 6, 18, 12),
    "2025-10-03 23:29:12.5 MDT": us(2025, 10, 4, 5, 29, 12, micro=500000),
    "2025-10-04T11:47:14.803+10:00": us(2025, 10, 4, 1, 47, 14, micro=803000),
    "2025-10-04T12:12:46.729+02": us(2025, 10, 4, 10, 12, 46, micro=729000),
    "2025-10-04T08:01:19-0600": us(2025, 10, 4, 14, 1, 19),
    "10/05/2025 11:29:17 AM CEST": us(2025, 10, 5, 9, 29, 17),
    "10/04/2025 12:13:39 AM UTC": us(2025, 10, 4, 0, 13, 39),
    "10/04/2025 12:13:39 PM UTC": us(2025, 10, 4, 12, 13, 39),
    "04.10.2025 04:36:44,225601": us(2025, 10, 4, 4, 36, 44, micro=225601),
    "04.10.2025 04:07:43,004 CEST": us(2025, 10, 4, 2, 7, 43, micro=4000),
    "2025-10-05 06:02:09.908201 Europe/Berlin": us(2025, 10, 5, 4, 2, 9, micro=908201),
    "2025-10-04T20:34:22[Australia/Sydney]": us(2025, 10, 4, 10, 34, 22),
    "Tue, 07 Oct 2025 03:36:03 +1100": us(2025, 10, 6, 16, 36, 3),
    "Sat, 04 Oct 2025 23:54:49 GMT": us(2025, 10, 4, 23, 54, 49),
    "2025/277-13:01:09.299Z": us(2025, 10, 4, 13, 1, 9, micro=299000),
    "2025-277T23:17:34.458": us(2025, 10, 4, 23, 17, 34, micro=458000),
    "1759851320": 1759851320000000,
    "1759662106.903": 1759662106903000,
    "1759550113965": 1759550113965000,
    "1761434794000000": 1761434794000000,
    "2025-10-06T11:34Z": us(2025, 10, 6, 11, 34),
    "2025-10-26 02:30:00 CET": us(2025, 10, 26, 1, 30),
    "2025-10-26 02:30:00 CEST": us(2025, 10, 26, 0, 30),
    "2024-02-29 00:00:00": us(2024, 2, 29),
    "2024-366T00:00:00Z": us(2024, 12, 31),
    "2025-10-26T02:30:00+02:00[Europe/Berlin]": us(2025, 10, 26, 0, 30),
    "Sun, 30 June 2024 10:00:00 GMT": us(2024, 6, 30, 10),
    "Sunday, 30 Jun 2024 10:00:00 GMT": us(2024, 6, 30, 10),
    "10/05/2025 11:29:17 UT": us(2025, 10, 5, 11, 29, 17),
    "1969-07-20 12:00:00 America/New_York": us(1969, 7, 20, 16),
    "2150-07-01 12:00:00 America/New_York": us(2150, 7, 1, 16),
    "2024-01-01 10:00:00." + "123456789" * 8: us(2024, 1, 1, 10, micro=123456),
    "2024-01-01 10:00:00Z Europe/London": us(2024, 1, 1, 10),
    # Not one instant:
    "2025-10-26 02:30:00 Europe/Berlin": None,  # twice
    "2026-03-29 02:30:00 Europe/Berlin": None,  # never
    "2026-03-08 02:24:52 America/Denver": None,
    "2025-10-05 02:30:00 Australia/Sydney": None,
    "2025-10-26T02:30:00+05:00[Europe/Berlin]": None,
    "2025-02-30T00:37:42Z": None,
    "2025-10-04T27:44:58": None,
    "0000-00-00 00:00:00": None,
    "2025-366T00:00:00Z": None,
    "2025-10-04T10:00:60Z": None,
    "Mon, 07 Oct 2025 03:36:03 +1100": None,
    "13/01/2025 10:00:00 AM UTC": None,
    "01/02/2025 13:00:00 PM UTC": None,
    "2025-10-04 10:00:00 XYZ": None,
    "2025-10-04X10:00:00": None,
    "2025-10-04 10:00:00X": None,
    "10/05/2025 11:29:17 XX": None,
    "10/05/2025 11:29:17 UT CET": None,
    "2024-01-01 10:00:00 tomorrow": None,
    "5 Sep 2025 01:02:03 unknown": None,
    "2025-10-04 10:00:00 Mars/Olympus": None,
    "": None, "   ": None, "-": None, "TBD": None, "N/A": None, "unknown": None, "x" * 100_000: None,
}


@pytest.mark.parametrize("text", CASES)
def test_one_by_one(text):
    got = ts.normalise(pd.Series([text]))[0]
    assert (None if got is pd.NA else got) == CASES[text]


def test_all_together(spark):
    df = spark.createDataFrame([(i, t, None, "m") for i, t in enumerate([*CASES, None])] + [(None, "2025-10-05", None, "m")], "file_id long, date_created string, date_obs string, mask string")
    fields = ["date_created", "date_obs"]
    got = {(r.id, r.field_name): r.utc_us for r in ts.instants(df, "file_id", fields).collect()}
    assert got == {(i, "date_created"): v for i, v in enumerate(CASES.values()) if v is not None}
    assert ts.instants(df.limit(0), "file_id", fields).count() == 0 == ts.rejected(df.limit(0), fields).count()
    assert {r.text for r in ts.rejected(df, fields).collect()} == {t for t, v in CASES.items() if v is None}


@pytest.mark.parametrize("zone", ["Europe/Berlin", "America/Denver", "Australia/Sydney", "Asia/Kolkata", "Australia/Lord_Howe", "Pacific/Apia"])
def test_transition_tables(zone):
    rng = np.random.default_rng(5)
    utc = rng.integers(0, 2_500_000_000, 400)
    at, _ = zones.transitions(zone)
    utc = np.concatenate([utc, *(at[1:] + k for k in (-3601, -1800, -1, 0, 1, 1800, 3600))])
    utc = utc[(utc > 0) & (utc < 4_000_000_000)]
    z = ZoneInfo(zone)
    local = np.array([u + int(dt.datetime.fromtimestamp(int(u), dt.timezone.utc).astimezone(z).utcoffset().total_seconds()) for u in utc])
    got, one = zones.to_utc(local, zone)
    for u, loc, g, ok in zip(utc, local, got, one):
        naive = dt.datetime(1970, 1, 1) + dt.timedelta(seconds=int(loc))
        both = {naive.replace(tzinfo=z, fold=f).utcoffset() for f in (0, 1)}
        assert ok == (len(both) == 1), (zone, naive)
        assert not ok or g == u


def test_no_text_depends_on_those_beside_it():
    texts = [*CASES, "2025-10-05 01:02:03 unknown", "2025-10-05 01:02:03 UTC", "2025-10-05 01:02:03 CET", "5 sept 2025 01:02:03", "5 sep 2025 01:02:03"]
    alone = [ts.normalise(pd.Series([t]))[0] for t in texts]
    assert alone[-4:] == [us(2025, 10, 5, 1, 2, 3), us(2025, 10, 5, 0, 2, 3), us(2025, 9, 5, 1, 2, 3), us(2025, 9, 5, 1, 2, 3)] and alone[-5] is pd.NA
    rng = np.random.default_rng(1)
    for _ in range(20):
        p = rng.permutation(len(texts))
        got = ts.normalise(pd.Series([texts[i] for i in p]))
        assert [x is pd.NA and alone[i] is pd.NA or x == alone[i] for x, i in zip(got, p)].count(False) == 0


def test_no_mask_fits_two_shapes():
    for t in CASES:
        mask = "".join("9" if c.isdigit() else "a" if c.isalpha() else c for c in " ".join(t.lower().split()))
        assert sum(rx.match(mask) is not None for rx in ts.COMPILED.values()) <= 1, t


def test_many_texts_of_all_years_against_the_library():
    rng = np.random.default_rng(9)
    names = ["Europe/Berlin", "America/New_York", "Australia/Sydney", "Africa/Casablanca", "Europe/Dublin", "America/Nuuk", "Asia/Kathmandu", "Pacific/Apia", "America/Sao_Paulo", "Asia/Gaza", "Antarctica/Troll"]
    texts, want = [], []
    for _ in range(50_000):
        zone = ZoneInfo(str(rng.choice(names)))
        naive = dt.datetime(1900, 1, 1) + dt.timedelta(seconds=int(rng.integers(0, 301 * 365.2425 * 86400)), microseconds=int(rng.integers(0, 1_000_000)))
        form = rng.integers(0, 4)
        aware = [naive.replace(tzinfo=zone, fold=f) for f in (0, 1)]
        one = aware[0].utcoffset() == aware[1].utcoffset()
        texts.append((f"{naive.isoformat()}[{zone.key}]", f"{naive:%m/%d/%Y %I:%M:%S.%f %p} {zone.key}", f"{naive:%d.%m.%Y %H:%M:%S,%f} {zone.key}", f"{naive:%Y/%j-%H:%M:%S.%f} {zone.key}")[form])
        delta = naive - aware[0].utcoffset() - dt.datetime(1970, 1, 1)
        want.append((delta.days * 86400 + delta.seconds) * 1_000_000 + delta.microseconds if one else None)
    got = ts.normalise(pd.Series(texts))
    wrong = [(t, g, w) for t, g, w in zip(texts, got, want) if (g is pd.NA) != (w is None) or w is not None and g != w]
    assert not wrong, (len(wrong), wrong[:5])


def test_texts_of_any_length():
    got = ts.normalise(pd.Series(["2025-10-05T01:02:03." + "123456789" * 2000 + "Z", "2025-10-05 01:02:03" + " " * 50_000 + "CET", "2025-10-05 01:02:03" + " " * 50_000 + "?", "x" * 100_000]))
    assert got[:2].tolist() == [us(2025, 10, 5, 1, 2, 3, micro=123456), us(2025, 10, 5, 0, 2, 3)] and got[2:].isna().all()
