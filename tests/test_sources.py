import numpy as np
import pytest

from obsforge.sources import fits, packets


def test_fits_round_trip(spark, tmp_path):
    spark.dataSource.register(fits.FitsSource)
    rng = np.random.default_rng(1)
    kept = {}
    for i in range(5):
        data = rng.random((6, 4)).astype(np.float32)
        data[0, 0] = np.nan
        unc = np.where(rng.random((6, 4)) < 0.2, np.inf, 0.1).astype(np.float32)
        kept[f"a{i}.fits"] = (data, unc)
        fits.write_file(str(tmp_path / f"a{i}.fits"), data, unc, {"OBSCODE": i, "DATE-OBS": "2025-01-01T00:00:00", "NOTE": "it's"}, ["one.fits", "two.fits"])
    (tmp_path / "broken.fits").write_bytes(b"SIMPLE  = nonsense")
    (tmp_path / "cut.fits").write_bytes((tmp_path / "a0.fits").read_bytes()[:5800])
    rows = {r.name: r for r in spark.read.format("fits").option("filesPerPartition", "2").load(str(tmp_path)).collect()}
    assert len(rows) == 7 and rows["broken.fits"].error and rows["cut.fits"].error
    for name, (data, unc) in kept.items():
        r = rows[name]
        assert (r.ny, r.nx) == (6, 4) and r.error is None and r.header["NOTE"] == "it's" and r.provenance == ["one.fits", "two.fits"]
        np.testing.assert_array_equal(np.array(r.data, np.float32).reshape(6, 4), data)
        np.testing.assert_array_equal(np.array(r.unc, np.float32).reshape(6, 4), unc)
    heads = spark.read.format("fits").option("pixels", "false").load(str(tmp_path)).where("error IS NULL").collect()
    assert all(r.data is None and r.header["OBSCODE"] for r in heads)


def test_packets(spark, tmp_path):
    good = b"".join(packets.build(0x20, i, 800_000_000 + i, 32768, bytes([i] * (i + 1))) for i in range(4))
    (tmp_path / "a.tlm").write_bytes(good)
    (tmp_path / "b.tlm").write_bytes(good + b"\x08\x20\xc0\x01\x00\xff\x00")
    (tmp_path / "c.tlm").write_bytes(b"")
    got = packets.load_packets(spark, str(tmp_path)).collect()
    a = sorted((r for r in got if r.path.endswith("a.tlm")), key=lambda r: r.packet_index)
    assert [r.ccsds_sequence_count for r in a] == [0, 1, 2, 3] and [bytes(r.payload) for r in a] == [bytes([i] * (i + 1)) for i in range(4)]
    assert all(r.apid == 0x20 and r.error is None for r in a)
    assert a[1].us - a[0].us == 1_000_000 and a[0].us == (946_684_800 + 800_000_000 - 37) * 1_000_000 + 500_000
    assert [r.error for r in got if r.path.endswith("b.tlm") and r.error] == ["packet broken off"]
    assert not [r for r in got if r.path.endswith("c.tlm")]


@pytest.mark.parametrize("little", [True, False])
@pytest.mark.parametrize("width", [3, 12, 16, 19])
def test_bits(width, little):
    rng = np.random.default_rng(2)
    values = [int(v) for v in rng.integers(0, 1 << width, 8)]
    total = 0
    for i, v in enumerate(values):
        total |= v << (i * width if little else (7 - i) * width)
    assert packets.unpack_bits(total.to_bytes(width, "little" if little else "big"), width, little) == values


def test_mask():
    m = np.random.default_rng(3).random((4, 6)) < 0.5
    assert (packets.mask_pixels(np.packbits(m.T.ravel()).tobytes(), 4, 6) == m).all()


def test_new_files(spark):
    found = spark.createDataFrame([("a",), ("b",)], "path string")
    assert [r.path for r in packets.new_files(found, spark.createDataFrame([("a",), (None,)], "path string")).collect()] == ["b"]


def test_csv_budget_upsert_and_products(spark, tmp_path):
    from obsforge.sources import tables

    (tmp_path / "r.csv").write_text("start_time,start_block,replay_length\n2025-01-01 00:00:00.5,2048,5\nx,y,z\n")
    rows = tables.read_csv(spark, str(tmp_path / "r.csv"), "replays").cache()
    assert rows.count() == 2 and [r.start_block for r in rows.where("_bad IS NULL").collect()] == [2048]
    assert tables.within_budget(rows, "_bad", 0.6).count() == 1
    with pytest.raises(Exception, match="inputs failed"):
        tables.within_budget(rows, "_bad", 0.1).collect()
    t = spark.createDataFrame([(1, None, "a"), (1, 2, "b")], "k int, l int, v string")
    n = spark.createDataFrame([(1, None, "c"), (3, 3, "d")], "k int, l int, v string")
    assert sorted(r.v for r in tables.upsert(t, n, ["k", "l"]).collect()) == ["b", "c", "d"]
    f = spark.sql("SELECT '1' AS level, 'PM' AS file_type, '4' AS observatory, timestamp_ntz'2025-01-02 03:00:00' AS date_beg, 7 AS file_id")
    tables.write_products(f, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out")).where("day = date'2025-01-02' AND level = 1")
    assert back.count() == 1
    (tmp_path / "h.bin").write_bytes(b"abc")
    digest = tables.with_digest(spark.read.format("binaryFile").load(str(tmp_path / "h.bin"))).collect()[0].digest
    assert digest == "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad"


@pytest.mark.parametrize("kind", ["GZIP_1", "GZIP_2", "RICE_1"])
def test_compressed_images(spark, tmp_path, kind):
    spark.dataSource.register(fits.FitsSource)
    rng = np.random.default_rng(4)
    data = rng.integers(-70_000, 70_000, (7, 83)).astype(np.int32)
    data[2], data[3, :40] = 5, 2**31 - 1
    data[4] = rng.integers(-(2**31), 2**31 - 1, 83)
    if kind != "RICE_1":
        data = rng.random((7, 83)).astype(np.float32)
        data[1, 1] = np.nan
    unc = np.where(rng.random((7, 83)) < 0.2, np.inf, 0.1).astype(np.float32)
    fits.write_file(str(tmp_path / "a.fits"), data, unc, {"OBSCODE": 3}, ["one.fits"], kind)
    r = spark.read.format("fits").load(str(tmp_path)).collect()[0]
    assert r.error is None and (r.ny, r.nx) == (7, 83) and r.header["OBSCODE"] == "3" and r.provenance == ["one.fits"]
    np.testing.assert_array_equal(np.array(r.data, np.float32).reshape(7, 83), data.astype(np.float32))
    np.testing.assert_array_equal(np.array(r.unc, np.float32).reshape(7, 83), unc)
    few = spark.read.format("fits").schema("nx int, name string").load(f"file://{tmp_path}")
    assert few.columns == ["nx", "name"] and tuple(few.collect()[0]) == (83, "a.fits")


@pytest.mark.parametrize("size", [1, 2, 4])
def test_rice(size):
    from obsforge.sources import tiled

    rng = np.random.default_rng(6)
    low, high = (0, 255) if size == 1 else (-(1 << 8 * size - 1), (1 << 8 * size - 1) - 1)
    for spread in (0, 1, 3, 40, high):
        v = np.clip(rng.integers(-spread, spread + 1, 101) + (100 if size == 1 else 0), low, high)
        assert tiled.rice_decode(tiled.rice_encode(v, size), len(v), size).tolist() == v.tolist(), spread


def test_quantised_floats():
    from obsforge.sources import tiled

    v = np.array([[3, 7, tiled.NO_VALUE, 9], [1, 2, 3, 4]])
    import struct

    parts = [tiled.rice_encode(row) for row in v]
    rows, heap = b"", b""
    for p in parts:
        rows += struct.pack(">iidd", len(p), len(heap), 0.5, 10.0)
        heap += p
    h = {"NAXIS1": "24", "NAXIS2": "2", "TFIELDS": "3", "TFORM1": "1PB(20)", "TTYPE1": "COMPRESSED_DATA", "TFORM2": "1D", "TTYPE2": "ZSCALE", "TFORM3": "1D", "TTYPE3": "ZZERO", "ZBITPIX": "-32",
         "ZNAXIS": "2", "ZNAXIS1": "4", "ZNAXIS2": "2", "ZCMPTYPE": "RICE_1", "ZQUANTIZ": "NO_DITHER"}
    got = tiled.image(h, rows + heap)
    assert np.isnan(got[0, 2]) and got[0, [0, 1, 3]].tolist() == [11.5, 13.5, 14.5] and got[1].tolist() == [10.5, 11.0, 11.5, 12.0]
    moved = tiled.image({**h, "ZQUANTIZ": "SUBTRACTIVE_DITHER_1", "ZDITHER0": "1"}, rows + heap)
    assert (np.abs(moved - got)[~np.isnan(got)] <= 0.25).all() and (moved != got)[1].any()


def test_packet_dictionary(spark):
    from obsforge.sources.packets import build, decode_fields, packets as parsed

    body = (5 << 20 | 77 << 8 | 9).to_bytes(4, "big")  # 12, 12 and 8 bits
    content = build(0x20, 0, 1, 0, body + b"tail") + build(0x21, 1, 1, 0, b"\x01\x02") + build(0x20, 2, 1, 0, b"\x00") + build(0x30, 3, 1, 0, b"\x00")
    files = spark.createDataFrame([("f", bytearray(content)), ("g", None)], "path string, content binary")
    got = decode_fields(parsed(files), {0x20: [("a", 12), ("b", 12), ("c", 8)], 0x21: [("b", 16)]}, "rest").orderBy("packet_index").collect()
    assert [(r.a, r.b, r.c, r.error) for r in got] == [(5, 77, 9, None), (None, 258, None, None), (None, None, None, "payload broken off")]
    assert bytes(got[0].rest) == b"tail"
