"""FITS images as a Spark data source, and a writer; plain and tile-compressed.

``spark.dataSource.register(FitsSource)``, then
``spark.read.format("fits").schema("name string, data array<float>").load(folder)``.

One row a file: name, header (map), ny, nx, data and unc (arrays, row by row,
missing pixels NaN), error (null if the file could be read).  Folders are opened
through pyarrow's file systems (file, hdfs, s3, gs).  Files are divided among
partitions by count; a file that can't be read gives a row with its error, so that a
share of faults can be tolerated and counted.  Of a stated schema only its columns
are read: without data and unc no pixels are, without unc no uncertainty.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
from pyarrow import fs as arrow_fs
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from obsforge.operators.bloomstore import open_fs
from obsforge.sources import tiled
from obsforge.sources.tiled import TYPES

BLOCK = 2880
SCHEMA = "name string, header map<string,string>, ny int, nx int, data array<float>, unc array<float>, provenance array<string>, error string"


def read_header(f) -> dict[str, str]:
    """Cards up to END, as text; quotes and comments taken off; {} at the end of the file."""
    out: dict[str, str] = {}
    while True:
        block = f.read(BLOCK)
        if not block:
            return out
        if len(block) < BLOCK:
            raise ValueError("header broken off")
        for i in range(0, BLOCK, 80):
            card = block[i : i + 80].decode("ascii", "replace")
            key = card[:8].strip()
            if key == "END":
                return out
            if card[8:10] == "= ":
                value = card[10:].strip()
                if value.startswith("'"):
                    end = value.find("'", 1)
                    while end >= 0 and value[end : end + 2] == "''":
                        end = value.find("'", end + 2)
                    out[key] = value[1:end].replace("''", "'").rstrip()
                else:
                    out[key] = value.split("/")[0].strip()


def payload(header: dict[str, str]) -> int:
    n = int(header.get("NAXIS", 0))
    size = int(np.prod([int(header[f"NAXIS{i + 1}"]) for i in range(n)], dtype=np.int64)) if n else 0
    return size * abs(int(header.get("BITPIX", 8))) // 8 + int(header.get("PCOUNT", 0))


def units(path: str, pixels: bool = True) -> Iterator[tuple[dict[str, str], bytes | None]]:
    store, place = open_fs(path)
    with store.open_input_file(place) as f:
        while header := read_header(f):
            size = payload(header)
            if pixels:
                data = f.read(size)
                if len(data) < size:
                    raise ValueError("data broken off")
                f.seek(-size % BLOCK, os.SEEK_CUR)
                yield header, data
            else:
                f.seek(size + -size % BLOCK, os.SEEK_CUR)
                yield header, None


def image(header: dict[str, str], data: bytes) -> np.ndarray:
    a = np.frombuffer(data, TYPES[int(header["BITPIX"])]).astype(np.float32)
    return a * float(header.get("BSCALE", 1)) + float(header.get("BZERO", 0))


def read_file(path: str, uncertainty: bool = True, pixels: bool = True) -> tuple:
    name = os.path.basename(path)
    try:
        header, data, unc, source = {}, None, None, None
        for h, raw in units(path, pixels):
            kind = h.get("EXTNAME", "").upper()
            packed = h.get("ZIMAGE") == "T"
            header = {**h, **header} if not header or kind != "UNCERTAINTY" else header
            if packed and kind != "UNCERTAINTY":
                header |= {"BITPIX": h["ZBITPIX"], "NAXIS1": h["ZNAXIS1"], "NAXIS2": h["ZNAXIS2"]}
            if raw is None or h.get("NAXIS", "0") == "0":
                continue
            if packed:
                if data is None and kind != "UNCERTAINTY":
                    data = tiled.image(h, raw).ravel()
                elif unc is None and uncertainty:
                    unc = tiled.image(h, raw).ravel()
            elif h.get("XTENSION", "").startswith("BINTABLE"):
                width = int(h["NAXIS1"])
                source = [raw[i : i + width].decode("ascii", "replace").strip("\0 ") for i in range(0, len(raw), width)]
            elif data is None:
                header, data = {**header, **h}, image(h, raw)
            elif unc is None and uncertainty:
                unc = image(h, raw)
        if not header:
            raise ValueError("no header")
        return name, header, int(header.get("NAXIS2", 0)), int(header.get("NAXIS1", 0)), None if data is None else data.tolist(), None if unc is None else unc.tolist(), source, None
    except Exception as e:  # noqa: BLE001 - any broken file becomes an error row
        return name, {}, None, None, None, None, None, f"{type(e).__name__}: {e}"


def _card(key: str, value) -> bytes:
    if isinstance(value, bool):
        text = f"{'T' if value else 'F':>20}"
    elif isinstance(value, (int, float)):
        text = f"{value!r:>20}"
    else:
        text = "'" + str(value).replace("'", "''").ljust(8) + "'"
    return f"{key:<8}= {text}"[:80].ljust(80).encode("ascii")


def _unit(cards: list[bytes], data: bytes) -> bytes:
    head = b"".join([*cards, b"END".ljust(80)])
    return head + b" " * (-len(head) % BLOCK) + data + b"\0" * (-len(data) % BLOCK)


def _image_unit(name: str, data: np.ndarray, header: dict, compression: str | None) -> bytes:
    if compression:
        cards, raw = tiled.table(data, compression)
        return _unit([_card("XTENSION", "BINTABLE"), *[_card(k, v) for k, v in cards.items()], _card("EXTNAME", name), *[_card(k, v) for k, v in header.items()]], raw)
    ny, nx = data.shape
    shape = [_card("BITPIX", -32), _card("NAXIS", 2), _card("NAXIS1", nx), _card("NAXIS2", ny), _card("PCOUNT", 0), _card("GCOUNT", 1)]
    return _unit([_card("XTENSION", "IMAGE"), *shape, _card("EXTNAME", name), *[_card(k, v) for k, v in header.items()]], data.astype(">f4").tobytes())


def write_file(path: str, data: np.ndarray, unc: np.ndarray | None = None, header: dict | None = None, provenance: list[str] | None = None, compression: str | None = None) -> None:
    """An empty primary unit, the image, its uncertainty, and a table of input names; written aside and renamed.

    ``compression`` GZIP_1 or GZIP_2 (floats, integers) or RICE_1 (integers) makes the images tile-compressed.
    """
    out = _unit([_card("SIMPLE", True), _card("BITPIX", 8), _card("NAXIS", 0)], b"")
    out += _image_unit("DATA", data, header or {}, compression)
    if unc is not None:
        out += _image_unit("UNCERTAINTY", unc, {}, "GZIP_2" if compression == "RICE_1" and unc.dtype.kind == "f" else compression)
    if provenance:
        cards = [_card("XTENSION", "BINTABLE"), _card("BITPIX", 8), _card("NAXIS", 2), _card("NAXIS1", 40), _card("NAXIS2", len(provenance)), _card("PCOUNT", 0), _card("GCOUNT", 1), _card("TFIELDS", 1), _card("TFORM1", "40A"), _card("TTYPE1", "provenance")]
        out += _unit(cards, b"".join(p.encode("ascii", "replace")[:40].ljust(40) for p in provenance))
    store, place = open_fs(path)
    with store.open_output_stream(place + ".part") as f:
        f.write(out)
    store.move(place + ".part", place)


def write_images(df, folder: str, compression: str | None = "GZIP_2"):
    """Write each row of (name, ny, nx, data[, unc, header, provenance]) as a file, in the tasks that hold the rows; gives (name, bytes)."""
    import pandas as pd

    store, place = open_fs(folder)
    store.create_dir(place, recursive=True)

    def put(batches):
        for pdf in batches:
            done = []
            for r in pdf.to_dict("records"):
                grid = lambda v, r=r: None if v is None else np.asarray(v, np.float32).reshape(int(r["ny"]), int(r["nx"]))
                where = f"{folder.rstrip('/')}/{r['name']}"
                write_file(where, grid(r["data"]), grid(r.get("unc")), dict(r.get("header") or {}), None if r.get("provenance") is None else list(r["provenance"]), compression)
                s, p = open_fs(where)
                done.append((r["name"], s.get_file_info(p).size))
            yield pd.DataFrame(done, columns=["name", "bytes"])

    return df.mapInPandas(put, "name string, bytes long")


class Files(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


class FitsReader(DataSourceReader):
    def __init__(self, options: dict, columns: list[str]):
        self.folder, self.columns = options["path"], columns
        self.uncertainty = "unc" in columns and options.get("uncertainty", "true") != "false"
        self.pixels = bool({"data", "unc", "provenance"} & set(columns)) and options.get("pixels", "true") != "false"
        self.per_partition = int(options.get("filesperpartition", 16))

    def partitions(self) -> list[InputPartition]:
        store, place = open_fs(self.folder)
        head = self.folder.split("://")[0] + "://" if "://" in self.folder else ""
        paths = sorted(head + i.path for i in store.get_file_info(arrow_fs.FileSelector(place, recursive=True)) if i.path.endswith(".fits"))
        return [Files(paths[i : i + self.per_partition]) for i in range(0, len(paths), self.per_partition)] or [Files([])]

    def read(self, partition: Files) -> Iterator[tuple]:
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        for p in partition.paths:
            row = dict(zip(names, read_file(p, self.uncertainty, self.pixels)))
            yield tuple(row[c] for c in self.columns)


class FitsSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "fits"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return FitsReader(self.options, schema.fieldNames())
