"""CCSDS space packets: binary telemetry files to typed rows.

A packet has a primary header of 6 bytes (version, type, secondary header flag,
application id; sequence flags and count; length less one) and, if flagged, a
secondary header with a time: 4 bytes of TAI seconds since 2000 and 2 bytes of
1/65536 s.  Files come through ``spark.read.format("binaryFile")``; a broken file
gives the packets before the fault and one row that names it.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "path string, packet_index int, apid int, sequence_flags int, ccsds_sequence_count int, ccsds_packet_length int, us long, payload binary, error string"
EPOCH_US = 946_684_800_000_000
# TAI - UTC in whole seconds and the Unix second from which each holds.
LEAP_SECONDS = [(946_684_800, 32), (1_136_073_600, 33), (1_230_768_000, 34), (1_341_100_800, 35), (1_435_708_800, 36), (1_483_228_800, 37)]


def tai_to_utc_us(seconds: int, fraction: int) -> int:
    """Unix microseconds in UTC of TAI seconds and 1/65536 s since 2000-01-01 TAI."""
    us = EPOCH_US + seconds * 1_000_000 + fraction * 1_000_000 // 65536
    offset = next((o for t, o in reversed(LEAP_SECONDS) if us >= (t + o) * 1_000_000), LEAP_SECONDS[0][1])
    return us - offset * 1_000_000


def parse(data: bytes) -> Iterator[tuple]:
    at, index = 0, 0
    while at < len(data):
        if at + 6 > len(data):
            yield index, None, None, None, None, None, None, "primary header broken off"
            return
        word, seq, length = struct.unpack_from(">HHH", data, at)
        body = data[at + 6 : at + 7 + length]
        if len(body) < length + 1:
            yield index, word & 0x7FF, seq >> 14, seq & 0x3FFF, length, None, None, "packet broken off"
            return
        us, start = None, 0
        if word >> 11 & 1 and len(body) >= 6:
            us, start = tai_to_utc_us(*struct.unpack_from(">IH", body)), 6
        yield index, word & 0x7FF, seq >> 14, seq & 0x3FFF, length, us, bytes(body[start:]), None
        at, index = at + 7 + length, index + 1


def build(apid: int, count: int, seconds: int, fraction: int, payload: bytes) -> bytes:
    body = struct.pack(">IH", seconds, fraction) + payload
    return struct.pack(">HHH", 1 << 11 | apid, 3 << 14 | count & 0x3FFF, len(body) - 1) + body


def packets(files: DataFrame) -> DataFrame:
    """Rows of ``binaryFile`` (path, content) to packets."""

    def explode(batches):
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"]):
                rows = [(path, *p) for p in parse(bytes(content))] if content is not None else []
                yield pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")])

    return files.select("path", "content").mapInPandas(explode, SCHEMA)


def load_packets(spark: SparkSession, folder: str) -> DataFrame:
    return packets(spark.read.format("binaryFile").option("pathGlobFilter", "*.tlm").option("recursiveFileLookup", "true").load(folder))


def unpack_bits(data: bytes, width: int, little: bool = False) -> list[int]:
    """Numbers of ``width`` (at most 62) bits packed without padding, the first bits first (big) or the lowest bits first (little)."""
    n = len(data) * 8 // width
    bits = np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little" if little else "big")[: n * width].reshape(n, width).astype(np.int64)
    place = np.arange(width, dtype=np.int64)
    return (bits @ (1 << (place if little else place[::-1]))).tolist()


def decode_fields(rows: DataFrame, dictionary: dict[int, list[tuple[str, int]]], tail: str | None = None) -> DataFrame:
    """The payloads of parsed packets by a dictionary: per application id the (name, bits) of its fields, first bits first.

    Fields that an application does not have are null; what follows the fixed fields comes out as ``tail``.  A payload
    shorter than its fields keeps the row, its fields null and ``error`` set.  Packets of other applications are left out.
    """
    names = list(dict.fromkeys(n for fields in dictionary.values() for n, _ in fields))
    if clash := set(names) & {c.split()[0] for c in SCHEMA.split(", ")}:
        raise ValueError(f"fields named like a packet's own columns: {sorted(clash)}")
    schema = f"{SCHEMA}, {', '.join(f'{n} long' for n in names)}" + (f", {tail} binary" if tail else "")

    def read(batches):
        for pdf in batches:
            out = {n: [None] * len(pdf) for n in names}
            rest: list = [None] * len(pdf)
            errors = pdf["error"].tolist()
            for i, (apid, payload) in enumerate(zip(pdf["apid"], pdf["payload"])):
                if payload is None or apid not in dictionary:
                    continue
                total = sum(w for _, w in dictionary[apid])
                if len(payload) * 8 < total:
                    errors[i] = errors[i] or "payload broken off"
                    continue
                bits = np.unpackbits(np.frombuffer(payload, np.uint8), count=total).astype(np.int64)
                at = 0
                for n, w in dictionary[apid]:
                    out[n][i] = int(bits[at : at + w] @ (1 << np.arange(w - 1, -1, -1, dtype=np.int64)))
                    at += w
                rest[i] = bytes(payload[-(-total // 8) :])
            pdf = pdf.assign(error=errors, **{n: pd.array(v, "Int64") for n, v in out.items()})
            yield pdf.assign(**{tail: rest}) if tail else pdf

    return rows.where(F.col("apid").isin(*dictionary)).mapInPandas(read, schema)


def masks(rows: DataFrame, name: str, content: str, ny: int, nx: int) -> DataFrame:
    """(name, y, x) of each set pixel of packed masks, one a row."""

    def read(batches):
        for pdf in batches:
            parts = [(n, *np.nonzero(mask_pixels(bytes(c), ny, nx))) for n, c in zip(pdf[name], pdf[content]) if c is not None]
            yield pd.DataFrame({name: np.repeat([p[0] for p in parts], [len(p[1]) for p in parts]), "y": np.concatenate([p[1] for p in parts] or [[]]).astype(np.int32), "x": np.concatenate([p[2] for p in parts] or [[]]).astype(np.int32)})

    return rows.select(name, content).mapInPandas(read, f"{name} {rows.schema[name].dataType.simpleString()}, y int, x int")


def mask_pixels(data: bytes, ny: int, nx: int):
    """Packed bits of a mask stored column by column, as a boolean image."""
    return np.unpackbits(np.frombuffer(data, np.uint8), count=ny * nx).reshape(nx, ny).T.astype(bool)


def new_files(found: DataFrame, known: DataFrame, key: str = "path", since: str | None = None, date: str = "modificationTime") -> DataFrame:
    """Found files that aren't in the catalogue yet, optionally not older than a date."""
    fresh = found.join(known.select(key).distinct(), key, "left_anti")
    return fresh if since is None else fresh.where(F.col(date) >= F.lit(since).cast("timestamp"))
