"""Bloom filters per time bucket, kept as bounded files in the shared folder.

A time bucket with more rows than one filter holds is cut into equal slices of
time, and only if a slice can't be shorter, by ranges of the key's hash.  No filter
grows with the data, however many rows one bucket holds, and neighbours in time
lie in one filter.  Each filter has two bit planes: *seen* and *seen again*.  Small
buckets are packed into files of about ``file_bytes``; a filter of that size has its
own.  A reader whose rows are sorted by (cell, key hash) goes through the files in order.
"""

from __future__ import annotations

from collections import OrderedDict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs

HASHES = 4
BITS_PER_KEY = 16


def mix(key: np.ndarray, salt: np.ndarray) -> np.ndarray:
    """64-bit finaliser over (key, salt)."""
    with np.errstate(over="ignore"):
        z = key.astype(np.uint64) + salt.astype(np.int64).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def open_fs(uri: str):
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("/") else uri.replace("file:", "file://", 1))


@dataclass(frozen=True)
class Layout:
    """Where each filter lies; a function of the rows per bucket alone.

    All arrays have one entry per occupied time bucket: bounded by the calendar
    span over the bucket width, not by the rows.
    """

    buckets: np.ndarray  # sorted
    slices: np.ndarray
    shards: np.ndarray  # of each slice
    bits: np.ndarray  # of each filter, a power of two
    first: np.ndarray  # number of the bucket's first filter
    file: np.ndarray  # number of the bucket's first file
    packed: np.ndarray  # whether all its filters lie in that file
    bucket_us: int
    files: int

    @classmethod
    def of(cls, counts: list[tuple[int, int]], bucket_us: int, finest_us: int, keys_per_filter: int = 1 << 20, file_bytes: int = 8 << 20) -> Layout:
        counts = sorted(counts)
        b = np.array([c[0] for c in counts], dtype=np.int64)
        n = np.array([c[1] for c in counts], dtype=np.int64)
        filters = np.maximum(1, -(-n // keys_per_filter))
        slices = np.minimum(filters, max(1, bucket_us // finest_us))
        shards = -(-filters // slices)
        bits = 1 << np.ceil(np.log2(np.maximum(1024, n // (slices * shards) * BITS_PER_KEY))).astype(np.int64)
        number = slices * shards
        size = number * bits // 4
        packed = size <= file_bytes
        file = np.zeros(len(b), np.int64)
        at, held = -1, file_bytes + 1
        for i in range(len(b)):  # one step a bucket
            if packed[i]:
                if held + size[i] > file_bytes:
                    at, held = at + 1, 0
                file[i], held = at, held + size[i]
            else:
                file[i], at, held = at + 1, at + number[i], file_bytes + 1
        return cls(b, slices, shards, bits, np.cumsum(number) - number, file, packed, bucket_us, at + 1)

    def locate(self, at_us: np.ndarray, kh: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Filter number (−1: no such bucket), file and bits of each element's filter."""
        if not len(self.buckets):
            none = np.full(len(at_us), -1)
            return none, none, none
        bucket = at_us // self.bucket_us
        i = np.minimum(np.searchsorted(self.buckets, bucket), len(self.buckets) - 1)
        part = (at_us - bucket * self.bucket_us) * self.slices[i] // self.bucket_us
        own = part * self.shards[i] + ((((kh >> 32) + (1 << 31)) * self.shards[i]) >> 32)
        there = self.buckets[i] == bucket
        return np.where(there, self.first[i] + own, -1), np.where(self.packed[i], self.file[i], self.file[i] + own), self.bits[i]


def positions(h: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """(HASHES, n) bit positions by double hashing."""
    a, b = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    with np.errstate(over="ignore"):
        return np.stack([((a + np.uint64(k) * b) % bits.astype(np.uint64)).astype(np.int64) for k in range(HASHES)])


class Builder:
    """Collects elements of one task; gives one partial filter per filter touched.

    A part with few elements is given as their hashes, which are fewer bytes than the planes.
    """

    def __init__(self, layout: Layout, flush_at: int = 1 << 20):
        self.layout, self.flush_at, self.parts, self.n = layout, flush_at, [], 0

    def add(self, at_us: np.ndarray, kh: np.ndarray, h: np.ndarray):
        f, file, bits = self.layout.locate(at_us, kh)
        self.parts.append((f, file, h, bits))
        self.n += len(f)
        if self.n >= self.flush_at:
            yield from self.flush()

    def flush(self):
        """(file, filter, bits, hashes or none, planes or none)"""
        if not self.parts:
            return
        f, file, h, bits = (np.concatenate(x) for x in zip(*self.parts))
        self.parts, self.n = [], 0
        order = np.argsort(f, kind="stable")
        f, file, h, bits = f[order], file[order], h[order], bits[order]
        cuts = np.flatnonzero(np.diff(f)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, len(f)]):
            if hi > lo:
                few = 8 * (hi - lo) < bits[lo] // 4
                once, again = (None, None) if few else planes(h[lo:hi], int(bits[lo]))
                yield int(file[lo]), int(f[lo]), int(bits[lo]), h[lo:hi].tobytes() if few else None, once, again


class Gathered:
    """One filter from its parts."""

    def __init__(self, bits: int):
        self.bits, self.planes, self.waiting, self.n = bits, None, [], 0

    def add(self, hashes: bytes | None, once: bytes | None, again: bytes | None) -> None:
        if hashes is None:
            self._join((bytes(once), bytes(again)))
            return
        self.waiting.append(np.frombuffer(hashes, np.uint64))
        self.n += len(self.waiting[-1])
        if self.n > self.bits // 32:
            self._settle()

    def _join(self, got: tuple[bytes, bytes]) -> None:
        self.planes = merge(self.planes, got) if self.planes else got

    def _settle(self) -> None:
        if self.waiting:
            self._join(planes(np.concatenate(self.waiting), self.bits))
            self.waiting, self.n = [], 0

    def done(self) -> tuple[bytes, bytes]:
        self._settle()
        return self.planes


def planes(h: np.ndarray, bits: int) -> tuple[bytes, bytes]:
    p = positions(h, np.full(len(h), bits, dtype=np.int64))
    hits = np.zeros(bits, dtype=np.uint16)
    for row in p:
        np.add.at(hits, row, 1) if len(row) < 64 else _add(hits, row)
    return np.packbits(hits > 0).tobytes(), np.packbits(hits > 1).tobytes()


def _add(hits: np.ndarray, row: np.ndarray) -> None:
    hits[:] = np.minimum(hits.astype(np.int64) + np.bincount(row, minlength=len(hits)), 60000)


def merge(a: tuple[bytes, bytes], b: tuple[bytes, bytes]) -> tuple[bytes, bytes]:
    one, two, one2, two2 = (np.frombuffer(x, np.uint8) for x in (*a, *b))
    return (one | one2).tobytes(), (two | two2 | (one & one2)).tobytes()


class Reader:
    """Looks elements up; holds at most ``keep`` filter files."""

    def __init__(self, layout: Layout, uri: str, keep: int = 6):
        self.layout, self.keep, self.reads = layout, keep, 0
        self.store, self.base = open_fs(uri)
        self.held: OrderedDict[int, dict] = OrderedDict()

    def _file(self, f: int) -> dict:
        if f in self.held:
            self.held.move_to_end(f)
            return self.held[f]
        with self.store.open_input_file(f"{self.base}/f{f}.arrow") as src:
            t = pa.ipc.open_stream(src).read_all()
        self.reads += 1
        self.held[f] = dict(zip(t["filter"].to_pylist(), zip(t["once"].to_pylist(), t["again"].to_pylist())))
        if len(self.held) > self.keep:
            self.held.popitem(last=False)
        return self.held[f]

    def test(self, at_us: np.ndarray, kh: np.ndarray, h: np.ndarray, again: bool) -> np.ndarray:
        """Whether all bits of the element are set in the plane."""
        s, file, bits = self.layout.locate(at_us, kh)
        out = np.zeros(len(s), dtype=bool)
        order = np.argsort(s, kind="stable")
        order = order[s[order] >= 0]
        so = s[order]
        cuts = np.flatnonzero(np.diff(so)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, len(so)]):
            if hi <= lo:
                continue
            i = order[lo:hi]
            p = positions(h[i], bits[i])
            held = self._file(int(file[i[0]])).get(int(so[lo]))
            if held is not None:
                plane = np.frombuffer(held[1 if again else 0], np.uint8)
                out[i] = np.all((plane[p >> 3] >> (7 - (p & 7)).astype(np.uint8)) & 1, axis=0)
        return out
