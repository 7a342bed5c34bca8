"""Tile-compressed FITS images (FITS standard 4.0, section 10): GZIP_1, GZIP_2 and RICE_1, integers and quantised floats.

The image is cut into tiles, each compressed by itself into the heap of a binary
table, so a reader needs no more than the tiles it wants.  Floats may be stored as
they are, or as integers with a scale and zero a tile, undithered or with the
standard's subtractive dither.
"""

from __future__ import annotations

import gzip
import re
import struct
from functools import lru_cache

import numpy as np

TYPES = {8: ">u1", 16: ">i2", 32: ">i4", 64: ">i8", -32: ">f4", -64: ">f8"}
# Fixed values of the standard: bits that hold a block's parameter, by bytes a pixel; integers that stand for no value and for zero.
RICE = {1: (3, 6), 2: (4, 14), 4: (5, 25)}
NO_VALUE, ZERO = -2147483647, -2147483646


@lru_cache(1)
def dither() -> np.ndarray:
    """The standard's 10,000 random numbers, by its own generator."""
    out, seed = np.empty(10_000), 1
    for i in range(10_000):
        seed = 16807 * seed % 2147483647
        out[i] = seed / 2147483647
    return out


def rice_decode(data: bytes, n: int, size: int = 4, block: int = 32) -> np.ndarray:
    """``n`` integers of ``size`` bytes: differences, zigzag mapped, in blocks of one split each."""
    wide, most = RICE[size]
    bits = np.unpackbits(np.frombuffer(data, np.uint8))
    ones = np.flatnonzero(bits)
    weight = 1 << np.arange(8 * size - 1, -1, -1, dtype=np.int64)
    first = int(bits[: 8 * size] @ weight)
    at, mapped = 8 * size, np.zeros(n, np.int64)
    for b in range(0, n, block):
        m = min(block, n - b)
        split = int(bits[at : at + wide] @ (1 << np.arange(wide - 1, -1, -1))) - 1
        at += wide
        if split < 0:
            continue
        if split == most:
            mapped[b : b + m] = bits[at : at + 8 * size * m].reshape(m, -1) @ weight
            at += 8 * size * m
            continue
        low, k, tails, high = weight[len(weight) - split :], int(np.searchsorted(ones, at)), np.empty(m, np.int64), np.empty(m, np.int64)
        for i in range(m):  # a unary number ends with the next set bit
            while ones[k] < at:
                k += 1
            stop = int(ones[k])
            high[i], tails[i] = stop - at, stop + 1
            at = stop + 1 + split
        mapped[b : b + m] = (high << split) + (bits[tails[:, None] + np.arange(split)] @ low if split else 0)
    steps = np.where(mapped & 1, -(mapped >> 1) - 1, mapped >> 1)
    steps[0] += first
    total = np.cumsum(steps) & ((1 << 8 * size) - 1)
    return total if size == 1 else np.where(total >> (8 * size - 1), total - (1 << 8 * size), total)


def rice_encode(values: np.ndarray, size: int = 4, block: int = 32) -> bytes:
    wide, most = RICE[size]
    v = np.asarray(values, np.int64)
    steps = np.diff(v, prepend=v[:1])
    half = 1 << (8 * size - 1)
    steps = (steps + half) % (2 * half) - half
    mapped = np.where(steps < 0, -2 * steps - 1, 2 * steps)
    out = [np.binary_repr(int(v[0]) % (2 * half), 8 * size)]
    for b in range(0, len(v), block):
        m = mapped[b : b + block]
        if not m.any():
            out.append("0" * wide)
            continue
        split = max(0, int(m.sum() // len(m)).bit_length() - 1)
        if split >= most:
            out += [np.binary_repr(most + 1, wide), *[np.binary_repr(int(x), 8 * size) for x in m]]
            continue
        out.append(np.binary_repr(split + 1, wide))
        for x in m.tolist():
            out.append("0" * (x >> split) + "1" + (np.binary_repr(x & ((1 << split) - 1), split) if split else ""))
    text = "".join(out)
    return np.packbits(np.frombuffer(text.encode(), np.uint8) - 48).tobytes()


def _columns(h: dict[str, str]) -> dict[str, tuple[int, str]]:
    """(offset, format) of each column by name."""
    out, at = {}, 0
    for k in range(1, int(h["TFIELDS"]) + 1):
        form = re.fullmatch(r"(\d*)([A-Z])(.*)", h[f"TFORM{k}"])
        out[h.get(f"TTYPE{k}", "").upper()] = (at, form[2])
        at += int(form[1] or 1) * {"P": 8, "Q": 16, "D": 8, "E": 4, "J": 4, "I": 2, "B": 1, "A": 1, "L": 1, "K": 8}[form[2]]
    return out


def image(h: dict[str, str], raw: bytes) -> np.ndarray:
    """The image that a table with ZIMAGE holds."""
    shape = [int(h[f"ZNAXIS{k}"]) for k in range(int(h["ZNAXIS"]), 0, -1)]
    tile = [int(h.get(f"ZTILE{k}", h["ZNAXIS1"] if k == 1 else 1)) for k in range(int(h["ZNAXIS"]), 0, -1)]
    if len(shape) != 2:
        raise ValueError(f"{len(shape)} axes")
    width, rows, bitpix, kind = int(h["NAXIS1"]), int(h["NAXIS2"]), int(h["ZBITPIX"]), h["ZCMPTYPE"]
    heap, columns = int(h.get("THEAP", width * rows)), _columns(h)
    option = {h[f"ZNAME{k}"]: int(h[f"ZVAL{k}"]) for k in range(1, 9) if f"ZNAME{k}" in h and h[f"ZVAL{k}"].lstrip("-").isdigit()}

    def number(row: int, name: str):
        at, form = columns[name]
        return struct.unpack_from({"D": ">d", "E": ">f", "J": ">i"}[form], raw, row * width + at)[0]

    def part(row: int, name: str) -> bytes:
        if name not in columns:
            return b""
        at, form = columns[name]
        n, off = struct.unpack_from(">ii" if form == "P" else ">qq", raw, row * width + at)
        return raw[heap + off : heap + off + n * 1]

    out = np.empty(shape, np.float64 if bitpix == -64 else np.float32)
    across = -(-shape[1] // tile[1])
    for row in range(rows):
        y, x = row // across * tile[0], row % across * tile[1]
        own = out[y : y + tile[0], x : x + tile[1]]
        quantised = bitpix < 0 and "ZSCALE" in columns and part(row, "COMPRESSED_DATA") != b""
        if not (data := part(row, "COMPRESSED_DATA")):  # a tile that couldn't be quantised
            got = np.frombuffer(gzip.decompress(part(row, "GZIP_COMPRESSED_DATA")), TYPES[bitpix])
        elif kind in ("RICE_1", "RICE_ONE"):
            got = rice_decode(data, own.size, option.get("BYTEPIX", 4), option.get("BLOCKSIZE", 32))
        elif kind in ("GZIP_1", "GZIP_2"):
            plain, code = gzip.decompress(data), ">i4" if quantised else TYPES[bitpix]
            if kind == "GZIP_2":  # the bytes of one significance stand together
                plain = np.frombuffer(plain, np.uint8).reshape(np.dtype(code).itemsize, -1).T.tobytes()
            got = np.frombuffer(plain, code)
        else:
            raise ValueError(f"compression {kind}")
        got = got.astype(np.float64).reshape(own.shape)
        if quantised:
            scale, zero, method = number(row, "ZSCALE"), number(row, "ZZERO"), h.get("ZQUANTIZ", "NO_DITHER")
            value = got * scale + zero
            if method.startswith("SUBTRACTIVE"):
                r, start = dither(), (row + int(h.get("ZDITHER0", 1)) - 1) % 10_000
                first = int(r[start] * 500)
                noise = np.empty(own.size)
                for i in range(0, own.size):
                    if first == 10_000:
                        start = (start + 1) % 10_000
                        first = int(r[start] * 500)
                    noise[i] = r[first]
                    first += 1
                value = (got - noise.reshape(own.shape) + 0.5) * scale + zero
                if method.endswith("2"):
                    value = np.where(got == ZERO, 0.0, value)
            own[...] = np.where(got == int(h.get("ZBLANK", NO_VALUE)), np.nan, value)
        else:
            own[...] = got * float(h.get("BSCALE", 1)) + float(h.get("BZERO", 0))
    return out.astype(np.float32)


def table(data: np.ndarray, kind: str = "GZIP_2") -> tuple[dict, bytes]:
    """(cards, data) of a binary table that holds the image, a tile a row; without loss."""
    ny, nx = data.shape
    floats = data.dtype.kind == "f"
    code, bitpix = (">f4", -32) if floats else (">i4", 32)
    heap, rows = [], []
    at = 0
    for row in data.astype(code):
        if kind == "RICE_1":
            if floats:
                raise ValueError("RICE_1 holds integers")
            part = rice_encode(row)
        else:
            plain = row.tobytes() if kind == "GZIP_1" else np.frombuffer(row.tobytes(), np.uint8).reshape(-1, 4).T.tobytes()
            part = gzip.compress(plain, mtime=0)
        rows.append(struct.pack(">ii", len(part), at))
        heap.append(part)
        at += len(part)
    cards = {
        "BITPIX": 8, "NAXIS": 2, "NAXIS1": 8, "NAXIS2": ny, "PCOUNT": at, "GCOUNT": 1, "TFIELDS": 1, "TTYPE1": "COMPRESSED_DATA", "TFORM1": f"1PB({max(map(len, heap), default=0)})",
        "ZIMAGE": True, "ZCMPTYPE": kind, "ZBITPIX": bitpix, "ZNAXIS": 2, "ZNAXIS1": nx, "ZNAXIS2": ny, "ZTILE1": nx, "ZTILE2": 1,
    }
    if kind == "RICE_1":
        cards |= {"ZNAME1": "BLOCKSIZE", "ZVAL1": 32, "ZNAME2": "BYTEPIX", "ZVAL2": 4}
    return cards, b"".join(rows) + b"".join(heap)
