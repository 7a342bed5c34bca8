"""Mixed timestamp formats and time zones to one UTC instant.

A text becomes its shape mask: digits turn to 9, letters to a, all else stays.  The
mask alone decides which parser reads a text and at which places its fields lie, so
each distinct mask is parsed once a worker, and the texts of one mask are converted
together: digits by place value, words through small dictionaries, local times
through zone transition tables of one stated version.  No text's result depends on
the texts beside it.

Defined cases: null, empty and blank texts and words denote no instant; runs of
white space and letter case play no part; texts without a zone are UTC; slashed
dates with the year last put the month first, dotted ones the day; digits finer
than a microsecond are cut; a weekday must fit its date; hours over 23, second 60,
days or months that do not exist denote none; a local time that its zone skips or
repeats denotes none, unless an offset or a zone abbreviation fixes it; an
abbreviation of unknown or disputed meaning denotes none; an offset and a zone
name that contradict each other denote none.  Texts may have any length.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsforge.operators import zones

# Zone abbreviations of one meaning, in minutes from UTC.
ABBREVIATIONS = {
    "utc": 0, "gmt": 0, "ut": 0, "z": 0, "wet": 0, "west": 60, "cet": 60, "cest": 120, "eet": 120, "eest": 180, "msk": 180,
    "jst": 540, "awst": 480, "acst": 570, "acdt": 630, "aest": 600, "aedt": 660, "nzst": 720, "nzdt": 780,
    "hst": -600, "akst": -540, "akdt": -480, "pst": -480, "pdt": -420, "mst": -420, "mdt": -360, "cdt": -300, "est": -300, "edt": -240,
}
MONTH_NAMES = "january february march april may june july august september october november december".split()
DAY_NAMES = "monday tuesday wednesday thursday friday saturday sunday".split()
MONTHS = {w: i + 1 for i, m in enumerate(MONTH_NAMES) for w in (m, m[:3])} | {"sept": 9}
DAYS = {w: i for i, d in enumerate(DAY_NAMES) for w in (d, d[:3])}

# The shapes, in the masks' alphabet, each with what its places mean.
TIME = r"(?P<h>99?):(?P<mi>99)(?::(?P<s>99)(?:[.,](?P<f>9+))?)?"
ZONE = r" ?(?P<z>a(?![a_/])|[+-]99(?::?99)?|a{2,5}(?![a_/])(?:[+-]99:?99)?)? ?(?P<iana>\[[a_+\-9/]+\]|[a_]+(?:/[a_+\-9]+)+)?"
SHAPES = {
    "ymd": rf"(?P<y>9999)(?P<sep>[-/.])(?P<mo>99?)(?P=sep)(?P<d>99?)(?:(?P<t>[a ]) ?{TIME}{ZONE})?",
    "ordinal": rf"(?P<y>9999)[-/](?P<doy>999)(?:(?P<t>[a -]){TIME}{ZONE})?",
    "mdy": rf"(?P<mo>99?)/(?P<d>99?)/(?P<y>9999)(?:,? {TIME}(?: ?(?P<ap>aa)(?![a_/]))?{ZONE})?",
    "dmy": rf"(?P<d>99?)\.(?P<mo>99?)\.(?P<y>9999)(?:,? {TIME}{ZONE})?",
    "mail": rf"(?:(?P<dow>a{{3,9}}),? )?(?P<d>99?)[ -](?P<mon>a{{3,9}})[ -](?P<y>9999) {TIME}{ZONE}",
    "compact": r"(?P<y>9999)(?P<mo>99)(?P<d>99)(?P<t>a)?(?P<h>99)(?P<mi>99)(?P<s>99)(?:[.,](?P<f>9+))?(?P<z>a|[+-]99(?::?99)?)?",
    "day": r"(?P<y>9999)(?P<mo>99)(?P<d>99)",
    "epoch_s": r"(?P<e>9{9,10})(?:[.,](?P<f>9+))?",
    "epoch_ms": r"(?P<e>9{13})",
    "epoch_us": r"(?P<e>9{16})",
}
COMPILED = {k: re.compile(rf"\A(?:{v})\Z", re.ASCII) for k, v in SHAPES.items()}
EPOCHS = {"epoch_s": 1_000_000, "epoch_ms": 1000, "epoch_us": 1}

_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[ord("0") : ord("9") + 1] = ord("9")
_CLASS[ord("a") : ord("z") + 1] = ord("a")


@lru_cache(20_000)
def parser(mask: str) -> tuple[str, dict[str, tuple[int, int]]] | None:
    """(shape, where each of its fields lies) of a mask, or none; no mask fits two shapes."""
    for kind, rx in COMPILED.items():
        if m := rx.match(mask):
            return kind, {k: m.span(k) for k in rx.groupindex if m.start(k) >= 0}
    return None


def days(y: np.ndarray, m: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Days since 1970-01-01 of proleptic Gregorian dates."""
    return ((y - 1970) * 12 + m - 1).astype("datetime64[M]").astype("datetime64[D]").astype(np.int64) + d - 1


class Fields:
    """The fields of texts of one mask, cut from the batch's bytes."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, where: dict[str, tuple[int, int]]):
        self.data, self.starts, self.where, self.n = data, starts, where, len(starts)

    def __contains__(self, name: str) -> bool:
        return name in self.where

    def _cut(self, name: str, most: int | None = None) -> np.ndarray:
        a, b = self.where[name]
        return self.data[self.starts[:, None] + np.arange(a, b if most is None else min(b, a + most))]

    def number(self, name: str, missing: int = 0) -> np.ndarray:
        if name not in self.where:
            return np.full(self.n, missing, np.int64)
        digits = self._cut(name).astype(np.int64) - 48
        return digits @ (10 ** np.arange(digits.shape[1] - 1, -1, -1, dtype=np.int64))

    def micros(self) -> np.ndarray:
        if "f" not in self.where:
            return np.zeros(self.n, np.int64)
        digits = self._cut("f", 6).astype(np.int64) - 48
        return digits @ (10 ** np.arange(5, 5 - digits.shape[1], -1, dtype=np.int64))

    def words(self, name: str) -> tuple[list[str], np.ndarray]:
        """(distinct words, which of them each text has)."""
        cut = np.ascontiguousarray(self._cut(name))
        found, which = np.unique(cut.view(f"S{cut.shape[1]}").ravel(), return_inverse=True)
        return [w.decode("ascii") for w in found], which.ravel()

    def mapped(self, name: str, table: dict) -> np.ndarray:
        """The words through a table; −1 where it has none."""
        found, which = self.words(name)
        return np.array([table.get(w, -1) for w in found], np.int64)[which]


def convert(g: Fields, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """(microseconds, whether there are such) of the texts of one mask."""
    micro, n = g.micros(), g.n
    if kind in EPOCHS:
        return g.number("e") * EPOCHS[kind] + micro, np.ones(n, bool)
    y, h, mi, s = g.number("y"), g.number("h"), g.number("mi"), g.number("s")
    mo = g.mapped("mon", MONTHS) if "mon" in g else g.number("mo", 1)
    d = g.number("d", 1)
    ok = (y >= 1) & (mo >= 1) & (mo <= 12) & (h < 24) & (mi < 60) & (s < 60) & (d >= 1)
    if "t" in g:
        ok &= g.mapped("t", {"t": 1, "": 1, " ": 1, "-": 1}) == 1
    marks = []
    if "ap" in g:
        found, which = g.words("ap")
        half = np.array([w in ("am", "pm") for w in found])[which]
        ok &= ~half | ((h >= 1) & (h <= 12))
        h = np.where(half, h % 12 + 12 * np.array([w == "pm" for w in found])[which], h)
        if "z" in g or "iana" in g:
            ok &= half
        else:  # two letters that are no half of the day may be a zone's
            marks.append((found, np.where(half, -1, which)))
    mo, y = np.where(ok, mo, 1), np.where(ok, y, 1970)
    one = np.ones(n, np.int64)
    first = days(y, mo, one)
    if "doy" in g:
        doy = g.number("doy")
        ok &= (doy >= 1) & (doy <= days(y + 1, mo, one) - first)
        date = first + doy - 1
    else:
        ok &= d <= days(y + mo // 12, mo % 12 + 1, one) - first
        date = first + d - 1
    if "dow" in g:
        ok &= g.mapped("dow", DAYS) == (date + 3) % 7
    local = date * 86400 + h * 3600 + mi * 60 + s
    utc, fixed = local.copy(), np.zeros(n, bool)
    if "z" in g:
        marks.append(g.words("z"))
    for found, which in marks:
        for k, name in enumerate(found):
            at = which == k
            if (off := offset_minutes(name)) is None:
                ok &= ~at
            else:
                utc, fixed = np.where(at, local - off * 60, utc), fixed | at
    if "iana" in g:
        found, which = g.words("iana")
        for k, name in enumerate(found):
            i = np.flatnonzero(which == k)
            if (zone := zones.names().get(name.strip("[]"))) is None:
                ok[i] = False
                continue
            u, one_instant = zones.to_utc(local[i], zone)
            table, offs = zones.transitions(zone)
            agree = offs[np.searchsorted(table, utc[i], side="right") - 1] == local[i] - utc[i]
            ok[i] &= np.where(fixed[i], agree, one_instant)
            utc[i] = np.where(fixed[i], utc[i], u)
    return utc * 1_000_000 + micro, ok


@lru_cache(4096)
def offset_minutes(name: str) -> int | None:
    if m := re.fullmatch(r"([+-])(\d\d):?(\d\d)?", name):
        h, mi = int(m[2]), int(m[3] or 0)
        return (h * 60 + mi) * (-1 if m[1] == "-" else 1) if h <= 18 and mi < 60 else None
    if m := re.fullmatch(r"(utc|gmt)([+-].*)", name):
        return offset_minutes(m[2])
    return ABBREVIATIONS.get(name)


def micros_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(microseconds since 1970 UTC, whether there are such) of each text of an Arrow array."""
    n = len(texts)
    us, ok = np.zeros(n, np.int64), np.zeros(n, bool)
    t = pc.fill_null(texts.cast(pa.large_string()), "")
    t = pc.replace_substring_regex(pc.ascii_lower(pc.utf8_trim_whitespace(t)), r"[ \t\n\r\f\v]+", " ")
    if not n or not (size := t.nbytes - 8 * (n + 1)) or t.buffers()[2] is None:
        return us, ok
    starts = np.frombuffer(t.buffers()[1], np.int64)[t.offset : t.offset + n + 1]
    data = np.frombuffer(t.buffers()[2], np.uint8)
    masked = pa.LargeStringArray.from_buffers(n, pa.py_buffer(np.ascontiguousarray(starts)), pa.py_buffer(_CLASS[data]))
    coded = masked.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    order = np.argsort(codes, kind="stable")
    cuts = np.searchsorted(codes[order], np.arange(len(coded.dictionary) + 1))
    for k, mask in enumerate(coded.dictionary.to_pylist()):
        # Only a fraction or white space can make a text of a shape long; parsed masks of usual length are kept.
        read = parser(mask) if len(mask) <= 80 else parser.__wrapped__(mask)
        if read is None:
            continue
        i = order[cuts[k] : cuts[k + 1]]
        us[i], ok[i] = convert(Fields(data, starts[i], read[1]), read[0])
    return us, ok


def normalise(texts: pd.Series) -> pd.Series:
    """Microseconds since 1970 UTC, or null, of each text."""
    us, ok = micros_of(pa.array(texts, pa.large_string(), from_pandas=True))
    return pd.Series(pd.array(us, dtype="Int64"), index=texts.index).where(ok)


def _same_version(stated: str) -> None:
    if zones.version() != stated:
        raise RuntimeError(f"zone tables of version {zones.version()}, the driver has {stated}")


def utc_micros(col: Column | str) -> Column:
    """The instant of a text column as microseconds since 1970 UTC; null where it denotes none."""
    stated = zones.version()

    @F.arrow_udf("long")
    def f(texts: pa.Array) -> pa.Array:
        _same_version(stated)
        us, ok = micros_of(texts)
        return pa.array(us, pa.int64(), mask=~ok)

    return f(col)


def instants(df: DataFrame, id_col: str, fields: list[str]) -> DataFrame:
    """(id, field_name, utc_us): each text of the given columns that denotes one instant; a row for each occurrence.

    All columns are read in one pass, and rows without an instant end in it.
    """
    stated = zones.version()

    def read(batches):
        _same_version(stated)
        for b in batches:
            for k, name in enumerate(fields):
                us, ok = micros_of(b.column(k + 1))
                i = pa.array(np.flatnonzero(ok))
                yield pa.RecordBatch.from_arrays([b.column(0).take(i), pa.repeat(name, len(i)), pa.array(us[ok])], ["id", "field_name", "utc_us"])

    narrow = df.select(F.col(id_col).cast("long").alias("id"), *[F.col(c).alias(f"t{k}") for k, c in enumerate(fields)]).where("id IS NOT NULL")
    return narrow.mapInArrow(read, "id long, field_name string, utc_us long")


def rejected(df: DataFrame, fields: list[str]) -> DataFrame:
    """(field_name, text, n): how often each text that denotes no one instant occurs; equal texts are counted before they are read."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("field_name"), F.col(c).alias("text")) for c in fields])).alias("x")).select("x.*")
    counted = long.where("text IS NOT NULL").groupBy("field_name", "text").agg(F.count("*").alias("n"))
    return counted.withColumn("utc_us", utc_micros("text")).where("utc_us IS NULL").drop("utc_us")
