"""Zone transition tables: instants at which a zone's offset changes, read from the installed zone database.

The compiled zone files (TZif, RFC 9636) hold the past changes; the rule at a
file's end is written out for each year up to 9999, so a table covers every year
that a text can name.  Before the first change the zone's local mean time holds.

The driver states the version of its database; a worker with another one refuses
to convert, so one run never mixes two versions.
"""

from __future__ import annotations

import os
import re
import struct
from bisect import bisect_right
from functools import lru_cache
from importlib import resources
from zoneinfo import TZPATH, available_timezones

import numpy as np

LAST_YEAR = 9999


@lru_cache(1)
def version() -> str:
    for base in TZPATH:
        p = os.path.join(base, "tzdata.zi")
        if os.path.exists(p):
            with open(p) as f:
                return f.readline().split()[-1]
    try:
        import tzdata

        return tzdata.IANA_VERSION
    except ImportError:
        return "unknown"


@lru_cache(1)
def names() -> dict[str, str]:
    return {n.lower(): n for n in available_timezones()}


def _file(zone: str) -> bytes:
    for base in TZPATH:
        p = os.path.join(base, zone)
        if os.path.isfile(p):
            with open(p, "rb") as f:
                return f.read()
    *package, name = zone.split("/")
    return resources.files(".".join(["tzdata.zoneinfo", *package])).joinpath(name).read_bytes()


def _read(blob: bytes) -> tuple[np.ndarray, np.ndarray, int, str]:
    """(instants, offsets from each on, offset before the first, rule for what follows the last) of a TZif file."""

    def sizes(at: int) -> tuple[int, ...]:
        return struct.unpack(">6l", blob[at + 20 : at + 44])

    wide, at = 4, 0
    if blob[4:5] >= b"2":  # the block of 64-bit numbers follows that of 32-bit ones
        utc, std, leap, times, types, chars = sizes(0)
        at, wide = 44 + times * 5 + types * 6 + chars + leap * 8 + std + utc, 8
    utc, std, leap, times, types, chars = sizes(at)
    at += 44
    when = np.frombuffer(blob, f">i{wide}", times, at).astype(np.int64)
    at += times * wide
    which = np.frombuffer(blob, np.uint8, times, at)
    at += times
    kinds = [struct.unpack(">lBB", blob[at + 6 * i : at + 6 * i + 6]) for i in range(types)]
    at += 6 * types + chars + leap * (wide + 4) + std + utc
    rule = blob[at:].strip(b"\n").decode("ascii") if wide == 8 else ""
    offs = np.array([k[0] for k in kinds], np.int64)
    return when, offs[which], int(next((k[0] for k in kinds if not k[1]), kinds[0][0])), rule


def _seconds(text: str) -> int:
    """A signed h[:m[:s]] in seconds."""
    part = [int(x) for x in text.lstrip("+-").split(":")]
    return sum(x * u for x, u in zip(part, (3600, 60, 1))) * (-1 if text.startswith("-") else 1)


def _days(rule: str, years: np.ndarray) -> np.ndarray:
    """Days since 1970 on which a rule's date falls in each year."""
    jan = (years - 1970).astype("datetime64[Y]").astype("datetime64[D]").astype(np.int64)
    if rule[0] == "M":  # the w-th weekday d of month m, 5 being the last
        m, w, d = (int(x) for x in rule[1:].split("."))
        month = ((years - 1970) * 12 + m - 1).astype("datetime64[M]")
        first = month.astype("datetime64[D]").astype(np.int64)
        after = (month + 1).astype("datetime64[D]").astype(np.int64)
        day = first + (d - (first + 4) % 7) % 7 + 7 * (w - 1)
        return np.where(day >= after, day - 7, day)
    n = int(rule.lstrip("J"))
    leap = ((years % 4 == 0) & (years % 100 != 0)) | (years % 400 == 0)
    return jan + (n - 1 + (leap & (n >= 60)) if rule[0] == "J" else n)


def _tail(rule: str, after: int) -> tuple[np.ndarray, np.ndarray]:
    """The changes after an instant that the rule makes, to the last year."""
    name = r"(?:<[^>]+>|[A-Za-z]+)"
    m = re.fullmatch(rf"{name}(?P<std>[-+\d:]+)(?:{name}(?P<dst>[-+\d:]+)?,(?P<on>[^,/]+)(?:/(?P<ont>[-+\d:]+))?,(?P<off>[^,/]+)(?:/(?P<offt>[-+\d:]+))?)?", rule)
    if not m:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    std = -_seconds(m["std"])
    if not m["on"]:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    dst = -_seconds(m["dst"]) if m["dst"] else std + 3600
    years = np.arange(max(1, 1970 + int(after // 31556952) - 1), LAST_YEAR + 2)
    on = _days(m["on"], years) * 86400 + _seconds(m["ont"] or "2") - std
    off = _days(m["off"], years) * 86400 + _seconds(m["offt"] or "2") - dst
    when, offs = np.concatenate([on, off]), np.repeat([dst, std], len(years))
    order = np.argsort(when, kind="stable")
    when, offs = when[order], offs[order]
    return when[when > after], offs[when > after]


@lru_cache(1024)
def transitions(zone: str) -> tuple[np.ndarray, np.ndarray]:
    """(instants in seconds, offsets in seconds): offset i holds from instant i on; the first instant is far in the past."""
    when, offs, before, rule = _read(_file(zone))
    far = np.array([-(1 << 60)], np.int64)
    last = int(when[-1]) if len(when) else -(1 << 40)
    more, then = _tail(rule, last) if rule else (when[:0], offs[:0])
    at, offs = np.concatenate([far, when, more]), np.concatenate([[before], offs, then]).astype(np.int64)
    # Changes of name or of the daylight flag alone change no offset.
    new = np.concatenate([[True], offs[1:] != offs[:-1]])
    return at[new], offs[new]


def to_utc(local_s: np.ndarray, zone: str) -> tuple[np.ndarray, np.ndarray]:
    """UTC seconds of local seconds, and whether there is exactly one such instant."""
    at, offs = transitions(zone)
    found = np.zeros(len(local_s), dtype=np.int64)
    utc = np.zeros(len(local_s), dtype=np.int64)
    # Offsets are under 26 hours, so only the stretches around the local reading can hold the instant.
    lo = np.searchsorted(at, local_s - 93600, side="right") - 1
    hi = np.searchsorted(at, local_s + 93600, side="right") - 1
    for k in range(int((hi - lo).max(initial=0)) + 1):
        i = np.minimum(lo + k, hi)
        u = local_s - offs[i]
        ok = (lo + k <= hi) & (np.searchsorted(at, u, side="right") - 1 == i)
        utc = np.where(ok, u, utc)
        found += ok
    return utc, found == 1


def offset_at(utc_s: int, zone: str) -> int:
    at, offs = transitions(zone)
    return int(offs[bisect_right(at.tolist(), utc_s) - 1])
