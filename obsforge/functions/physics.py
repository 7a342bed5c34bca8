"""Scalar calibration functions on columns.

All of them are column expressions, so they stay inside whole-stage code.
Division is guarded (``try_divide``), and missing pixels are null, never NaN.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Instrument constants of the square-root codec.
RAW_BITS, CODED_BITS = 16, 11


def sqrt_encode(v: Column, from_bits: int = RAW_BITS, to_bits: int = CODED_BITS) -> Column:
    """Square-root coding: scale to twice the coded bits, round half to even, root, cut."""
    scaled = F.rint(F.greatest(F.rint(v), F.lit(0.0)) * float(2.0 ** (2 * to_bits - from_bits)))
    return F.floor(F.sqrt(scaled))


def sqrt_decode(v: Column, from_bits: int = RAW_BITS, to_bits: int = CODED_BITS) -> Column:
    return F.rint(F.pow(F.greatest(F.rint(v), F.lit(0.0)), 2) / float(2.0 ** (2 * to_bits - from_bits)))


def ccd_gain(y: Column, ny: int, bottom: float, top: float) -> Column:
    """The gain of the detector half a row belongs to."""
    return F.when(y < ny // 2, F.lit(bottom)).otherwise(F.lit(top))


def initial_uncertainty(v: Column, gain: Column, dark: float, read: float) -> Column:
    """Photon, dark and read noise in quadrature, in the units of ``v``."""
    photon = F.sqrt(F.greatest(v, F.lit(0.0)) * gain) / gain
    return F.sqrt(photon * photon + F.lit(dark * dark) + (F.lit(read) / gain) * (F.lit(read) / gain))


def polynomial(coefficients: Sequence[Column], x: Column) -> Column:
    """Horner's rule, the highest power first."""
    out = coefficients[0]
    for c in coefficients[1:]:
        out = out * x + c
    return out


def interpolate_linear(before: Column, after: Column, t_before: Column, t_after: Column, t: Column) -> Column:
    """Between two models in time; a model's own time gives that model, a time outside gives null."""
    weight = F.try_divide(t - t_before, t_after - t_before)
    return F.when(t == t_before, before).when(t == t_after, after).when((t > t_before) & (t < t_after), before + (after - before) * weight)


def quadrature(a: Column, b: Column) -> Column:
    return F.sqrt(a * a + b * b)


def pack_uncertainty(v: Column, unc: Column) -> Column:
    """v / uncertainty; 0 where there is no finite ratio."""
    r = F.try_divide(v, unc)
    return F.when(unc == float("inf"), F.lit(0.0)).otherwise(F.coalesce(r, F.lit(0.0)))


def unpack_uncertainty(v: Column, packed: Column) -> Column:
    """v / packed; infinite where both are zero or nothing was packed."""
    return F.coalesce(F.try_divide(v, packed), F.lit(float("inf")))


def roll_phase(us: Column, start_us: int) -> Column:
    """Minute within the eight-minute roll cycle."""
    return F.pmod(F.floor((us - F.lit(start_us)) / 60_000_000), F.lit(8))


def roll_bin(angle: Column, bins: int = 24) -> Column:
    """Bin of a roll angle in [-180, 180]; both ends are one direction, so they share bin 0."""
    return F.pmod(F.floor((angle + 180.0) * bins / 360.0), F.lit(bins))


def overlapping_bins(angle: Column, bins: int = 30, width: float = 45.0) -> Column:
    """All bins whose arc of ``width`` degrees around its centre holds the angle, around the circle."""
    step = 360.0 / bins
    centres = F.sequence(F.lit(0), F.lit(bins - 1))
    off = lambda i: F.abs(F.pmod(angle - (i * F.lit(step) - 180.0) + 180.0, F.lit(360.0)) - 180.0)
    return F.filter(centres, lambda i: off(i) <= width / 2)


def year_wrap(us: Column, latest_us: int, year_us: int = 31_556_736_000_000) -> Column:
    """Move a date back by whole years of 365.24 days until it is no later than ``latest_us``."""
    over = F.greatest(F.ceil((us - F.lit(latest_us)) / float(year_us)), F.lit(0))
    return us - over * F.lit(year_us)


def piecewise(x: Column, knots: Sequence[tuple[float, float]]) -> Column:
    """Linear between the knots, constant beyond the ends; null for null and NaN."""
    k = sorted(knots)
    out = F.when(x.isNull() | F.isnan(x), F.lit(None).cast("double")).when(x <= k[0][0], F.lit(float(k[0][1])))
    for (x0, y0), (x1, y1) in zip(k[:-1], k[1:]):
        out = out.when(x <= x1, F.lit(float(y0)) + (x - x0) * (float(y1 - y0) / (x1 - x0)))
    return out.otherwise(F.lit(float(k[-1][1])))


def within_limit(x: Column, y: Column, knots: Sequence[tuple[float, float]], comparator: str) -> Column:
    """Whether y stands to the curve at x as the comparator says; null and NaN raise no flag and give null."""
    at = piecewise(x, knots)
    return {"<": y < at, ">": y > at, "<=": y <= at, ">=": y >= at, "=": y == at}[comparator]


def bits(v: Column, first: int, count: int) -> Column:
    """``count`` bits from bit ``first`` (0 the lowest) of an integer register."""
    return F.shiftright(v, first).bitwiseAND(F.lit((1 << count) - 1))


def outlier_bits(flag: Column, observatory: Column) -> Column:
    """Aggregate: bit n is set if observatory n is an outlier."""
    return F.bit_or(F.when(flag, F.call_function("shiftleft", F.lit(1), observatory)).otherwise(F.lit(0)))


def outlier_bit(code: Column, observatory: int) -> Column:
    return F.shiftright(code, observatory).bitwiseAND(F.lit(1))


def polarizer_solve(m: Column, z: Column, p: Column) -> tuple[Column, Column, Column]:
    """(total, Q-like, U-like) from intensities through polarizers at -60, 0 and 60 degrees: I(a) = (B + Q cos 2a + U sin 2a) / 2."""
    total = (m + z + p) * F.lit(2.0 / 3.0)
    q = (z * 2 - m - p) * F.lit(2.0 / 3.0)
    u = (p - m) * F.lit(2.0 / 3.0**0.5)
    return total, q, u


def resolve_polarizer(m: Column, z: Column, p: Column, angle: Column) -> Column:
    """Intensity through a polarizer at another angle (radians)."""
    b, q, u = polarizer_solve(m, z, p)
    return (b + q * F.cos(2 * angle) + u * F.sin(2 * angle)) * 0.5


def cubic(v: Column, a: float, b: float, c: float, d: float) -> Column:
    """A thermistor's temperature from its reading."""
    return polynomial([F.lit(a), F.lit(b), F.lit(c), F.lit(d)], v)


def quaternion_pointing(w: Column, x: Column, y: Column, z: Column) -> tuple[Column, Column]:
    """(right ascension, declination) in degrees of the rotated x axis of a normalised quaternion."""
    n = F.sqrt(w * w + x * x + y * y + z * z)
    w, x, y, z = (F.try_divide(c, n) for c in (w, x, y, z))
    vx, vy, vz = 1 - 2 * (y * y + z * z), 2 * (x * y + w * z), 2 * (x * z - w * y)
    return F.pmod(F.degrees(F.atan2(vy, vx)), F.lit(360.0)), F.degrees(F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), vz))))


def nearest_state(position: Column, states: Sequence[int], ring: int) -> Column:
    """Index of the state nearest to a resolver position around a ring; the first of equal ones."""
    gaps = F.array(*[F.least(F.pmod(position - s, F.lit(ring)), F.pmod(F.lit(s) - position, F.lit(ring))) for s in states])
    return (F.array_position(gaps, F.array_min(gaps)) - 1).cast("int")


def power_scale(v: Column, low: float, high: float, gamma: float) -> Column:
    """Clip to [low, high], scale to [0, 1], raise."""
    return F.pow((F.greatest(F.lit(low), F.least(F.lit(high), v)) - low) / (high - low), F.lit(gamma))


def pixel_solid_angle(x: Column, y: Column, step_deg: float) -> Column:
    """Solid angle of a pixel of an ARC projection, in squared degrees: step^2 sin(r) / r at distance r from the centre."""
    r = F.radians(F.sqrt(x * x + y * y) * step_deg)
    return F.lit(step_deg * step_deg) * F.when(r == 0, F.lit(1.0)).otherwise(F.sin(r) / r)


def pc_matrix(angle: Column, step_x: float, step_y: float) -> tuple[Column, Column, Column, Column]:
    """The rotation by an angle in degrees between pixel axes of different steps, row by row."""
    c, s = F.cos(F.radians(angle)), F.sin(F.radians(angle))
    return c, -s * (step_y / step_x), s * (step_x / step_y), c


def separation(lon: Column, lat: Column, lon2: Column, lat2: Column) -> Column:
    """Angle between two directions, all in degrees."""
    a, b = F.radians(lat), F.radians(lat2)
    cosine = F.sin(a) * F.sin(b) + F.cos(a) * F.cos(b) * F.cos(F.radians(lon - lon2))
    return F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine))))


def slerp(a: Sequence[Column], b: Sequence[Column], part: float) -> list[Column]:
    """A part of the way between two unit quaternions, the shorter way round; linear where they are one."""
    dot = a[0] * b[0] + a[1] * b[1] + a[2] * b[2] + a[3] * b[3]
    sign, angle = F.when(dot < 0, -1).otherwise(1), F.acos(F.least(F.lit(1.0), F.abs(dot)))
    weight = lambda p: F.when(angle < 1e-6, F.lit(p)).otherwise(F.sin(p * angle) / F.sin(angle))
    return [weight(1 - part) * x + weight(part) * sign * y for x, y in zip(a, b)]


def hsv_to_rgb(hue: Column, saturation: Column, value: Column) -> tuple[Column, Column, Column]:
    """Red, green and blue in [0, 1] of a hue in degrees and saturation and value in [0, 1]."""

    def part(n: int) -> Column:
        k = F.pmod(n + hue / 60, F.lit(6.0))
        return value - value * saturation * F.greatest(F.lit(0.0), F.least(k, 4 - k, F.lit(1.0)))

    return part(5), part(3), part(1)
