"""Spectral indices and per-pixel tests. Bands 0-9: blue, green, red, near infrared, three red edges, narrow near infrared, two short-wave infrareds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import clip

BANDS = 10
#: The range of each of the 17 channels that is scaled to [-1, 1].
MIN_ALL = [
    0.006576638437476157, 0.0162050812542916, 0.010040436408026246,
    0.013351644159609368, 0.01965362020294499, 0.014229037918669413,
    0.015289539940489814, 0.011993591210803388, 0.008239871824216068,
    0.006546120393682765, 0.0, 0.0, 0.0, -0.1409399364817101,
    -0.4973397113668104, -0.09731556326714398, -0.7193834232943873,
]
MAX_ALL = [
    0.2691233691920348, 0.3740291447318227, 0.5171435111009385,
    0.6027466239414053, 0.5650263218127718, 0.5747005416952773,
    0.5933928435187305, 0.6034943160143434, 0.7472037842374304,
    0.7000076295109483, 0.4, 0.948334642387533,
    0.6729257769285485, 0.8177635298774327, 0.35768999002433816,
    0.7545951919107605, 0.7602693339366691,
]
#: Scene classes that count as cloudy or bad.
CLOUDY = (0, 1, 2, 3, 7, 8, 9, 10, 11)


def unit(x: Column) -> Column:
    return clip(x, 0, 1)


def evi(blue: Column, red: Column, nir: Column) -> Column:
    b, r, n = unit(blue), unit(red), unit(nir)
    return clip(F.try_divide(2.5 * (n - r), n + 6 * r - 7.5 * b + 1), -1.5, 1.5)


def brightness(blue: Column, red: Column, nir: Column, swir: Column) -> Column:
    b, r, n, s = unit(blue), unit(red), unit(nir), unit(swir)
    return clip(((s + r) - (n + b)) / ((s + r) + (n + b) + 1e-5), -1, 1)


def msavi2(red: Column, nir: Column) -> Column:
    r, n = unit(red), unit(nir)
    root = F.sqrt(F.greatest((2 * n + 1) * (2 * n + 1) - 8 * (n - r), F.lit(0.0)))
    return clip((2 * n + 1 - root) / 2, -1, 1)


def grndvi(green: Column, red: Column, nir: Column) -> Column:
    g, r, n = unit(green), unit(red), unit(nir)
    return (n - (g + r)) / (n + g + r + 1e-5)


def normalised_difference(a: Column, b: Column) -> Column:
    """(a - b) / (a + b); null where both are 0 (which arrays would give as NaN)."""
    return F.try_divide(a - b, a + b)


def snow(blue: Column, green: Column, red: Column, nir: Column, swir: Column) -> Column:
    """Whether the snow probability is above 0.

    It rises with the green/short-wave difference from 0.10 (below, it is negative) to 0.42; dark near infrared or
    blue makes it 0, bright ones make 1 of what is above 0, and a low blue/red ratio makes it 0.
    """
    ndsi = normalised_difference(green, swir)
    ramp = (F.when(ndsi < 0.10, 0.0).when(ndsi > 0.42, 0.42).otherwise(ndsi) - 0.1) / 0.32
    after_nir = F.when(nir < 0.10, 0.0).when((nir > 0.35) & (ramp > 0), 1.0).otherwise(ramp)
    after_blue = F.when(blue < 0.10, 0.0).when((blue > 0.22) & (after_nir > 0), 1.0).otherwise(after_nir)
    return F.coalesce(F.when(F.try_divide(blue, red) < 0.75, 0.0).otherwise(after_blue) > 0, F.lit(False))


def normalised(value: Column, channel: Column) -> Column:
    """A channel's value clipped to its range and scaled to [-1, 1]."""
    low, high = (F.element_at(F.array(*[F.lit(float(x)) for x in xs]), channel + 1) for xs in (MIN_ALL, MAX_ALL))
    return (F.least(F.greatest(value, low), high) - (high + low) / 2) / ((high - low) / 2)


def calibrated(dn: Column, noise: Column, lut: Column) -> Column:
    """Radar backscatter from digital numbers: noise taken off the square, not below 0, over the square of the table."""
    return F.try_divide(F.greatest(dn * dn - noise, F.lit(0.0)), lut * lut)


def flattened(gamma: Column, cos_incidence: Column, cos_local: Column) -> Column:
    """Terrain flattening; null where the slope turns too far away."""
    return F.when(cos_local >= 0.2, gamma * cos_incidence / F.greatest(cos_local, F.lit(0.1)))
