"""Radiometric formulas as column expressions, all inside Spark's code generation.

Missing is NULL, never NaN; a division by zero is NULL.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed as K

_C1 = 2 * K.PLANCK * K.LIGHT**2
_C2 = K.PLANCK * K.LIGHT / K.BOLTZMANN


def radiance(dn: Column, gain: Column, offset: Column, convert_offset: bool = False) -> Column:
    """Counts to radiance; the product's own formula leaves the offset unconverted."""
    return 10.0 * dn * gain + (10.0 * offset if convert_offset else offset)


def solar_flux(irradiance: Column, distance: Column | float = 1.0) -> Column:
    """Solar radiance at the surface for a distance in au."""
    d = distance if isinstance(distance, Column) else F.lit(float(distance))
    return irradiance * 10.0 / (F.pi() * d * d)


def solar_flux_rounded(irradiance: Column) -> Column:
    """The flux with a short pi, rounded half to even at four digits, as the polish table expects."""
    return F.bround(irradiance * 10.0 / 3.14, 4)


def incidence(elevation: Column) -> Column:
    return 90.0 - F.abs(elevation)


def cos_incidence(inc: Column) -> Column:
    return F.cos(F.radians(inc))


def valid_cosine(c: Column) -> Column:
    """NULL near the terminator and near the subsolar point."""
    return F.when((c > 0.03) & (c < 0.999), c)


def brightness_temperature(rad: Column, wl: Column, emissivity: float = K.EMISSIVITY) -> Column:
    """Temperature of a body of ``emissivity`` with radiance ``rad`` at ``wl`` metres."""
    q = F.ln(F.try_divide(F.lit(emissivity * _C1 * 1e-6), rad * F.pow(wl, F.lit(5.0))) + 1.0)
    return F.try_divide(F.lit(_C2), wl * q)


def planck(temperature: Column, wl: Column) -> Column:
    """Radiance of a black body at ``wl`` metres."""
    e = F.exp(F.try_divide(F.lit(_C2), wl * temperature)) - 1.0
    return F.try_divide(F.lit(1e-6 * _C1), F.pow(wl, F.lit(5.0)) * e)


def reflectance(rad: Column, thermal: Column, cos_inc: Column, flux: Column) -> Column:
    return F.try_divide(rad - thermal, cos_inc * flux)


def clip_at_zero(v: Column) -> Column:
    return F.when(v < 0, F.lit(0.0)).otherwise(v)


def wrap_longitude(lon: Column) -> Column:
    """Longitude in [-180, 180)."""
    return F.pmod(lon + 180.0, F.lit(360.0)) - 180.0


def flip_down(y: Column, least: Column) -> Column:
    """Line coordinate of a descending orbit."""
    return least - y


def stripe_fraction(sigma: float) -> float:
    """The share of a normal distribution within ``sigma`` standard deviations."""
    return math.erf(sigma / math.sqrt(2))


def decibels(magnitude: Column) -> Column:
    return 20.0 * F.ln(magnitude)


def local_cosine(dz_dx: Column, dz_dy: Column, inc: Column, azimuth: Column, lat: Column) -> Column:
    """Cosine of the angle between the normal of a slope and the sun, whose vector is turned to the latitude."""
    i, a, p = F.radians(inc), F.radians(azimuth), F.radians(lat)
    north, up = F.sin(i) * F.cos(a), F.cos(i)
    turned_north, turned_up = north * F.cos(p) - up * F.sin(p), north * F.sin(p) + up * F.cos(p)
    dot = -dz_dx * F.sin(i) * F.sin(a) - dz_dy * turned_north + turned_up
    return dot / F.sqrt(dz_dx * dz_dx + dz_dy * dz_dy + 1.0)
