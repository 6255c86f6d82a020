"""Operators along the bands of a pixel, on its spectrum as an array: no shuffle at all.

Position i of a spectrum is band i + 1. Every function maps an array column to an array column; NULL elements are missing.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import fixed as K
from ..functions import radiometry as R


def _constants(values: Iterable) -> Column:
    return F.array(*(F.lit(v) for v in values))


def each(spectrum: Column, f) -> Column:
    """``f`` of each value and its band."""
    return F.transform(spectrum, lambda v, i: f(v, i + 1))


def scale(spectrum: Column, by: float = K.RADIANCE_SCALE) -> Column:
    return F.transform(spectrum, lambda v: v * F.lit(by))


def mask_bands(spectrum: Column, bands: Iterable[int] = K.ORDER_SORTING + K.NO_SIGNAL) -> Column:
    bands = sorted(set(bands))
    return each(spectrum, lambda v, b: F.when(~b.isin(bands), v))


def mask_flagged(spectrum: Column, bad: Column) -> Column:
    """NULL where the flag array ``bad`` is true; a band without a flag stays."""
    return F.transform(spectrum, lambda v, i: F.when(~F.coalesce(F.get(bad, i), F.lit(False)), v))


def mask_saturated(spectrum: Column, limit: Column) -> Column:
    """Keeps values strictly below their band's limit; a band without one is NULL."""
    return F.transform(spectrum, lambda v, i: F.when(v < F.get(limit, i), v))


def mask_low_signal(spectrum: Column, band: int = 10, least: float = 0.5) -> Column:
    """The whole spectrum NULL unless ``band`` exceeds ``least``."""
    lit_up = F.coalesce(F.get(spectrum, F.lit(band - 1)) > least, F.lit(False))
    return F.when(lit_up, spectrum).otherwise(F.transform(spectrum, lambda v: F.lit(None).cast("double")))


def at_most(spectrum: Column, largest: float = math.inf) -> Column:
    return F.transform(spectrum, lambda v: F.when(v <= F.lit(float(largest)), v))


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of ``value``, which is computed once however often ``f`` uses it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def interpolate(spectrum: Column, max_gap: int | None = 11) -> Column:
    """Fills holes linearly between present values at most ``max_gap`` bands apart (None: any); ends are not extrapolated."""

    def fill(t: Column) -> Column:
        def value(v: Column, i: Column) -> Column:
            ends = F.struct(F.array_max(F.filter(t["at"], lambda p: p < i)).alias("a"), F.array_min(F.filter(t["at"], lambda p: p > i)).alias("b"))
            return F.when(v.isNotNull(), v).otherwise(let(ends, lambda e: between(e["a"], e["b"], i)))

        def between(a: Column, b: Column, i: Column) -> Column:
            va, vb = F.get(t["s"], a), F.get(t["s"], b)
            return F.when((b - a <= max_gap) if max_gap is not None else F.lit(True), va + (vb - va) * (i - a) / (b - a))

        return F.transform(t["s"], value)

    at = F.filter(F.transform(spectrum, lambda v, i: F.when(v.isNotNull(), i)), lambda i: i.isNotNull())
    return let(F.struct(spectrum.alias("s"), at.alias("at")), fill)


def _window(spectrum: Column, i: Column, before: int, after: int) -> Column:
    """Present values at positions i - before .. i + after."""
    start = F.greatest(i - before, F.lit(0))
    return F.filter(F.slice(spectrum, start + 1, F.greatest(i + after + 1 - start, F.lit(0))), lambda v: v.isNotNull())


def boxcar(spectrum: Column, width: int, least: float | None = None) -> Column:
    """Centred moving mean of present values; NULL with fewer than ``least`` of them (half the width by default).

    An even width reaches one band further back than ahead.
    """
    least = width / 2 if least is None else least
    before, after = width // 2, (width - 1) // 2

    def mean(w: Column) -> Column:
        return F.when((F.size(w) >= F.lit(least)) & (F.size(w) > 0), F.aggregate(w, F.lit(0.0), lambda s, x: s + x) / F.size(w))

    return let(spectrum, lambda s: F.transform(s, lambda v, i: let(_window(s, i, before, after), mean)))


def gaussian_weights(width: int) -> list[float]:
    if width % 2 == 0:
        raise ValueError("a Gaussian window needs an odd width")
    w = [math.exp(-0.5 * (k - width // 2) ** 2) for k in range(width)]
    return [x / sum(w) for x in w]


def gaussian(spectrum: Column, width: int) -> Column:
    """Gaussian weighted sum over a full window of the interpolated spectrum; values that were missing stay so."""
    weights, half = gaussian_weights(width), width // 2

    def weigh(t: Column) -> Column:
        def value(v: Column, i: Column) -> Column:
            terms = [F.lit(w) * F.when(i + k >= half, F.get(t["filled"], i + (k - half))) for k, w in enumerate(weights)]
            total = terms[0]
            for term in terms[1:]:
                total = total + term
            return F.when(v.isNotNull(), total)

        return F.transform(t["s"], value)

    return let(F.struct(spectrum.alias("s"), interpolate(spectrum, None).alias("filled")), weigh)


def smooth(spectrum: Column, kind: str = "none", width: int = 1) -> Column:
    """``boxcar`` or ``gaussian`` by name; other names leave the spectrum as it is."""
    kinds = {"boxcar": lambda: boxcar(spectrum, width), "gaussian": lambda: gaussian(spectrum, width)}
    return kinds.get(kind.lower(), lambda: spectrum)()


def mean_temperature(spectrum: Column, wl: Column, bands: tuple[int, int] = K.THERMAL_BANDS) -> Column:
    """Mean brightness temperature over the bands from ``bands[0]`` to ``bands[1]``, of present values."""
    first, n = bands[0], bands[1] - bands[0] + 1
    part = F.slice(spectrum, first, n)
    t = F.transform(part, lambda v, i: R.brightness_temperature(v, F.get(wl, i + (first - 1))))
    mean = lambda t: F.when(F.size(t) > 0, F.aggregate(t, F.lit(0.0), lambda s, x: s + x) / F.size(t))
    return let(F.filter(t, lambda v: v.isNotNull()), mean)


def thermal_radiance(spectrum: Column, wl: Column, bands: tuple[int, int] = K.THERMAL_BANDS, emissivity: float = K.EMISSIVITY, temperature: Column | None = None) -> Column:
    """Emitted radiance by band of an isothermal surface at the pixel's mean brightness temperature (or at ``temperature``)."""
    t = mean_temperature(spectrum, wl, bands) if temperature is None else temperature
    return let(t, lambda t: F.transform(wl, lambda w: F.lit(emissivity) * R.planck(t, w)))


def reflect(spectrum: Column, thermal: Column | None, cos_inc: Column, flux: Column) -> Column:
    """I/F of each band."""
    known = F.struct(spectrum.alias("s"), (F.lit(None).cast("array<double>") if thermal is None else thermal).alias("heat"), cos_inc.alias("c"), flux.alias("f"))
    heat = lambda t, i: F.lit(0.0) if thermal is None else F.get(t["heat"], i)
    return let(known, lambda t: F.transform(t["s"], lambda v, i: R.reflectance(v, heat(t, i), t["c"], F.get(t["f"], i))))


def polish(spectrum: Column, coefficients: Column, last: int | None = 101, outside: str = "keep") -> Column:
    """Divides bands by their coefficient; bands without one, or above ``last``, stay or become NULL by ``outside``."""

    def divide(v: Column, i: Column) -> Column:
        c = F.get(coefficients, i) if last is None else F.when(i < last, F.get(coefficients, i))
        return F.when(c.isNotNull(), F.try_divide(v, c)).otherwise(v if outside == "keep" else F.lit(None))

    return F.transform(spectrum, divide)
