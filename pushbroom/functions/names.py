"""Keys and names taken from product labels and file names, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed as K

_ID = r"\d{8}T\d{10}"


def basename(text: Column, strict: bool = False) -> Column:
    """The observation id in ``text``; without one NULL, or an error if ``strict``."""
    found = F.nullif(F.regexp_extract(text, _ID, 0), F.lit(""))
    return F.coalesce(found, F.raise_error(F.concat(F.lit("no observation id in: "), F.coalesce(text, F.lit("null"))))) if strict else found


def stem_token(path: Column, nth: int = 3) -> Column:
    """The ``nth`` (from 0) underscore-separated token of a file's stem."""
    stem = F.regexp_replace(F.substring_index(path, "/", -1), r"\.[^.]*$", "")
    return F.get(F.split(stem, "_"), nth)


def exposure_gain(exposure: Column, gain: Column) -> Column:
    return F.lower(F.concat(exposure, gain))


def projection_key(projection: Column, area: Column) -> Column:
    return F.replace(F.lower(F.concat(F.coalesce(projection, F.lit("equatorial")), F.coalesce(area, F.lit("")))), F.lit(" "), F.lit(""))


def projection_wkt(key: Column) -> Column:
    return F.create_map(*(F.lit(x) for kv in K.PROJECTIONS.items() for x in kv))[key]


def solar_distance(name: Column) -> Column:
    """Solar distance of the observation whose id ``name`` contains, or 1."""
    out = F.lit(1.0)
    for key, au in K.SOLAR_DISTANCE.items():
        out = F.when(F.contains(name, F.lit(key)), F.lit(au)).otherwise(out)
    return F.coalesce(out, F.lit(1.0))


def wavelength_label(wl: Column) -> Column:
    return F.concat(wl.cast("string"), F.lit(" nm"))


def crs_text(line: Column) -> Column:
    """What follows ``#CRS:`` in a points file's first line."""
    return F.regexp_replace(line, r"^#CRS:\s*", "")


def xml_text(xml: Column, key: str) -> Column:
    """Text of the first element of that local name (a namespace prefix in ``key`` is dropped); NULL without one."""
    return F.nullif(F.xpath_string(xml, F.lit(f'//*[local-name()="{key.split(":")[-1]}"]/text()')), F.lit(""))


def xml_numbers(xml: Column, key: str, kind: str = "double") -> Column:
    """All elements of a local name, as numbers."""
    return F.transform(F.xpath(xml, F.lit(f'//*[local-name()="{key.split(":")[-1]}"]/text()')), lambda v: v.cast(kind))
