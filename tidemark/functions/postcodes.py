"""Postcode expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.refdata import POSTCODE_PARTS

_EARTH_KM, _FLATTENING = 6378.137, 1 / 298.257223563  # WGS-84


def parsed_postcode(code: Column) -> Column:
    """Struct of full, area, district, sector, unit, outward and inward; null if it does not parse."""
    clean = F.replace(F.upper(code), F.lit(" "), F.lit(""))
    area, number, sector, unit = (F.regexp_extract(clean, POSTCODE_PARTS, i) for i in range(1, 5))
    outward = F.concat(area, number)
    return F.when(clean.rlike(POSTCODE_PARTS), F.struct(
        F.upper(code).alias("full"), area.alias("area"), outward.alias("district"),
        F.concat(outward, F.lit(" "), sector).alias("sector"), unit.alias("unit"),
        outward.alias("outward"), F.concat(sector, unit).alias("inward")))


def area_of(code: Column) -> Column:
    """Area of a postcode that parses, else null."""
    return parsed_postcode(code)["area"]


def geodesic_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Distance on the WGS-84 ellipsoid by Lambert's closed formula (metres off over a country)."""
    b1, b2 = (F.atan((1 - _FLATTENING) * F.tan(F.radians(lat))) for lat in (lat1, lat2))
    across = F.radians(lon2 - lon1)
    h = F.pow(F.sin((b2 - b1) / 2), F.lit(2)) + F.cos(b1) * F.cos(b2) * F.pow(F.sin(across / 2), F.lit(2))
    angle = 2 * F.asin(F.sqrt(F.least(h, F.lit(1.0))))
    p, q = (b1 + b2) / 2, (b2 - b1) / 2
    sq = lambda c: F.pow(c, F.lit(2))
    x = (angle - F.sin(angle)) * F.try_divide(sq(F.sin(p)) * sq(F.cos(q)), sq(F.cos(angle / 2)))
    y = (angle + F.sin(angle)) * F.try_divide(sq(F.cos(p)) * sq(F.sin(q)), sq(F.sin(angle / 2)))
    distance = _EARTH_KM * (angle - _FLATTENING / 2 * (x + y))
    return F.when(angle == 0, F.lit(0.0)).otherwise(distance)
