"""Coordinate functions as Columns (SCL-4 slippy-map tiles, SCL-14 geo links)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .urls import col_or_lit, strip_ws


def deg2num(lat, lon, zoom) -> tuple[Column, Column]:
    """SCL-4: OSM tile (x, y) for lat/lon in degrees at ``zoom``; truncation toward zero.

    NULL when the result is not a finite number that fits a long (the reference fails the
    conversion in that case).
    """
    lat, lon, zoom = col_or_lit(lat), col_or_lit(lon), col_or_lit(zoom)
    n = F.pow(F.lit(2.0), zoom.cast("double"))
    x = (lon + F.lit(180.0)) / F.lit(360.0) * n
    y = (F.lit(1.0) - F.asinh(F.tan(F.radians(lat))) / F.pi()) / F.lit(2.0) * n

    def trunc(v: Column) -> Column:
        finite = ~F.isnan(v) & (F.abs(v) < F.lit(9.0e18))
        return F.when(finite, v.try_cast("long"))

    return trunc(x), trunc(y)


def tile_url(zoom, x, y) -> Column:
    return F.format_string("https://tile.openstreetmap.org/%d/%d/%d.png", col_or_lit(zoom), col_or_lit(x), col_or_lit(y))


def py_float_str(d, source_text=None) -> Column:
    """Text of a double as Python prints it (``repr``).

    The JVM's shortest representation agrees with Python's for fixed notation; the two
    differ only in where exponent notation starts and how it is spelled, handled here.
    """
    d = col_or_lit(d)
    s = d.cast("string")
    mant = F.regexp_extract(s, r"^(-?[0-9.]+)E(-?\d+)$", 1)
    exp = F.regexp_extract(s, r"^(-?[0-9.]+)E(-?\d+)$", 2).try_cast("int")
    mant_py = F.regexp_replace(mant, r"\.0$", "")
    sci_py = F.concat(mant_py, F.lit("e"), F.when(exp < 0, F.lit("-")).otherwise(F.lit("+")),
                      F.lpad(F.abs(exp).cast("string"), 2, "0"))
    fixed_in_py = (exp >= -4) & (exp < 16)
    src = strip_ws(col_or_lit(source_text)) if source_text is not None else s
    return (
        F.when(d.isNull(), F.lit(None))
        .when(F.isnan(d), F.lit("nan"))
        .when(d == float("inf"), F.lit("inf"))
        .when(d == float("-inf"), F.lit("-inf"))
        .when(mant == "", s)
        .when(fixed_in_py, src)
        .otherwise(sci_py)
    )


def geo_href(lat, lon) -> Column:
    """SCL-14: ``geo:lat,lon`` with both parts stripped."""
    return F.concat(F.lit("geo:"), strip_ws(col_or_lit(lat)), F.lit(","), strip_ws(col_or_lit(lon)))
