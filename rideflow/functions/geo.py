"""Geohash cells from built-in functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The public geohash alphabet, and the digits of base 32 it stands for.
BASE32 = "0123456789bcdefghjkmnpqrstuvwxyz"
DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"


def _axis_index(value: Column, low: float, span: float, bits: int) -> Column:
    """Number of the 2^bits equal intervals of the axis that holds the value."""
    index = F.floor((value.cast("double") - F.lit(low)) / F.lit(span) * F.lit(float(1 << bits)))
    return F.least(index.cast("bigint"), F.lit((1 << bits) - 1).cast("bigint"))


def _spread(index: Column) -> Column:
    """Binary digits read as base-4 digits: a zero bit lands between neighbouring bits."""
    return F.conv(F.bin(index), 4, 10).cast("bigint")


def geo_cell(lat, lon, precision: int = 6) -> Column:
    """Geohash of `precision` characters (1 to 12); NULL for NULL or impossible coordinates.

    Each coordinate enters the arithmetic once, which keeps the generated code small enough for the
    JVM to compile.
    """
    if not 1 <= precision <= 12:
        raise ValueError("precision must be between 1 and 12")
    lat = F.col(lat) if isinstance(lat, str) else lat
    lon = F.col(lon) if isinstance(lon, str) else lon
    bits = 5 * precision
    lon_bits = _spread(_axis_index(lon, -180.0, 360.0, (bits + 1) // 2))
    lat_bits = _spread(_axis_index(lat, -90.0, 180.0, bits // 2))
    # Longitude owns the most significant bit, so the lower bit depends on the parity of the length.
    code = lon_bits * 2 + lat_bits if bits % 2 == 0 else lon_bits + lat_bits * 2
    text = F.lpad(F.conv(code.cast("string"), 10, 32), precision, "0")
    possible = lat.between(-90, 90) & lon.between(-180, 180)
    return F.when(possible, F.translate(text, DIGITS, BASE32))
