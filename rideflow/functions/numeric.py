"""Exact money arithmetic: sums stay DECIMAL, rounding is half away from zero."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def money(col) -> Column:
    return F.col(col).cast("decimal(12,2)") if isinstance(col, str) else col.cast("decimal(12,2)")


def total(col, scale: int = 2) -> Column:
    """SUM rounded to `scale` digits."""
    return F.round(F.sum(col), scale).cast(f"decimal(18,{scale})")


def ratio(numerator: Column, denominator: Column, scale: int = 2) -> Column:
    """Exact quotient of a DECIMAL by a count; NULL when the count is 0."""
    return F.round(numerator / F.nullif(denominator, F.lit(0)), scale).cast(f"decimal(18,{scale})")


def mean(col, scale: int = 2) -> Column:
    """AVG over DECIMAL without going through DOUBLE."""
    return ratio(F.sum(col), F.count(col), scale)


def percent(part: Column, whole: Column, scale: int = 1) -> Column:
    return F.round(F.lit(100).cast("decimal(4,1)") * part / F.nullif(whole, F.lit(0)), scale).cast(
        f"decimal(18,{scale})")


def lowest(col) -> Column:
    return F.min(col).cast("decimal(18,2)")


def highest(col) -> Column:
    return F.max(col).cast("decimal(18,2)")
