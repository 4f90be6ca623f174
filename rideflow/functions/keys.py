"""Hash keys and fingerprints."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def surrogate_key(*cols) -> Column:
    """60 bits of MD5 over the natural key: the same key in every run, so facts need no lookup join.

    NULL if any part of the natural key is NULL. Separators inside a part are escaped, so ("a|b", "c") and ("a", "b|c") differ.
    """
    parts = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit("|"))
        part = (F.col(c) if isinstance(c, str) else c).cast("string")
        escaped = F.replace(F.replace(part, F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|"))
        parts.append(escaped if len(cols) > 1 else part)
    return F.conv(F.substring(F.md5(F.concat(*parts)), 1, 15), 16, 10).cast("bigint")


def salted_hash(col, salt: str) -> Column:
    return F.sha2(F.concat(col, F.lit(salt)), 256)


def date_key(col) -> Column:
    """yyyymmdd as an integer."""
    return (F.year(col) * 10000 + F.month(col) * 100 + F.dayofmonth(col)).cast("int")


def row_fingerprint(cols) -> Column:
    """64-bit content hash of a row; summing it gives an order-free table fingerprint."""
    return F.xxhash64(*[F.col(c) for c in cols])
