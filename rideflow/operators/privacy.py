"""Masking by classification, geographic coarsening, roles, anonymity checks and erasure."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rideflow import schemas
from rideflow.functions.geo import geo_cell
from rideflow.functions.keys import salted_hash
from rideflow.functions.text import email_partial, initial, license_tail, phone_last4

FULL_ACCESS_ROLE = "data_protection_officer"


def mask(df: DataFrame, schema: T.StructType, salt: str) -> DataFrame:
    """Mask every CONFIDENTIAL column by the method its field names."""
    masked = {}
    for f in schema:
        if f.name not in df.columns or f.metadata.get("classification") != schemas.CONFIDENTIAL:
            continue
        method = f.metadata.get("mask", "hash")
        if method == "initial":
            masked[f.name] = initial(f.name)
        elif method == "last4":
            masked[f.name] = phone_last4(f.name)
        else:
            masked[f.name] = salted_hash(f.name, salt)
    return df.withColumns(masked) if masked else df


def obfuscate_geo(df: DataFrame, pairs=schemas.GEO_PAIRS, precision: int = 6) -> DataFrame:
    """Replace each coordinate pair by a cell and drop the coordinates."""
    cells = {cell: geo_cell(lat, lon, precision) for lat, lon, cell in pairs}
    return df.withColumns(cells).drop(*[c for lat, lon, _ in pairs for c in (lat, lon)])


def project_for_role(df: DataFrame, schema: T.StructType, role: str) -> DataFrame:
    """Full values for the data protection officer, partial ones for everybody else."""
    if role == FULL_ACCESS_ROLE:
        return df
    partial = {"email": email_partial, "phone": phone_last4, "license_number": license_tail}
    shown = {}
    for name in schemas.classified(schema, schemas.CONFIDENTIAL):
        if name in df.columns:
            shown[name] = partial.get(name, initial)(name)
    hidden = [c for c in schemas.classified(schema, schemas.RESTRICTED) if c in df.columns]
    return df.withColumns(shown).drop(*hidden)


def row_filter(df: DataFrame, column: str, allowed: str) -> DataFrame:
    """Rows of one city, for a regional analyst."""
    return df.filter(F.col(column) == allowed)


def visible_frames(role: str, tables: dict[str, DataFrame], views: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """What a role may read. A convention for shared code, not a security boundary."""
    if role in ("etl_writer", "data_analyst"):
        return {**tables, **views}
    if role == "bi_reader":
        return dict(views)
    raise ValueError(f"unknown role {role}")


def k_anonymity(df: DataFrame, quasi_ids: list[str], k: int) -> DataFrame:
    """Quasi-identifier groups with fewer than `k` rows."""
    return df.groupBy(*quasi_ids).agg(F.count("*").alias("group_size")).filter(F.col("group_size") < k)


# What counts as personal data in free text.
PII_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "phone": r"\+[0-9]{1,3}[ -]?[0-9]{10}",
    "card": r"(^|[^0-9])[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}($|[^0-9])",
}


def pii_scan(df: DataFrame) -> DataFrame:
    """Rows matching each pattern, per string column, in one pass over the data."""
    text = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    if not text:
        return df.sparkSession.createDataFrame([], "column_name string, pattern string, hits long")
    hits = df.agg(*[F.count_if(F.col(c).rlike(p)).alias(f"{c}|{kind}") for c in text for kind, p in PII_PATTERNS.items()])
    tall = hits.unpivot([], hits.columns, "key", "hits")
    return tall.select(F.split_part("key", F.lit("|"), F.lit(1)).alias("column_name"),
                       F.split_part("key", F.lit("|"), F.lit(2)).alias("pattern"), "hits")


# Sixteen digits in groups of four, with nothing but other characters around them; what lies around is not consumed, so that cards may stand side by side.
_CARD = r"(?<![0-9])[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}(?![0-9])"


def pii_scan_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """table_name, column_name, pattern, hits of every text column of all tables, one pass over each. A card counts if its check digit is right."""
    parts = []
    for name, df in tables.items():
        text = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
        if not text:
            continue
        counts = []
        for c in text:
            card = F.exists(F.regexp_extract_all(F.col(c), F.lit(_CARD), F.lit(0)), lambda x: F.call_function("luhn_check", F.translate(x, " -", "")))
            found = {"email": F.col(c).rlike(PII_PATTERNS["email"]), "phone": F.col(c).rlike(PII_PATTERNS["phone"]), "card": card}
            counts += [F.struct(F.lit(c).alias("column_name"), F.lit(kind).alias("pattern"), F.count_if(hit).alias("hits")) for kind, hit in found.items()]
        one = df.agg(F.array(*counts).alias("found")).select(F.lit(name).alias("table_name"), F.inline("found"))
        parts.append(one)
    return reduce(DataFrame.unionByName, parts)


def erase(df: DataFrame, subjects: DataFrame, key: str) -> DataFrame:
    """The table without the rows of the given subjects."""
    return df.join(subjects.select(key).filter(F.col(key).isNotNull()), key, "left_anti")


def subject_access(tables: dict[str, DataFrame], subjects: DataFrame, key: str) -> dict[str, DataFrame]:
    """All rows about the given subjects, per table that has the key."""
    ids = subjects.select(key)
    return {name: df.join(ids, key, "left_semi") for name, df in tables.items() if key in df.columns}
