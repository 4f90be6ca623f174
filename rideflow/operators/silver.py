"""Bronze -> Silver steps, each a DataFrame in and a DataFrame out."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rideflow import schemas
from rideflow.functions.text import clean_city
from rideflow.functions.times import calendar_parts, minutes_between, parse_timestamp
from rideflow.operators.privacy import mask, obfuscate_geo

_FAILURES = "array<struct<code:string,message:string>>"

LINEAGE = ("_source_file_uri", "_pipeline_run_id", "_processed_timestamp")


def cast_text(column: str, dtype: T.DataType) -> Column:
    """Text to `dtype`; NULL when it does not parse. Booleans are TRUE only for exactly 'True'."""
    text = F.col(column)
    if isinstance(dtype, T.BooleanType):
        return F.coalesce(text == "True", F.lit(False))
    if isinstance(dtype, T.TimestampNTZType):
        return parse_timestamp(text)
    if isinstance(dtype, T.StringType):
        return text
    return F.trim(text).try_cast(dtype)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast text columns to the declared types. Values that do not parse become NULL and are
    reported in `failures` as MALFORMED_VALUE. Other columns (partitions, lineage) pass through."""
    extra = [c for c in df.columns if c not in schema.names]
    checked = [f for f in schema if not isinstance(f.dataType, (T.StringType, T.BooleanType))]
    # Text and value side by side, so that each value is parsed once and tested where it is used.
    both = df.select(*[cast_text(f.name, f.dataType).alias(f.name) for f in schema], *extra,
                     *[F.col(f.name).alias(f"_text_{f.name}") for f in checked])
    failures = F.array()
    if checked:
        broken = {f: F.col(f"_text_{f.name}").isNotNull() & F.col(f.name).isNull() for f in checked}
        reasons = F.array_compact(F.array(*[
            F.when(is_broken, F.struct(
                F.lit("MALFORMED_VALUE").alias("code"),
                F.concat(F.lit(f"{f.name} is not a {f.dataType.simpleString()}: "), f"_text_{f.name}").alias("message")))
            for f, is_broken in broken.items()]))
        failures = F.when(reduce(lambda x, y: x | y, broken.values()), reasons).otherwise(F.array().cast(_FAILURES))
    return both.select(*[F.col(f.name).alias(f.name, metadata=f.metadata) for f in schema], *extra,
                       failures.cast(_FAILURES).alias("failures"))


def align_schema(df: DataFrame, schema: T.StructType, renames: dict[str, str] | None = None) -> DataFrame:
    """Map an older or newer Bronze layout to the declared columns: renamed columns are mapped,
    missing ones become typed NULLs, extra ones are dropped."""
    renames = renames or {}
    by_new_name = {new: old for old, new in renames.items()}
    columns = []
    for f in schema:
        source = f.name if f.name in df.columns else by_new_name.get(f.name)
        if source in df.columns:
            columns.append(F.col(source).alias(f.name))
        else:
            columns.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*columns)


def extra_columns(df: DataFrame, schema: T.StructType) -> list[str]:
    return [c for c in df.columns if c not in schema.names]


def standardize_city(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: clean_city(c) for c in columns})


# What a missing value means per field: a default, or nothing (kept, or rejected by the rules).
NULL_DEFAULTS = {
    "rides": {"surge_multiplier": "1.0"},
    "payments": {"tip_amount": "0.00"},
    "customers": {},
    "drivers": {},
}


def apply_null_policy(df: DataFrame, defaults: dict[str, str]) -> DataFrame:
    types = dict(df.dtypes)
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(types[c])) for c, v in defaults.items()}) if defaults else df


def derive_time(df: DataFrame, ts: str = "request_time") -> DataFrame:
    """ride_date, ride_hour, day_of_week, month, year."""
    return df.withColumns(calendar_parts(ts))


def derive_durations(df: DataFrame) -> DataFrame:
    """Waiting and trip minutes; NULL while the ride lacks a time."""
    return df.withColumns({
        "wait_minutes": minutes_between("request_time", "pickup_time"),
        "trip_minutes": minutes_between("pickup_time", "dropoff_time"),
    })


def with_lineage(df: DataFrame, run_id: str, processed_at: str, source_file=None) -> DataFrame:
    """Lineage columns. The run id and time are arguments, so a rerun gives the same rows.
    Without `source_file` the scanned file's path is used, which needs a file scan underneath."""
    if source_file is None:
        source = F.col("_metadata.file_path")
    else:
        source = F.lit(source_file) if isinstance(source_file, str) else source_file
    return df.withColumns({
        "_source_file_uri": source,
        "_pipeline_run_id": F.lit(run_id),
        "_processed_timestamp": F.lit(processed_at).cast("timestamp_ntz"),
    })


CITY_COLUMNS = {
    "customers": ["city"],
    "drivers": ["city"],
    "rides": ["pickup_city", "dropoff_city"],
    "payments": [],
}

EVENT_TIME = {"customers": "signup_date", "drivers": "join_date", "rides": "request_time", "payments": "payment_time"}


def clean(bronze_text: DataFrame, dataset: str) -> DataFrame:
    """Cast, standardise cities and apply the null policy; failures so far are in `failures`."""
    typed = conform(bronze_text, schemas.DATASETS[dataset])
    return apply_null_policy(standardize_city(typed, CITY_COLUMNS[dataset]) if CITY_COLUMNS[dataset] else typed,
                             NULL_DEFAULTS[dataset])


def protect(valid: DataFrame, dataset: str, salt: str, precision: int = 6) -> DataFrame:
    """Derived time fields, masking and coarse locations for rows that passed the rules."""
    out = valid
    if dataset == "rides":
        out = obfuscate_geo(derive_durations(derive_time(out)), precision=precision)
    elif dataset == "payments":
        out = out.withColumns({"year": F.year("payment_time"), "month": F.month("payment_time")})
    return mask(out, schemas.DATASETS[dataset], salt)
