"""Data quality: rules as data, evaluation with every reason kept, quarantine and reports.

A rule's predicate is SQL text that is TRUE for a good row; FALSE and NULL both fail. `evaluate`
adds `failures array<struct<code, message>>`; a row is valid when the array is empty, so every row
lands on exactly one side.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rideflow import schemas
from rideflow.functions.numeric import percent
from rideflow.functions.times import hours_between
from rideflow.operators.dedupe import duplicated_keys, flag_exactly, flag_members, mark_first
from rideflow.operators.ranking import rolling_mean
from rideflow.sources.workdir import materialize, side_by_side

ERROR = "error"
WARNING = "warning"


@dataclass(frozen=True)
class Rule:
    code: str
    predicate: str
    message: str
    severity: str = ERROR


@dataclass(frozen=True)
class ForeignKey:
    """`column` must occur among the accepted `parents`. Say `unique` where each parent key occurs
    once: the keys then go into the join as they are. With `since`, a column of the parents, a parent counts for rows whose
    `_date` is not before it."""

    code: str
    column: str
    parents: DataFrame
    parent_column: str
    unique: bool = False
    since: str | None = None


@dataclass(frozen=True)
class Unique:
    """Among rows that pass everything before it, only the first per `key` by `order` is kept."""

    code: str
    key: tuple[str, ...]
    order: tuple[str, ...]
    message: str


def _in(column: str, values) -> str:
    return f"{column} IN ({', '.join(repr(v) for v in values)})"


def _not_null(column: str, code: str = "NULL_REQUIRED") -> Rule:
    return Rule(code, f"{column} IS NOT NULL", f"{column} must not be null")


LOAD_RULES = {
    "customers": (
        _not_null("customer_id", "NULL_PK"),
        _not_null("email", "NULL_EMAIL"),
    ),
    "drivers": (
        _not_null("driver_id", "NULL_PK"),
        Rule("INVALID_VEHICLE_TYPE", _in("vehicle_type", schemas.VEHICLE_TYPES), "vehicle_type is not a known type"),
        Rule("INVALID_RATING", "rating BETWEEN 1.0 AND 5.0", "rating must be between 1.0 and 5.0"),
    ),
    "rides": (
        _not_null("ride_id", "NULL_PK"),
        Rule("NEGATIVE_DISTANCE", "distance_km >= 0", "distance_km must be >= 0"),
        Rule("NEGATIVE_FARE", "fare >= 0", "fare must be >= 0"),
        Rule("INVALID_SURGE", "surge_multiplier >= 1.0", "surge_multiplier must be >= 1.0"),
        Rule("INVALID_RIDE_STATUS", _in("ride_status", schemas.RIDE_STATUSES), "ride_status is not a known status"),
        Rule("ZERO_FARE", "NOT coalesce(fare = 0 AND ride_status = 'completed', false)",
             "completed ride has fare 0", WARNING),
    ),
    "payments": (
        _not_null("payment_id", "NULL_PK"),
        Rule("NEGATIVE_AMOUNT", "amount >= 0", "amount must be >= 0"),
        Rule("NEGATIVE_TIP", "tip_amount >= 0", "tip_amount must be >= 0"),
        Rule("INVALID_PAYMENT_METHOD", _in("payment_method", schemas.PAYMENT_METHODS), "payment_method is not a known method"),
        Rule("INVALID_PAYMENT_STATUS", _in("payment_status", schemas.PAYMENT_STATUSES), "payment_status is not a known status"),
    ),
}

_SILVER_EXTRA = {
    "rides": (
        Rule("ZERO_FARE", "fare IS NULL OR fare <> 0", "fare must be > 0"),
        Rule("INVALID_COORDINATES",
             "pickup_lat BETWEEN -90 AND 90 AND dropoff_lat BETWEEN -90 AND 90 "
             "AND pickup_lon BETWEEN -180 AND 180 AND dropoff_lon BETWEEN -180 AND 180",
             "latitude must be between -90 and 90, longitude between -180 and 180"),
        Rule("INVALID_TIMESTAMPS",
             "(coalesce(ride_status, '') <> 'completed' OR (pickup_time IS NOT NULL AND dropoff_time IS NOT NULL)) "
             "AND coalesce(pickup_time >= request_time, true) AND coalesce(dropoff_time >= pickup_time, true)",
             "completed rides need both times, and request <= pickup <= drop-off"),
    ),
}


def required_rules(schema: T.StructType, key: str) -> tuple[Rule, ...]:
    """One rule per NOT NULL column; the key has its own code."""
    return tuple(_not_null(f.name) for f in schema if not f.nullable and f.name != key)


def length_rules(schema: T.StructType) -> tuple[Rule, ...]:
    """One rule per column with a declared maximum length."""
    return tuple(
        Rule("STRING_TOO_LONG", f"{f.name} IS NULL OR length({f.name}) <= {f.metadata['max_length']}",
             f"{f.name} is longer than {f.metadata['max_length']}")
        for f in schema if "max_length" in f.metadata)


def silver_rules(dataset: str) -> tuple[Rule, ...]:
    """The load rules, with zero fares rejected, and all schema rules."""
    schema = schemas.DATASETS[dataset]
    base = tuple(r for r in LOAD_RULES[dataset] if r.severity == ERROR and r.code != "NULL_EMAIL")
    if dataset == "customers":
        base += (_not_null("email", "NULL_EMAIL"),)
    seen = {r.predicate for r in base}
    required = tuple(r for r in required_rules(schema, schemas.PRIMARY_KEYS[dataset]) if r.predicate not in seen)
    return base + _SILVER_EXTRA.get(dataset, ()) + required + length_rules(schema)


def unique_rules(dataset: str) -> tuple[Unique, ...]:
    """The natural key of customers and drivers, then the primary key."""
    key = schemas.PRIMARY_KEYS[dataset]
    natural = {
        "customers": (Unique("DUPLICATE_EMAIL", ("email",), ("email", "customer_id"), "email already belongs to an earlier id"),),
        "drivers": (Unique("DUPLICATE_LICENSE", ("license_number",), ("license_number", "driver_id"),
                           "license_number already belongs to an earlier id"),),
    }
    return natural.get(dataset, ()) + (Unique("DUPLICATE_PK", (key,), (key,), f"{key} occurs more than once"),)


def foreign_keys(dataset: str, accepted: dict[str, DataFrame], unique: bool = False) -> tuple[ForeignKey, ...]:
    if dataset == "rides":
        return (ForeignKey("ORPHAN_CUSTOMER", "customer_id", accepted["customers"], "customer_id", unique),
                ForeignKey("ORPHAN_DRIVER", "driver_id", accepted["drivers"], "driver_id", unique))
    if dataset == "payments":
        return (ForeignKey("ORPHAN_RIDE", "ride_id", accepted["rides"], "ride_id", unique),
                ForeignKey("ORPHAN_PAYMENT_CUSTOMER", "customer_id", accepted["customers"], "customer_id", unique))
    return ()


def _failure(code: str, message: str):
    return F.struct(F.lit(code).alias("code"), F.lit(message).alias("message"))


_FAILURES = "array<struct<code:string,message:string>>"


def _failed(rules):
    """Failures of the given rules. The usual row passes all of them, so the array of reasons is only
    built behind one test of all predicates."""
    if not rules:
        return F.array().cast(_FAILURES)
    holds = {r: F.coalesce(F.expr(r.predicate), F.lit(False)) for r in rules}
    reasons = F.array_compact(F.array(*[F.when(~ok, _failure(r.code, r.message)) for r, ok in holds.items()]))
    return F.when(reduce(lambda x, y: x & y, holds.values()), F.array().cast(_FAILURES)).otherwise(reasons.cast(_FAILURES))


def _check_rows(df: DataFrame, rules) -> DataFrame:
    found = _failed([r for r in rules if r.severity == ERROR])
    warnings = _failed([r for r in rules if r.severity == WARNING])
    return df.withColumns({
        "failures": F.array_union("failures", found) if "failures" in df.columns else found,
        "warnings": F.transform(warnings, lambda x: x["code"]),
    })


def _parent_keys(fk: ForeignKey, stage_in: str | None = None) -> DataFrame:
    """Each parent key once, so that the join adds no rows.

    Spark splits a hot key of a join only if both sides come straight from a shuffle, and an
    aggregation is none. Keys that have to be made distinct are therefore stored first, if possible.
    """
    keys = fk.parents.select(F.col(fk.parent_column).alias("_parent")).filter("_parent IS NOT NULL")
    if fk.unique:
        return keys
    return materialize(keys.distinct(), f"{stage_in}/parents_{fk.column}") if stage_in else keys.distinct()


def _check_parents(df: DataFrame, foreign, stage_in: str | None = None) -> DataFrame:
    out = df
    for fk in foreign:
        found = out.join(_parent_keys(fk, stage_in), F.col(fk.column) == F.col("_parent"), "left")
        out = found.withColumn("failures", F.when(
            F.col("_parent").isNull(), F.array_union("failures", F.array(_missing(fk)))).otherwise(F.col("failures"))).drop("_parent")
    return out


def _missing(fk: ForeignKey):
    return F.when(F.col(fk.column).isNull(), _failure("NULL_REQUIRED", f"{fk.column} must not be null")).otherwise(
        _failure(fk.code, f"{fk.column} has no accepted parent row"))


def _reference(fk: ForeignKey):
    """What a row asks of the parents: its key, and with `since` its date as well."""
    return F.concat("_date", F.lit("|"), fk.column) if fk.since else F.col(fk.column)


def _asked_keys(stored: DataFrame, fk: ForeignKey, stage_in: str) -> DataFrame:
    """What the rows of `stored` ask of the parents, with `_in` for what has no accepted parent row, stored. Only keys are shuffled, each once from every task."""
    asked = stored.select(F.col(fk.column).alias("_key"), *(["_date"] if fk.since else [])).filter("_key IS NOT NULL").distinct()
    same = F.col("_key") == F.col("_parent")
    if fk.since:
        known = fk.parents.filter(F.col(fk.parent_column).isNotNull()).groupBy(F.col(fk.parent_column).alias("_parent"))
        found = asked.join(known.agg(F.min(F.col(fk.since).cast("date")).alias("_since")), same & (F.col("_since") <= F.col("_date").cast("date")), "left")
        keys = found.select(F.concat("_date", F.lit("|"), "_key").alias("_key"), F.col("_parent").isNull().alias("_in"))
    else:
        keys = asked.join(_parent_keys(fk), same, "left").select("_key", F.col("_parent").isNull().alias("_in"))
    return materialize(keys, f"{stage_in}/keys_{fk.column}")


def _flag_orphans(stored: DataFrame, foreign, stage_in: str) -> tuple[DataFrame, list[str]]:
    """`stored` with a flag for each reference, true where it is NULL or has no accepted parent row, and the names of these flags. Rows are not shuffled."""
    checked, lost = stored, []
    for i, (fk, keys) in enumerate(zip(foreign, side_by_side([partial(_asked_keys, stored, fk, stage_in) for fk in foreign]))):
        flagged = flag_exactly(checked.withColumn("_reference", _reference(fk)), "_reference", keys, f"{stage_in}/orphans_{fk.column}", "_orphan")
        lost.append(f"_lost_{i}")
        checked = flagged.withColumn(lost[-1], F.col("_orphan") | F.col(fk.column).isNull()).drop("_orphan", "_reference")
    return checked, lost


def _sound(lost: list[str], unique):
    """Does a row with the flags of `_flag_orphans` pass everything but uniqueness?"""
    return reduce(lambda x, y: x & y, [~F.col(flag) for flag in lost] + [F.col(k).isNotNull() for u in unique for k in u.key], F.col("_ok"))


def _with_reasons(checked: DataFrame, foreign, lost: list[str], unique) -> DataFrame:
    """The failures of references and missing keys, in the place of the flags."""
    out = checked
    for flag, fk in zip(lost, foreign):
        out = out.withColumn("failures", F.when(F.col(flag), F.array_union("failures", F.array(_missing(fk)))).otherwise(F.col("failures")))
    return _check_keys_present(out, unique).drop(*lost)


def _check_keys_present(df: DataFrame, unique) -> DataFrame:
    """A missing key has no duplicates; it is a missing value."""
    out = df
    for k in dict.fromkeys(k for u in unique for k in u.key):
        absent = F.array(_failure("NULL_REQUIRED", f"{k} must not be null")).cast(_FAILURES)
        out = out.withColumn("failures", F.when(
            F.col(k).isNull() & (F.size("failures") == 0), absent).otherwise(F.col("failures")))
    return out


def evaluate(df: DataFrame, rules=(), foreign=(), unique=()) -> DataFrame:
    """Add `failures` and `warnings` in one plan. Existing failures (from casting) are kept."""
    out = _check_keys_present(_check_parents(_check_rows(df, rules), foreign), unique)
    for u in unique:
        marked = mark_first(out, list(u.key), list(u.order), eligible=F.size("failures") == 0, name="_first")
        out = marked.withColumn("failures", F.when(
            (F.size("failures") == 0) & ~F.col("_first"), F.array(_failure(u.code, u.message)).cast(_FAILURES))
            .otherwise(F.col("failures"))).drop("_first")
    return out


def flag_loaded(df: DataFrame, key: str, loaded) -> DataFrame:
    """Add the failure of rows for which `loaded`, a condition, says that their key was loaded on an earlier date."""
    failure = F.array(_failure("DUPLICATE_PK", f"{key} was loaded on an earlier date")).cast(_FAILURES)
    return df.withColumn("failures", F.when(loaded, F.array_union("failures", failure)).otherwise(F.col("failures")))


def evaluate_over_dates(df: DataFrame, rules, foreign, unique: Unique, loaded: DataFrame, stage_in: str) -> DataFrame:
    """`judge` for rows of several dates (`_date`) at once, as if each date were judged after the ones before it: of the rows
    of a key, those of the first date on which one passes compete, and all later ones were loaded before. `loaded` has the key and the `_date` of
    rows accepted on other dates. `df` must hold all rows of its keys on the dates it is about.

    Rows are stored once and not shuffled, but for those whose key has several rows or was loaded before them."""
    key = unique.key[0]
    stored = materialize(_check_rows(df, rules).withColumn("_ok", F.size("failures") == 0), f"{stage_in}/rows")
    checked, lost = _flag_orphans(stored, foreign, stage_in)
    sound = _sound(lost, (unique,))
    own = checked.select(F.col(key).alias("_key"), F.col("_date").cast("date").alias("_day"), sound.alias("_sound"), F.lit(1).alias("_own")).filter("_key IS NOT NULL")
    held = loaded.select(F.col(key).alias("_key"), F.col("_date").cast("date").alias("_day"), F.lit(True).alias("_sound"), F.lit(0).alias("_own"))
    seen = own.unionByName(held).groupBy("_key").agg(F.sum("_own").alias("copies"), F.min(F.expr("IF(_sound, _day, NULL)")).alias("_first_day"),
                                                    F.max(F.expr("IF(_own = 1, _day, NULL)")).alias("_last_day"))
    meeting = materialize(seen.filter("copies > 1 OR _first_day < _last_day"), f"{stage_in}/meeting")
    keys, copies, over = meeting.agg(F.count("*"), F.max("copies"), F.count_if(F.expr("_first_day < _last_day"))).first()
    alone, ranked = checked, None
    if keys:
        flagged = flag_members(checked, meeting, ["_key"], keys, f"{stage_in}/bitmap", column=key)
        alone = flagged.filter("NOT _listed").drop("_listed")
        met = _with_reasons(flagged.filter("_listed").drop("_listed"), foreign, lost, (unique,))
        if over:
            days = materialize(meeting.filter("_first_day < _last_day").select("_key", "_first_day"), f"{stage_in}/first")
            known = met.join(days, F.col(key) == F.col("_key"), "left")
            met = flag_loaded(known, key, F.col("_first_day") < F.col("_date").cast("date")).drop("_key", "_first_day")
        marked = mark_first(met, [key, "_date"], list(unique.order), eligible=F.size("failures") == 0, name="_first", copies=copies)
        doubles = (F.size("failures") == 0) & ~F.col("_first")
        named = marked.withColumn("failures", F.when(doubles, F.array(_failure(unique.code, unique.message)).cast(_FAILURES)).otherwise(F.col("failures")))
        ranked = materialize(named.withColumn("_ok", F.size("failures") == 0).drop("_first"), f"{stage_in}/ranked", ("_ok",))
    passed = alone.filter(sound).drop(*lost)
    failed = _with_reasons(alone.filter(~sound), foreign, lost, (unique,)).withColumn("_ok", F.lit(False))
    if ranked is not None:
        passed, failed = passed.unionByName(ranked.filter("_ok")), failed.unionByName(ranked.filter("NOT _ok"))
    return passed.unionByName(failed)


def judge(df: DataFrame, rules=(), foreign=(), unique=(), *, stage_in: str) -> DataFrame:
    """`evaluate` for large tables, with `_ok` telling the sides apart.

    Rows are checked by themselves and stored. References then need only the keys, each once, and uniqueness only the key column to find
    repeated keys; only rows with such a key are ranked, and a few that a bitmap of the keys takes for such. So the other
    rows are never shuffled, however many parents there are and however many keys repeat.
    """
    stored = materialize(_check_rows(df, rules).withColumn("_ok", F.size("failures") == 0), f"{stage_in}/rows")
    checked, lost = _flag_orphans(stored, foreign, stage_in)
    sound = _sound(lost, unique)
    passed = checked.filter(sound).drop(*lost)
    failed = _with_reasons(checked.filter(~sound), foreign, lost, unique).withColumn("_ok", F.lit(False))

    def repeated_keys(i: int) -> tuple[DataFrame, int, int]:
        """The keys that repeat, how many they are and the most rows of one."""
        keys = materialize(duplicated_keys(passed_rows, list(unique[i].key)), f"{stage_in}/repeated_{i}")
        return keys, *keys.agg(F.count("*"), F.max("copies")).first()

    # The flag of ranked rows is a directory level: reading one side skips the files of the other.
    # A key that repeats after an earlier rule also repeats before it, so all are found at once.
    passed_rows = passed
    for i, (repeated, keys, copies) in enumerate(side_by_side([partial(repeated_keys, i) for i in range(len(unique))])):
        if not keys:
            continue
        u, key = unique[i], list(unique[i].key)
        flagged = flag_members(passed, repeated, key, keys, f"{stage_in}/bitmap_{i}")
        # a row that is flagged and has no double is the first of its key
        marked = mark_first(flagged.filter("_listed").drop("_listed"), key, list(u.order), name="_first", copies=copies)
        ranked = materialize(
            marked.withColumn("failures", F.when(F.col("_first"), F.col("failures"))
                              .otherwise(F.array(_failure(u.code, u.message)).cast(_FAILURES)))
            .withColumn("_ok", F.col("_first")).drop("_first"), f"{stage_in}/ranked_{i}", ("_ok",))
        passed = flagged.filter("NOT _listed").drop("_listed").unionByName(ranked.filter("_ok"))
        failed = failed.unionByName(ranked.filter("NOT _ok"))
    return passed.unionByName(failed)


def accepted(evaluated: DataFrame) -> DataFrame:
    """Valid rows, without the verdict columns."""
    if "_ok" in evaluated.columns:
        evaluated = evaluated.filter("_ok")
    return evaluated.filter(F.size("failures") == 0).drop("failures", "warnings", "_ok")


def rejected(evaluated: DataFrame) -> DataFrame:
    if "_ok" in evaluated.columns:
        evaluated = evaluated.filter("NOT _ok").drop("_ok")
    return evaluated.filter(F.size("failures") > 0)


def split(df: DataFrame, rules=(), foreign=(), unique=(), stage_in: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantine); the quarantine keeps the `failures` column. With `stage_in` the rows are judged once and stored there."""
    evaluated = judge(df, rules, foreign, unique, stage_in=stage_in) if stage_in else evaluate(df, rules, foreign, unique)
    return accepted(evaluated), rejected(evaluated)


def quarantine(evaluated: DataFrame, source_file, run_id: str, quarantined_at: str) -> DataFrame:
    """One record per failure, with the raw row as JSON; `dt` is the partition column.

    `source_file` is a column or a literal path."""
    bad = rejected(evaluated)
    raw = [c for c in bad.columns if c not in ("failures", "warnings") and not c.startswith("_")]
    source = F.lit(source_file) if isinstance(source_file, str) else source_file
    return bad.select(
        F.to_json(F.struct(*raw), {"ignoreNullFields": "false"}).alias("raw_record"),
        F.explode("failures").alias("f"),
        source.alias("source_file"),
    ).select(
        "raw_record",
        F.col("f.code").alias("error_code"),
        F.col("f.message").alias("error_message"),
        "source_file",
        F.lit(run_id).alias("pipeline_run_id"),
        F.lit(quarantined_at).cast("timestamp_ntz").alias("quarantined_at"),
        F.to_date(F.lit(quarantined_at).cast("timestamp_ntz")).cast("string").alias("dt"),
    )


def recorded_key(key: str):
    """The key of a quarantined row. It is the first field of the record, as datasets begin with their key, and is then cut out without parsing the record."""
    record, start = F.col("raw_record"), f'{{"{key}":"'
    value = F.substring_index(F.substring(record, len(start) + 1, 1 << 30), '"', 1)
    plain = F.startswith(record, F.lit(start)) & ~F.contains(value, F.lit("\\"))
    return F.when(plain, value).otherwise(F.get_json_object(record, f"$.{key}"))


def reason_counts(evaluated: DataFrame, dataset: str) -> DataFrame:
    """Rows per failure reason; reasons overlap, so they may exceed the rejected rows."""
    return (evaluated.select(F.explode("failures").alias("f"))
            .groupBy(F.col("f.code").alias("reason")).agg(F.count("*").alias("rows"))
            .select(F.lit(dataset).alias("table_name"), "reason", "rows"))


def load_report(evaluated: DataFrame, dataset: str, rules=(), foreign=(), unique=()) -> DataFrame:
    """One row: table_name, rows_staged, rows_loaded, rows_rejected, rejection_reasons.

    All reasons are counted in the same pass over the rows."""
    codes = sorted({r.code for r in rules} | {f.code for f in foreign} | {u.code for u in unique} | {"NULL_REQUIRED"})
    found = F.array_union(F.transform("failures", lambda x: x["code"]), F.col("warnings"))
    has = [F.count_if(F.array_contains(found, c)).alias(c) for c in codes]
    counts = evaluated.agg(F.count("*").alias("rows_staged"),
                           F.count_if(F.size("failures") == 0).alias("rows_loaded"), *has)
    pairs = F.map_from_entries(F.filter(
        F.array(*[F.struct(F.lit(c).alias("key"), F.col(c).alias("value")) for c in codes]), lambda x: x["value"] > 0))
    return counts.select(
        F.lit(dataset).alias("table_name"), "rows_staged", "rows_loaded",
        (F.col("rows_staged") - F.col("rows_loaded")).alias("rows_rejected"),
        pairs.alias("rejection_reasons"))


def quality_report(evaluated: DataFrame, dataset: str, key: str, required: list[str],
                   foreign_codes: list[str]) -> DataFrame:
    """Rejection, duplicate, null and foreign-key pass rates in one pass, as percentages."""
    def with_code(codes):
        return F.count_if(F.exists("failures", lambda x: x["code"].isin(*codes)))

    nulls = F.sum(sum((F.col(c).isNull().cast("bigint") for c in required), F.lit(0).cast("bigint")))
    counts = evaluated.agg(
        F.count("*").alias("total_rows"),
        F.count_if(F.size("failures") > 0).alias("rejected"),
        with_code(["DUPLICATE_PK", "DUPLICATE_EMAIL", "DUPLICATE_LICENSE"]).alias("duplicates"),
        F.count_if(F.col(key).isNull()).alias("null_pks"),
        F.coalesce(nulls, F.lit(0)).alias("nulls"),
        (with_code(foreign_codes) if foreign_codes else F.lit(0).cast("bigint")).alias("orphans"),
    )
    total = F.col("total_rows")
    return counts.select(
        F.lit(dataset).alias("dataset"), "total_rows",
        percent(F.col("rejected"), total, 2).alias("rejection_rate_pct"),
        percent(F.col("duplicates"), total, 2).alias("duplicate_rate_pct"),
        percent(F.col("null_pks"), total, 2).alias("null_pk_rate_pct"),
        percent(F.col("nulls"), total * len(required), 2).alias("null_rate_pct"),
        percent(total - F.col("orphans"), total, 2).alias("fk_pass_rate_pct"))


# Metric -> (warning above, critical above); None means no such level.
THRESHOLDS = {
    "rejection_rate_pct": (5, 15),
    "duplicate_rate_pct": (0.5, 2),
    "null_pk_rate_pct": (0, None),
    "volume_drop_pct": (30, 60),
}


def alerts(metrics: DataFrame) -> DataFrame:
    """(…, metric, value) rows -> the same rows with `level` ok, warning or critical."""
    level = F.lit("ok")
    for name, (warn, critical) in THRESHOLDS.items():
        step = F.when(F.col("value") > warn, F.lit("warning")).otherwise(F.lit("ok"))
        if critical is not None:
            step = F.when(F.col("value") > critical, F.lit("critical")).otherwise(step)
        level = F.when(F.col("metric") == name, step).otherwise(level)
    return metrics.withColumn("level", level)


def rate_metrics(report: DataFrame) -> DataFrame:
    """Unpivot the rates of a quality report that have thresholds."""
    names = [n for n in THRESHOLDS if n in report.columns]
    return report.unpivot(["dataset"], names, "metric", "value")


def volume_drop(daily: DataFrame, day: str = "day", measure: str = "rides") -> DataFrame:
    """Drop of each day's volume against the mean of the 7 days before, in percent (0 if it grew)."""
    rolled = rolling_mean(daily, day, measure, 7, "rolling_avg")
    drop = percent(F.col("rolling_avg") - F.col(measure), F.col("rolling_avg"), 2)
    return rolled.select(F.col(day).cast("string").alias("dataset"), F.lit("volume_drop_pct").alias("metric"),
                         F.greatest(drop, F.lit(0).cast("decimal(18,2)")).alias("value"))


class AssertionsFailed(Exception):
    """Raised with the names and counts of the checks that failed."""


def check_counts(df: DataFrame, checks: dict[str, str]) -> DataFrame:
    """One row with, per check, the number of rows that violate it, and `row_count`."""
    return df.agg(F.count("*").alias("row_count"), *[
        F.count_if(~F.coalesce(F.expr(p), F.lit(False))).alias(name) for name, p in checks.items()])


def assert_all(df: DataFrame, checks: dict[str, str], unique: list[str] | None = None,
               not_empty: bool = True) -> dict[str, int]:
    """Evaluate all checks in one pass and raise if any row violates one. Returns the counts."""
    result = check_counts(df, checks).first().asDict()
    bad = {k: v for k, v in result.items() if k != "row_count" and v}
    if not_empty and result["row_count"] == 0:
        bad["not_empty"] = 0
    if unique:
        repeated = df.groupBy(*unique).count().filter("count > 1").count()
        if repeated:
            bad["unique(" + ",".join(unique) + ")"] = repeated
    if bad:
        raise AssertionsFailed(f"failed checks: {bad}")
    return result


def uniqueness(df: DataFrame, key: str) -> DataFrame:
    """Rows against distinct keys, through one row per key, so a repeated key costs nothing."""
    return (df.groupBy(key).agg(F.count("*").alias("n"))
            .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"), F.count(key).alias("distinct_keys")))


def key_sketches(df: DataFrame, key: str, by: list[str], lg_k: int = 12) -> DataFrame:
    """One row for each part of the data (`by`, such as a date): its rows and a sketch of its keys, to be stored with it.

    A sketch has 2 ** lg_k registers of 6 bits at most, whatever it has seen; the standard error is 1.04 / sqrt(2 ** lg_k), 1.6 % at the default."""
    return df.groupBy(*by).agg(F.count("*").alias("row_count"), F.hll_sketch_agg(key, F.lit(lg_k)).alias("sketch"))


def uniqueness_of(sketches: DataFrame, by: list[str] | None = None) -> DataFrame:
    """`uniqueness`, with an estimate of the distinct keys, from stored sketches of any parts: it costs one row a part, and the data is not read.

    Keys that several parts share count once. Opt-in: near equality of the two numbers shows that keys hardly repeat, not that none does."""
    merged = sketches.groupBy(*(by or [])).agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count"), F.hll_union_agg("sketch").alias("_all"))
    return merged.select(*(by or []), "row_count", F.coalesce(F.hll_sketch_estimate("_all"), F.lit(0)).alias("about_distinct_keys"))


def reconcile_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """Input must equal valid + rejected; stages must hold `input`, `valid` and `rejected`."""
    counted = None
    for name, df in stages.items():
        one = df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("stage"), "rows")
        counted = one if counted is None else counted.unionByName(one)
    wide = counted.agg(*[F.sum(F.when(F.col("stage") == n, F.col("rows"))).alias(n) for n in stages])
    return wide.withColumn("balanced", F.col("input") == F.col("valid") + F.col("rejected"))


def freshness(df: DataFrame, ts: str, now: str, dataset: str) -> DataFrame:
    """Newest timestamp and its age in whole hours at `now`."""
    newest = df.agg(F.max(ts).alias("newest"))
    return newest.select(F.lit(dataset).alias("dataset"), "newest",
                         hours_between("newest", F.lit(now).cast("timestamp_ntz")).alias("age_hours"))


def check_contract(df: DataFrame, schema: T.StructType) -> list[str]:
    """Differences from the declared columns, types and nullability; empty when the frame conforms.
    Null counts of all NOT NULL columns come from one aggregation."""
    problems = []
    actual = {f.name: f.dataType for f in df.schema}
    for f in schema:
        if f.name not in actual:
            problems.append(f"missing column {f.name}")
        elif actual[f.name] != f.dataType:
            problems.append(f"{f.name} is {actual[f.name].simpleString()}, expected {f.dataType.simpleString()}")
    declared = {f.name for f in schema}
    problems += [f"unexpected column {c}" for c in df.columns if c not in declared]
    required = [f.name for f in schema if not f.nullable and f.name in actual]
    if required:
        nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required]).first()
        problems += [f"{c} has {nulls[c]} nulls" for c in required if nulls[c]]
    return problems
