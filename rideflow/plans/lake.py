"""The lake pipeline: land raw files, clean them into Silver, build the Gold star schema.

Silver and Gold facts are written per ingest date, and a date is always replaced as a whole. A run
reads only the dates it is given, so daily work follows the daily volume and not the history.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import partial, reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rideflow import schemas
from rideflow.operators import gold, quality, silver
from rideflow.operators.dedupe import flag_exactly, flag_listed
from rideflow.sources import ledger
from rideflow.sources.maintenance import partition_values
from rideflow.sources.readers import DATE_PARTS, partition_date, read_bronze
from rideflow.sources.sinks import bronze_path, land_bronze, land_dates, write_date, write_dates
from rideflow.sources.workdir import materialize, side_by_side, work_dir

ENTITIES = {"customers": "customer", "drivers": "driver"}  # every landing holds the whole dataset
INCREMENTS = ("rides", "payments")                         # every landing holds new rows only


def land_all(raw: dict[str, DataFrame], root: str, run_date: str) -> dict[str, str]:
    return dict(zip(raw, side_by_side([partial(land_bronze, df, root, name, run_date) for name, df in raw.items()])))


def read_silver(spark: SparkSession, root: str, dataset: str, dates: tuple[str, str] | None = None) -> DataFrame:
    """Silver rows with their `ingest_date`; a date range prunes directories."""
    df = spark.read.option("basePath", f"{root}/silver/{dataset}").parquet(f"{root}/silver/{dataset}")
    df = df.withColumn("ingest_date", F.col("ingest_date").cast("string"))
    return df.filter(F.col("ingest_date").between(*dates)) if dates else df


def _missing(error: Exception) -> bool:
    return "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error)


def _if_present(read):
    """The result of `read()`, or None where the table does not exist yet."""
    try:
        return read()
    except AnalysisException as error:
        if _missing(error):
            return None
        raise


def _earlier_keys(spark: SparkSession, root: str, dataset: str, date: str, today: DataFrame) -> DataFrame | None:
    """Today's keys that were loaded on an earlier date. History gives one column and is reduced to
    today's keys by a semi join, which needs no shuffle of it while a day's keys can be broadcast."""
    key = today.columns[0]
    history = _if_present(lambda: read_silver(spark, root, dataset))
    if history is None:
        return None
    history = history.filter(F.col("ingest_date") < date)
    if history.isEmpty():
        return None
    return history.select(key).join(today, key, "left_semi")


def _landed(spark: SparkSession, root: str, dataset: str, date: str) -> DataFrame:
    """Raw rows of one date with the `_file` they are from; none where the dataset was never landed."""
    schema = schemas.DATASETS[dataset]
    rows = _if_present(lambda: read_bronze(spark, root, dataset, schema, (date, date))
                       .select(*schema.names, F.col("_metadata.file_path").alias("_file")))
    return spark.createDataFrame([], schemas.as_text(schema).add("_file", "string")) if rows is None else rows


def bronze_to_silver(spark: SparkSession, root: str, date: str, run_id: str, processed_at: str, salt: str,
                     precision: int = 6, datasets: tuple[str, ...] | None = None) -> dict[str, DataFrame]:
    """Process one landed date: accepted rows to Silver, the rest to the quarantine. A dataset without files of that date counts
    as empty. Dates after it depend on it; `run` and `reprocess` bring them up to date. With `datasets` only these are processed; what they refer to
    must be among them or have been processed before.

    Returns the evaluated rows per dataset (stored), for reports and reconciliation."""
    scratch = work_dir(spark)
    evaluated: dict[str, DataFrame] = {}

    def one(dataset: str) -> DataFrame:
        key = schemas.PRIMARY_KEYS[dataset]
        # listed before they are read: a file that comes later is pending
        files = _files_of(spark, root, dataset, date)
        raw = _landed(spark, root, dataset, date)
        cleaned = silver.clean(raw, dataset)
        if dataset in INCREMENTS:
            earlier = _earlier_keys(spark, root, dataset, date, raw.select(key).filter(F.col(key).isNotNull()).distinct())
            if earlier is not None:
                # Stored: usually empty or small, and then broadcast.
                seen = materialize(earlier.distinct(), f"{scratch}/{dataset}/seen").select(F.col(key).alias("_seen"))
                cleaned = quality.flag_loaded(cleaned.join(seen, F.col(key) == F.col("_seen"), "left"), key, F.col("_seen").isNotNull()).drop("_seen")
        parents = {name: read_silver(spark, root, name, ("", date)) for name in schemas.PARENTS[dataset]}
        judged = quality.judge(cleaned, quality.silver_rules(dataset), quality.foreign_keys(dataset, parents),
                               quality.unique_rules(dataset), stage_in=f"{scratch}/{dataset}")
        protected = silver.protect(quality.accepted(judged), dataset, salt, precision)
        traced = silver.with_lineage(protected, run_id, processed_at, F.col("_file")).drop("_file")
        bad = quality.quarantine(judged, F.col("_file"), run_id, processed_at).drop("dt")
        side_by_side([partial(write_date, traced, f"{root}/silver/{dataset}", date),
                      partial(bad.write.mode("overwrite").option("compression", "zstd").parquet, f"{root}/quarantine/{dataset}/dt={date}")])
        if files is not None:
            ledger.record(files, f"{root}/ledger/{dataset}")
        return judged

    for level in schemas.LEVELS:
        due = [dataset for dataset in level if datasets is None or dataset in datasets]
        evaluated.update(zip(due, side_by_side([partial(one, dataset) for dataset in due])))
    return evaluated


def silver_to_gold(spark: SparkSession, root: str, dates: tuple[str, str], facts: list[str] | None = None) -> None:
    """Bring the dimensions and their histories up to date, and rebuild the facts of `facts`, or of all ingest dates in the range. Silver before the
    first date must be what Gold was built from."""
    due = {name: [d for d in ingest_dates(spark, root, name, None if facts else dates) if facts is None or d in facts] for name in INCREMENTS}
    rides, payments = (read_silver(spark, root, name).filter(F.col("ingest_date").isin(due[name])) for name in INCREMENTS)
    scratch = work_dir(spark)

    def replace_table(name: str, build: Callable[[], DataFrame]) -> DataFrame:
        # Stored aside first: a growing dimension reads the table it replaces.
        stored = materialize(build(), f"{scratch}/{name}")
        stored.write.mode("overwrite").option("compression", "zstd").parquet(f"{root}/gold/{name}")
        return stored

    histories = {entity: f"dim_{entity}_history" for entity in ENTITIES.values()}
    versions = dict(zip(histories, side_by_side([partial(replace_table, table, partial(_history, spark, root, entity, dates[0])) for entity, table in histories.items()])))
    current = {entity: df.where("is_current").drop(f"{entity}_version", "valid_from", "valid_to", "is_current") for entity, df in versions.items()}
    dims = {
        "dim_customer": lambda: current["customer"],
        "dim_driver": lambda: current["driver"],
        "dim_location": lambda: _with_known(spark, root, "dim_location", gold.dim_location(rides)).distinct(),
        "dim_date": lambda: _calendar(spark, root, rides, payments),
    }

    def fact_rides() -> DataFrame:
        fact = gold.fact_rides(rides, "ingest_date")
        for entity in ("driver", "customer"):
            fact = gold.with_version(fact, versions[entity], entity, "request_time")
        return fact

    facts_of = {"rides": fact_rides, "payments": lambda: gold.fact_payments(payments, "ingest_date")}

    def replace_facts(name: str) -> None:
        write_dates(facts_of[name](), f"{root}/gold/fact_{name}", due[name], ("year", "month"))

    side_by_side([partial(replace_facts, name) for name in facts_of if due[name]] + [partial(replace_table, name, build) for name, build in dims.items()])


def _history(spark: SparkSession, root: str, entity: str, first: str) -> DataFrame:
    """Versions of a dimension. Those that begin before `first` are read from Gold and stand for the snapshots they came from; only
    snapshots from `first` on are read, or all of them where Gold has no history yet."""
    dataset, build = {"customer": ("customers", gold.dim_customer), "driver": ("drivers", gold.dim_driver)}[entity]
    known = _if_present(lambda: read_gold(spark, root, f"dim_{entity}_history"))
    snapshots = build(read_silver(spark, root, dataset, None if known is None else (first, "9999-12-31")), "ingest_date")
    if known is not None:
        earlier = known.where(F.col("valid_from") < F.lit(first).cast("date")).withColumn("ingest_date", F.col("valid_from").cast("string"))
        snapshots = snapshots.unionByName(earlier.select(*snapshots.columns))
    return gold.dim_history(snapshots, entity, "ingest_date")


def _with_known(spark: SparkSession, root: str, table: str, new: DataFrame) -> DataFrame:
    """`new` and what the Gold table holds already."""
    known = _if_present(lambda: read_gold(spark, root, table))
    return new if known is None else new.unionByName(known.select(*new.columns))


def _calendar(spark: SparkSession, root: str, rides: DataFrame, payments: DataFrame) -> DataFrame:
    spans = [(rides, "request_time"), (payments, "payment_time")]
    known = _if_present(lambda: read_gold(spark, root, "dim_date"))
    if known is not None:
        spans.append((known, "full_date"))
    return gold.dim_date_of(*spans)


def ingest_dates(spark: SparkSession, root: str, dataset: str, dates: tuple[str, str] | None = None) -> list[str]:
    """Ingest dates of a Silver table, from its directory names: one short value per daily run."""
    found = _if_present(lambda: partition_values(spark, f"{root}/silver/{dataset}", ["ingest_date"]))
    every = sorted(r[0] for r in found.collect()) if found is not None else []
    return [d for d in every if dates is None or dates[0] <= d <= dates[1]]


def read_gold(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A dimension, or a fact; facts prune on year and month."""
    return spark.read.parquet(f"{root}/gold/{table}")


def gold_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    names = ("dim_customer", "dim_driver", "dim_customer_history", "dim_driver_history", "dim_location", "dim_date", "fact_rides", "fact_payments")
    return {n: read_gold(spark, root, n) for n in names}


def landed_files(spark: SparkSession, root: str, dataset: str) -> DataFrame | None:
    """The Bronze files of a dataset with the date they were landed for; None where it was never landed."""
    files = _if_present(lambda: ledger.list_files(spark, f"{root}/bronze/{dataset}"))
    if files is None:
        return None
    return files.withColumn("ingest_date", F.concat_ws("-", *[F.regexp_extract("file", f"/{part}=([^/]+)/", 1) for part in DATE_PARTS]))


def _files_of(spark: SparkSession, root: str, dataset: str, date: str) -> DataFrame | None:
    """The Bronze files of one date as they are now, stored aside as an entry of the ledger. Only the folder of the date is listed."""
    files = _if_present(lambda: ledger.list_files(spark, bronze_path(root, dataset, date)))
    return None if files is None else materialize(files.withColumn("entry", F.lit(date)), f"{work_dir(spark)}/{dataset}")


def pending_dates(spark: SparkSession, root: str) -> list[str]:
    """Dates whose Bronze files are not exactly those that Silver was built from, oldest first. They are told by the ledger of files, so neither the
    clocks of the writers nor equal times matter; no Bronze file is opened."""
    return sorted(set().union(*_pending(spark, root).values()))


def _pending(spark: SparkSession, root: str) -> dict[str, set[str]]:
    """The pending dates of each dataset."""
    def of(dataset: str) -> set[str]:
        files = landed_files(spark, root, dataset)
        if files is None:
            return set()
        done = ledger.read_ledger(spark, f"{root}/ledger/{dataset}").withColumnRenamed("entry", "ingest_date")
        return {r[0] for r in ledger.changed_groups(files, done, "ingest_date").collect()}

    return dict(zip(schemas.DATASETS, side_by_side([partial(of, dataset) for dataset in schemas.DATASETS])))


def run(spark: SparkSession, root: str, run_id: str, processed_at: str, salt: str) -> list[str]:
    """Process every pending date, bring the dates after it up to date, then build Gold for what changed. Returns the dates."""
    pending = pending_dates(spark, root)
    return _rebuild(spark, root, pending, run_id, processed_at, salt)[1] if pending else []


def _rebuild(spark: SparkSession, root: str, dates: list[str], run_id: str, processed_at: str, salt: str,
             datasets: tuple[str, ...] | None = None) -> tuple[dict[str, dict[str, DataFrame]], list[str]]:
    """Process `dates` (ascending; with `datasets` only these, as the others are what they were), then those rows of later dates that depend on a key they changed, and refresh Gold.

    A date's rows depend on the dates before it: on keys loaded there and on parents accepted there. So the result is that of
    processing in order, however late a date comes; a backfill costs its own rows and those that its changes reach. Dates whose Bronze
    files are gone stay as they are. Returns the evaluated rows of `dates`, and all dates that were written."""
    evaluated, written = {}, set(dates)
    for i, date in enumerate(dates):
        later = {name: [d for d in ingest_dates(spark, root, name) if d > date and d not in dates[i + 1:]] for name in INCREMENTS}
        before = {}
        if any(later.values()):
            before = dict(zip(schemas.DATASETS, side_by_side([partial(_accepted_keys, spark, root, name, date) for name in schemas.DATASETS])))
        evaluated[date] = bronze_to_silver(spark, root, date, run_id, processed_at, salt, datasets=datasets)
        if before:
            written |= _carry_forward(spark, root, date, later, before, run_id, processed_at, salt)
    silver_to_gold(spark, root, (dates[0], "9999-12-31"), sorted(written))
    return evaluated, sorted(written)


def _accepted_keys(spark: SparkSession, root: str, dataset: str, date: str) -> DataFrame:
    """The keys that Silver holds for a date, stored aside, as the date is about to be replaced."""
    key = schemas.PRIMARY_KEYS[dataset]
    held = _if_present(lambda: read_silver(spark, root, dataset, (date, date)).select(key))
    held = spark.createDataFrame([], f"{key} string") if held is None else held
    return materialize(held, f"{work_dir(spark)}/{dataset}")


def _changed(spark: SparkSession, root: str, dataset: str, date: str, before: DataFrame) -> DataFrame:
    """Keys accepted on `date` only before or only after it was processed, with the date `_until` from which another date accepts them
    anyhow (NULL: none does). Keys that an earlier date accepts changed nothing."""
    key = schemas.PRIMARY_KEYS[dataset]
    held = read_silver(spark, root, dataset)
    now = held.filter(F.col("ingest_date") == date).select(key)
    differs = before.select(key, F.lit(1).alias("_old")).unionByName(now.select(key, F.lit(-1).alias("_old"))).groupBy(key).agg(F.sum("_old").alias("_d"))
    differs = materialize(differs.filter("_d <> 0").select(key), f"{work_dir(spark)}/{dataset}")
    others = (held.filter(F.col("ingest_date") != date).select(key, "ingest_date").join(differs, key, "left_semi")
              .groupBy(key).agg(F.min("ingest_date").alias("_until")))
    return materialize(differs.join(others, key, "left").filter(F.col("_until").isNull() | (F.col("_until") > date)), f"{work_dir(spark)}/{dataset}")


def _carry_forward(spark: SparkSession, root: str, date: str, later: dict[str, list[str]], before: dict[str, DataFrame], run_id: str, processed_at: str,
                   salt: str) -> set[str]:
    """Judge again, in one job a dataset, the rows of `later` dates that the changes of `date` reach through their own key or a foreign one, and
    replace the dates that hold them. Dates that are still pending are not among these; their turn comes. Returns the dates."""
    changed = dict(zip(before, side_by_side([partial(_changed, spark, root, name, date, keys) for name, keys in before.items()])))
    touched: set[str] = set()
    for dataset, references in (("rides", {"customer_id": "customers", "driver_id": "drivers"}), ("payments", {"customer_id": "customers", "ride_id": "rides"})):
        schema, key, scratch = schemas.DATASETS[dataset], schemas.PRIMARY_KEYS[dataset], work_dir(spark)
        landed = _if_present(lambda: read_bronze(spark, root, dataset, schema).filter(partition_date().isin(later[dataset]))
                             .select(*schema.names, F.col("_metadata.file_path").alias("_file"), partition_date().alias("_date")))
        if landed is None or not later[dataset]:
            continue
        if all(changed[name].isEmpty() for name in (dataset, *references.values())):
            continue
        # Bronze is read twice: for the keys of all later dates, and for the rows that are judged again
        known = materialize(landed.select(key, *references, "_date"), f"{scratch}/landed")
        named = known.join(changed[dataset].select(F.col(key).alias("_own")), F.col(key) == F.col("_own"), "left")
        hit = F.col("_own").isNotNull()
        for column, parent in references.items():
            found = changed[parent].select(F.col(schemas.PRIMARY_KEYS[parent]).alias(f"_of_{column}"), F.col("_until").alias(f"_until_{column}"))
            in_time = F.col(f"_until_{column}").isNull() | (F.col("_date") < F.col(f"_until_{column}"))
            named = named.join(found, (F.col(column) == F.col(f"_of_{column}")) & in_time, "left")
            hit = hit | F.col(f"_of_{column}").isNotNull()
        reached = materialize(named.select(key, "_date", hit.alias("_hit")), f"{scratch}/reached")
        keys = reached.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.max("_hit").alias("_in"))
        keys = materialize(keys, f"{scratch}/keys")
        listed = keys.filter("_in").select("_key")
        touching = flag_exactly(reached, key, keys, f"{scratch}/dates").filter("_hit OR _listed")
        dates = {r[0] for r in touching.select("_date").distinct().collect()}
        if not dates:
            continue
        # rows without a key pass no rule and have no key to be found by: those of a touched date are judged again
        in_dates = landed.filter(F.col("_date").isin(sorted(dates)))
        affected = flag_exactly(in_dates, key, keys, f"{scratch}/affected").filter(F.col("_listed") | F.col(key).isNull()).drop("_listed")
        parents = {name: read_silver(spark, root, name) for name in ("customers", "drivers", "rides") if name != dataset}
        foreign = [replace(fk, since="ingest_date") for fk in quality.foreign_keys(dataset, parents)]
        held = read_silver(spark, root, dataset)
        loaded = held.filter(~F.col("ingest_date").isin(sorted(dates))).select(F.col(key), F.col("ingest_date").alias("_date"))
        loaded = loaded.join(listed, F.col(key) == F.col("_key"), "left_semi")
        (unique,) = quality.unique_rules(dataset)
        judged = quality.evaluate_over_dates(silver.clean(affected, dataset), quality.silver_rules(dataset), foreign, unique, loaded, scratch)
        protected = silver.protect(quality.accepted(judged), dataset, salt)
        traced = silver.with_lineage(protected, run_id, processed_at, F.col("_file")).drop("_file").withColumnRenamed("_date", "ingest_date")
        kept = flag_listed(held.filter(F.col("ingest_date").isin(sorted(dates))), key, listed, f"{scratch}/held").filter("NOT _listed").drop("_listed")
        stored = spark.read.option("basePath", f"{root}/quarantine/{dataset}").parquet(f"{root}/quarantine/{dataset}")
        stored = stored.withColumn("dt", F.col("dt").cast("string")).filter(F.col("dt").isin(sorted(dates)))
        recorded = stored.withColumn("_key", quality.recorded_key(key)).filter("_key IS NOT NULL")
        good = flag_listed(recorded, "_key", listed, f"{scratch}/recorded").filter("NOT _listed").select(*stored.columns)
        bad = quality.quarantine(judged, F.struct("_file", "_date"), run_id, processed_at).drop("dt")
        bad = bad.withColumn("dt", F.col("source_file._date")).withColumn("source_file", F.col("source_file._file"))
        # Kept rows are read from the dates that are replaced; a date is replaced only when all rows are written, and no row is stored aside before.
        side_by_side([partial(write_dates, kept.unionByName(traced.select(*kept.columns)), f"{root}/silver/{dataset}", sorted(dates)),
                      partial(write_dates, good.unionByName(bad.select(*stored.columns)), f"{root}/quarantine/{dataset}", sorted(dates), (), "dt")])
        if dataset == "rides":  # payments refer to what these rides were and are
            reached_rides = changed["rides"].select("ride_id").union(listed).distinct()
            changed["rides"] = materialize(reached_rides, f"{scratch}/changed").withColumn("_until", F.lit(None).cast("string"))
        touched |= dates
    return touched


def reprocess(spark: SparkSession, root: str, dataset: str, fixed: DataFrame, date: str, run_id: str,
              processed_at: str, salt: str) -> dict[str, DataFrame]:
    """Put corrected rows back into the Bronze partition of `date`, rebuild of that date the dataset and what depends on it, and refresh Gold. Datasets of
    which the date is pending are processed too; the others are what they were.

    Returns the evaluated rows of `date`. Corrected rows replace landed rows with the same key."""
    schema = schemas.DATASETS[dataset]
    key = schemas.PRIMARY_KEYS[dataset]
    due = {dataset} | {name for name, dates in _pending(spark, root).items() if date in dates}
    for name, parents in schemas.PARENTS.items():  # parents come before children
        if due & set(parents):
            due.add(name)
    landed = read_bronze(spark, root, dataset, schema, (date, date))
    year, month, day = date.split("-")
    fixed = fixed.select(*[F.col(c).cast("string").alias(c) for c in schema.names], *[F.lit(v).alias(c) for c, v in zip(DATE_PARTS, (year, month, day))])
    kept = landed.join(fixed.select(key).distinct(), key, "left_anti").select(*fixed.columns)
    land_dates(kept.unionByName(fixed), root, dataset, [date])
    return _rebuild(spark, root, [date], run_id, processed_at, salt, tuple(name for name in schemas.DATASETS if name in due))[0][date]


def erase_subjects(spark: SparkSession, root: str, subjects: DataFrame) -> dict[str, list[str]]:
    """Remove the given customers (`customer_id`) from Bronze, Silver, quarantine and Gold.

    Each layer of each dataset is searched by itself, so rows are found whose other layers are gone. The dates that hold a subject are rewritten in one
    job a layer and dataset, however many they are, without storing their rows aside. Returns these dates per dataset."""
    scratch = work_dir(spark)
    pending = set(pending_dates(spark, root))
    ids = materialize(subjects.select("customer_id").filter("customer_id IS NOT NULL").distinct(), f"{scratch}/subjects")

    def rewrite(read, key: Column, date: Column, write) -> list[str]:
        rows = _if_present(read)
        if rows is None:
            return []
        named = rows.withColumn("_subject", key)
        one = ids.withColumnRenamed("customer_id", "_id")
        hit = sorted(r[0] for r in named.join(one, F.col("_subject") == F.col("_id"), "left_semi").select(date.cast("string")).distinct().collect())
        if hit:
            kept = named.filter(date.cast("string").isin(hit)).join(one, F.col("_subject") == F.col("_id"), "left_anti").select(*rows.columns)
            write(kept, hit)
        return hit

    def jobs(dataset: str) -> list:
        schema = schemas.DATASETS[dataset]
        bad = f"{root}/quarantine/{dataset}"
        day = F.col("dt").cast("string")
        return [
            partial(rewrite, lambda: read_bronze(spark, root, dataset, schema), F.col("customer_id"), partition_date(),
                    lambda rows, dates: land_dates(rows, root, dataset, dates)),
            partial(rewrite, lambda: read_silver(spark, root, dataset), F.col("customer_id"), F.col("ingest_date"),
                    lambda rows, dates: write_dates(rows, f"{root}/silver/{dataset}", dates)),
            partial(rewrite, lambda: spark.read.option("basePath", bad).parquet(bad).withColumn("dt", day), quality.recorded_key("customer_id"), day,
                    lambda rows, dates: write_dates(rows, bad, dates, (), "dt"))]

    datasets = ("customers", "rides", "payments")
    found = side_by_side([job for dataset in datasets for job in jobs(dataset)])
    touched = {name: sorted({d for some in found[3 * i:3 * i + 3] for d in some}) for i, name in enumerate(datasets)}
    every = sorted({d for dates in touched.values() for d in dates})
    # the new files hold nothing that Silver lacks; dates that were pending before stay so
    side_by_side([partial(_record_again, spark, root, name, [d for d in found[3 * i] if d not in pending]) for i, name in enumerate(datasets)])
    if every:
        silver_to_gold(spark, root, (every[0], "9999-12-31"), every)
    return touched


def _record_again(spark: SparkSession, root: str, dataset: str, dates: list[str]) -> None:
    """Write down the files of `dates` as they are now."""
    if dates:
        files = landed_files(spark, root, dataset).filter(F.col("ingest_date").isin(dates))
        ledger.record(files.withColumnRenamed("ingest_date", "entry"), f"{root}/ledger/{dataset}")


def row_totals(evaluated: dict[str, DataFrame]) -> DataFrame:
    """Per dataset: input = valid + rejected."""
    parts = []
    for name, df in evaluated.items():
        one = df.agg(F.count("*").alias("input"),
                     F.count_if(F.size("failures") == 0).alias("valid"),
                     F.count_if(F.size("failures") > 0).alias("rejected"))
        parts.append(one.select(F.lit(name).alias("dataset"), "input", "valid", "rejected",
                                (F.col("input") == F.col("valid") + F.col("rejected")).alias("balanced")))
    return reduce(DataFrame.unionByName, parts)


POST_SILVER_CHECKS = {
    "no_negative_fare": "fare > 0",
    "no_null_key": "ride_id IS NOT NULL",
    "no_negative_distance": "distance_km >= 0",
}

POST_GOLD_CHECKS = {
    "fact_rides": {"customer_key": "customer_key IS NOT NULL", "driver_key": "driver_key IS NOT NULL",
                   "location_key": "location_key IS NOT NULL", "date_key": "date_key IS NOT NULL",
                   "driver_version": "driver_version IS NOT NULL", "customer_version": "customer_version IS NOT NULL"},
    "dim_customer": {"no_raw_email": "customer_name NOT LIKE '%@%'"},
}


def check_silver(spark: SparkSession, root: str) -> dict[str, int]:
    return quality.assert_all(read_silver(spark, root, "rides"), POST_SILVER_CHECKS, unique=["ride_id"])


def check_gold(spark: SparkSession, root: str) -> None:
    """Null keys, raw e-mail addresses and fact keys without a dimension row all raise."""
    tables = gold_tables(spark, root)
    for name, checks in POST_GOLD_CHECKS.items():
        quality.assert_all(tables[name], checks)
    bad = foreign_keys(tables, tables).filter("missing_keys > 0").collect()
    if bad:
        raise quality.AssertionsFailed(f"fact keys without a dimension row: {bad}")


# Every key of every fact: the table it points to, and that table's key.
FOREIGN_KEYS = {
    "fact_rides": {"customer_key": ("dim_customer", "customer_key"), "driver_key": ("dim_driver", "driver_key"),
                   "location_key": ("dim_location", "location_key"), "dropoff_location_key": ("dim_location", "location_key"),
                   "date_key": ("dim_date", "date_key"), "customer_version": ("dim_customer_history", "customer_version"),
                   "driver_version": ("dim_driver_history", "driver_version")},
    "fact_payments": {"customer_key": ("dim_customer", "customer_key"), "ride_key": ("fact_rides", "ride_key"), "date_key": ("dim_date", "date_key")},
}


def foreign_keys(facts: dict[str, DataFrame], tables: dict[str, DataFrame]) -> DataFrame:
    """fact, key_name, missing_keys, fact_rows: what every fact key lacks in the table it points to."""
    parts = [gold.fk_violations(facts[fact], {key: tables[table].select(F.col(target).alias(key)) for key, (table, target) in keys.items()})
             .select(F.lit(fact).alias("fact"), "*") for fact, keys in FOREIGN_KEYS.items()]
    return reduce(DataFrame.unionByName, parts)
