"""Readers for raw files and for the partitioned lake."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rideflow.schemas import as_text

DATE_PARTS = ("year", "month", "day")

# An empty field is NULL only when it is not quoted. The null text is one that files cannot hold, so
# that a quoted empty string stays an empty string. A quote inside quotes is doubled; a backslash is
# a character like others.
CSV_OPTIONS = {"header": True, "nullValue": "\u0000", "emptyValue": "", "escape": '"'}


def staging_schema(schema: T.StructType) -> T.StructType:
    """Declared types without constraints; booleans stay text, as in the source files."""
    return T.StructType([
        T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.BooleanType) else f.dataType, True, f.metadata)
        for f in schema])


def read_raw(spark: SparkSession, path: str, schema: T.StructType, lenient: bool = False, line_breaks: bool = False) -> DataFrame:
    """CSV with a header, columns by position, empty unquoted fields as NULL.

    Strict: one bad value fails the read, also in a column the query does not use.
    Lenient: every column is text, so malformed rows can be cast, judged and quarantined.
    `line_breaks`: quoted values may hold line breaks. Such a file cannot be split here, so each is one task; `read_csv_splits` can."""
    reader = spark.read.options(**CSV_OPTIONS, multiLine=line_breaks)
    if lenient:
        return reader.schema(as_text(schema)).csv(path)
    rows = reader.schema(staging_schema(schema)).option("mode", "FAILFAST").csv(path)
    # Always true, but it makes the scan parse every column whatever is selected later.
    return rows.filter(F.xxhash64(*rows.columns) % 1 == 0)


def read_json(spark: SparkSession, path: str, schema: T.StructType, array: bool = True) -> DataFrame:
    """JSON records. A file that holds one array cannot be split, so each such file is one task;
    pass `array=False` for JSON lines, which can."""
    return spark.read.schema(staging_schema(schema)).option("multiLine", array).json(path)


def read_json_splits(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON objects of arrays or lines, files of any size read in splits. The result of `read_json`, but for the order of rows.

    Files are read as pieces up to each closing brace. Whether a piece begins in a string is the parity of the quotes before it, and how deep in
    objects it begins is a sum over the pieces before it; both are summed within a split and carried from split to split as one row each. A
    piece that is a whole object is parsed as it is; only the others are brought together, so at most one object is held at a time."""
    pieces = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_n"), "value")
    plain = F.regexp_replace("value", r"(?s)\\.", "")  # no escape reaches over a closing brace
    counted = pieces.withColumn("_plain", plain).withColumn("_quotes", F.length("_plain") - F.length(F.translate("_plain", '"', "")))
    quoted = _running(counted, "_quotes", "_before")
    opened = F.col("_before") % 2 == 1
    outside = F.regexp_replace(F.concat(F.when(opened, '"').otherwise(""), "_plain"), r'"[^"]*("|$)', "")
    closes = ((F.col("_before") + F.col("_quotes")) % 2 == 0).cast("int")
    deep = quoted.withColumn("_depth", F.length(outside) - F.length(F.translate(outside, "{", "")) - closes)
    placed = _running(deep.drop("_plain", "_quotes", "_before"), "_depth", "_level")
    after = F.col("_level") + F.col("_depth")
    # what lies between two objects belongs to the second one
    text = F.when(F.col("_level") == 0, F.regexp_replace("value", r"^[\s,\[\x{FEFF}]+", "")).otherwise(F.col("value"))
    placed = placed.withColumn("_text", F.concat(text, F.lit("}"))).withColumn("_whole", (F.col("_level") == 0) & (after == 0))
    whole = placed.where("_whole AND _text LIKE '{%'").select("_text")
    # the number of objects begun up to a piece tells those of one object from the others
    parts = placed.where("NOT _whole AND NOT (_level = 0 AND _depth < 0)").withColumn("_begun", (F.col("_level") == 0).cast("int"))
    numbered = _running(parts, "_begun", "_ahead").withColumn("_object", F.col("_ahead") + F.col("_begun"))
    joined = numbered.groupBy("_file", "_object").agg(F.array_sort(F.collect_list(F.struct("_block", "_n", "_text"))).alias("_parts"))
    objects = whole.unionByName(joined.select(F.array_join("_parts._text", "").alias("_text")))
    return objects.select(F.from_json("_text", staging_schema(schema)).alias("_row")).select("_row.*")


def _running(pieces: DataFrame, value: str, name: str) -> DataFrame:
    """`pieces` with the sum of `value` over all pieces before each in its file: one row a split is carried, and a window is one split."""
    splits = pieces.groupBy("_file", "_block").agg(F.sum(value).alias("_sum"))
    ahead = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = splits.select("_file", "_block", F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_carried"))
    within = Window.partitionBy("_file", "_block").orderBy("_n").rowsBetween(Window.unboundedPreceding, -1)
    summed = pieces.withColumn(name, F.coalesce(F.sum(value).over(within), F.lit(0)))
    return summed.join(carried, ["_file", "_block"]).withColumn(name, F.col(name) + F.col("_carried")).drop("_carried")


def read_csv_splits(spark: SparkSession, path: str, schema: T.StructType, lenient: bool = False) -> DataFrame:
    """`read_raw` with quoted line breaks, for files of any size: each is read in splits. Rows come in any order.

    Lines are read in splits; a record ends at a line break with an even number of quotes before it in the file. The quotes are summed a split
    and carried from split to split as one row each. A split that begins outside quotes and has no line with an odd number of them holds whole
    records, which are parsed where they were read; only the other splits are exchanged, and only lines of one record are brought together.
    Every file has a header, its first line that is not blank; blank lines between records are left out. Lines end at \\n or \\r\\n. A quote
    belongs to a quoted value, where it is doubled; a file with an odd number of quotes fails the read instead of becoming one record."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_n"), "value")
    counted = lines.withColumn("_odd", (F.length("value") - F.length(F.translate("value", '"', ""))) % 2)
    filled = F.trim(F.regexp_replace("value", r"[\r\x{FEFF}]", "")) != ""
    splits = counted.groupBy("_file", "_block").agg(F.sum("_odd").alias("_odds"), F.min(F.when(filled, F.col("_n"))).alias("_least"))
    whole = Window.partitionBy("_file")
    ahead = whole.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    paired = F.when(F.sum("_odds").over(whole) % 2 == 0, F.coalesce(F.sum("_odds").over(ahead), F.lit(0)) % 2).otherwise(
        F.raise_error(F.concat(F.lit("quotes do not pair in "), "_file")).cast("long"))
    first = F.first("_least", ignorenulls=True).over(whole.orderBy("_block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    splits = splits.select("_file", "_block", "_odds", paired.alias("_carried"), first.alias("_header"))
    quiet = F.expr("_odds = 0 AND _carried = 0")

    def record(value: str | Column, wanted: Column) -> Column:
        # no filter: the parser could be moved before it and fail on a header
        return F.when(wanted, F.regexp_replace(value, r"\r$", "")).alias("value")

    # a split that lies within quotes as a whole is not quiet, and its lines are part of a record
    at_once = counted.join(splits.where(quiet), ["_file", "_block"]).select(record("value", filled & (F.col("_n") != F.col("_header"))))
    others = counted.join(splits.where(~quiet), ["_file", "_block"])
    within = Window.partitionBy("_file", "_block").orderBy("_n").rowsBetween(Window.unboundedPreceding, -1)
    opened = (F.col("_carried") + F.coalesce(F.sum("_odd").over(within), F.lit(0))) % 2 == 1
    others = others.withColumn("_inside", opened).withColumn("_ends", F.col("_inside") == (F.col("_odd") == 1)).where(F.col("_inside") | filled)
    single = others.where("NOT _inside AND _ends").select(record("value", F.col("_n") != F.col("_header")))
    # the number of records begun up to a line tells those of one record from the others
    parts = others.where("_inside OR NOT _ends").withColumn("_begun", (~F.col("_inside")).cast("int")).drop("_carried")
    numbered = _running(parts, "_begun", "_ahead").withColumn("_record", F.col("_ahead") + F.col("_begun"))
    joined = numbered.groupBy("_file", "_record").agg(F.array_sort(F.collect_list(F.struct("_block", "_n", "value"))).alias("_lines"),
                                                      F.max(F.col("_n") == F.col("_header")).alias("_is_header"))
    records = at_once.unionByName(single).unionByName(joined.select(record(F.array_join("_lines.value", "\n"), ~F.col("_is_header"))))
    kind = as_text(schema) if lenient else staging_schema(schema)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kind)
    options = {k: str(v) for k, v in CSV_OPTIONS.items() if k != "header"} | {"multiLine": "true", "mode": "PERMISSIVE" if lenient else "FAILFAST"}
    rows = records.select(F.from_csv("value", ddl, options).alias("_row")).where("_row IS NOT NULL").select("_row.*")
    # as in read_raw, every column is parsed whatever is selected later
    return rows if lenient else rows.filter(F.xxhash64(*rows.columns) % 1 == 0)


def partition_date() -> Column:
    """ISO date of the Bronze partition columns, which are zero-padded text."""
    return F.concat_ws("-", *DATE_PARTS)


def in_date_range(first: str, last: str) -> Column:
    """Uses partition columns only, so it prunes directories before any file is opened."""
    return partition_date().between(first, last)


def read_layer(spark: SparkSession, root: str, layer: str, dataset: str, schema: T.StructType,
               date_range: tuple[str, str] | None = None, fmt: str = "csv") -> DataFrame:
    """Read `{root}/{layer}/{dataset}/year=/month=/day=`; partition values stay text ('06', not 6)."""
    full = T.StructType(list(schema) + [T.StructField(p, T.StringType()) for p in DATE_PARTS])
    reader = spark.read.schema(full)
    if fmt == "csv":
        reader = reader.options(**CSV_OPTIONS)
    df = reader.format(fmt).load(f"{root}/{layer}/{dataset}")
    return df.filter(in_date_range(*date_range)) if date_range else df


def read_bronze(spark: SparkSession, root: str, dataset: str, schema: T.StructType,
                date_range: tuple[str, str] | None = None) -> DataFrame:
    """Bronze rows as text."""
    return read_layer(spark, root, "bronze", dataset, as_text(schema), date_range)
