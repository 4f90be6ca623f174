"""The corpus pipeline: documents through five stages, each a table that the next one reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rideflow.llm import queries
from rideflow.llm.ngram_join import ngram_join
from rideflow.llm.quality_mil import keep_quality
from rideflow.llm.rank_profiles import keep_language, learn_profiles
from rideflow.sources.workdir import materialize, work_dir

LEAST_QUALITY = 0.5
LEAST_CLOSENESS = 0.2
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents more likely good than not; the model is fitted on the labels that are not held out. An empty table gives no rows; all columns stay."""
    return keep_quality(docs, queries.quality_model(spark, sf_dir), LEAST_QUALITY)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters that are close to the profile of some language. Null texts go. An empty table gives no rows; all columns stay."""
    known = learn_profiles(docs.where(~queries.held_out(F.col("doc_id"))).select("lang", "text"))
    return keep_language(docs, known, LEAST_CLOSENESS)


def _free(name: str, columns: list[str]) -> str:
    """`name`, lengthened until no column is called so."""
    while name.lower() in {c.lower() for c in columns}:
        name += "_"
    return name


def _ordered(column: str, kind: T.DataType) -> Column:
    """What tells the values of a column apart and can be sorted: a map counts by its text."""
    return F.to_json(F.struct(F.col(f"`{column}`"))) if "map<" in kind.simpleString() else F.col(f"`{column}`")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows linked by a similarity of 0.8 on five-word shingles the one with the smallest id (null last), text and other columns; of rows
    without words one of each id and text. Rows are told by a number of their own, so repeated and null ids neither link nor part them.
    Columns may have any names and types and come out as they are; an empty table gives no rows."""
    row, group = (_free(name, docs.columns) for name in ("_row", "_group"))
    numbered = materialize(docs.withColumn(row, F.monotonically_increasing_id()), work_dir(spark))
    found = ngram_join(numbered, id_col=row, size=5, percent=80)
    groups = materialize(found.select(F.col("doc_id").alias(row), "n_shingles", F.col("component_id").alias(group)), work_dir(spark))
    shared = groups.groupBy(group).agg(F.count("*").alias("n")).where("n > 1").select(group)
    members = groups.where("n_shingles > 0").join(shared, group).unionByName(groups.where("n_shingles = 0").withColumn(group, F.lit(None).cast("long")))
    others = sorted((f for f in docs.schema if f.name != "doc_id"), key=lambda f: f.name != "text")
    rows = members.select(row, group).join(numbered, row)
    wordless = F.when(F.col(group).isNull(), F.struct("doc_id", "text"))
    order = [F.col("doc_id").isNull(), F.col("doc_id"), *[_ordered(f.name, f.dataType) for f in others], F.col(row)]
    first = F.min(F.struct(*[c.alias(f"c{i}") for i, c in enumerate(order)]))[f"c{len(order) - 1}"]
    kept = rows.groupBy(group, wordless.alias(_free("_same", docs.columns))).agg(first.alias(row)).select(row)
    gone = members.select(row).join(kept, row, "left_anti")
    return numbered.join(gone, row, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, once or twice. An empty table gives no rows; all columns stay."""
    return queries.take_mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their bins. An empty table gives no rows; other columns are left out."""
    return queries.packed(docs)


STAGES = [("quality", quality), ("language", language), ("near_duplicates", near_duplicates), ("mixing", mixing), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over all documents of `sf_dir`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), work_dir(spark))
    return docs
