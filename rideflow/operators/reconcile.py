"""Rides against payments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def reconcile_payments(rides: DataFrame, payments: DataFrame, key: str = "ride_id") -> DataFrame:
    """One row per ride key with `finding`: ok, missing_payment, missing_ride or amount_mismatch.

    A full outer join cannot split a hot key, so both sides are combined to one row per key first.
    Only completed rides need a payment, and only completed payments are compared.
    """
    r = (rides.groupBy(key)
         .agg(F.min("fare").alias("fare"), F.max((F.col("ride_status") == "completed").cast("int")).alias("_completed")))
    p = (payments.groupBy(key)
         .agg(F.count("*").alias("payments"),
              F.sum(F.when(F.col("payment_status") == "completed", F.col("amount"))).alias("paid")))
    joined = r.withColumn("_ride", F.lit(True)).join(p, key, "full_outer")
    finding = (F.when(F.col("_ride").isNull(), "missing_ride")
               .when((F.col("_completed") == 1) & F.col("payments").isNull(), "missing_payment")
               .when((F.col("_completed") == 1) & F.col("paid").isNotNull() & (F.col("paid") != F.col("fare")),
                     "amount_mismatch")
               .otherwise("ok"))
    return joined.select(key, "fare", "paid", "payments", finding.alias("finding"))


def orphans(children: DataFrame, column: str, parents: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose non-null key has no parent row."""
    ids = parents.select(F.col(parent_column).alias("_parent"))
    return (children.filter(F.col(column).isNotNull())
            .join(ids, F.col(column) == F.col("_parent"), "left_anti"))


def orphan_keys(children: DataFrame, column: str, parents: DataFrame, parent_column: str) -> DataFrame:
    """Distinct orphan keys with their row counts. Children are combined by key before the join, so
    the join moves one row per key and cannot be skewed by a busy one."""
    keys = children.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("rows"))
    ids = parents.select(F.col(parent_column).alias("_parent"))
    return keys.join(ids, F.col(column) == F.col("_parent"), "left_anti")
