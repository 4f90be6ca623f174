"""The ten business queries. Each takes the dataset dictionary and returns a DataFrame.

Joins to drivers or customers happen after the rides are aggregated by the join key, so a busy
driver's rides are combined before the shuffle and only one partial row per key and task moves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rideflow.functions.numeric import highest, lowest, mean, percent, ratio, total
from rideflow.functions.text import full_name
from rideflow.operators.ranking import share_of_total
from rideflow.operators.stats import mark_middle, median_of, value_counts

Tables = dict[str, DataFrame]


def _status_is(value: str, column: str = "ride_status"):
    return F.count_if(F.col(column) == value)


def q01(t: Tables) -> DataFrame:
    """Rides per city."""
    return (t["rides"].groupBy("pickup_city")
            .agg(F.count("*").alias("total_rides"),
                 _status_is("completed").alias("completed"),
                 _status_is("cancelled").alias("cancelled"))
            .orderBy(F.desc("total_rides"), "pickup_city"))


def q02(t: Tables) -> DataFrame:
    """Fare by ride status."""
    return (t["rides"].groupBy("ride_status")
            .agg(F.count("*").alias("ride_count"),
                 mean("fare").alias("avg_fare"),
                 lowest("fare").alias("min_fare"),
                 highest("fare").alias("max_fare"))
            .orderBy(F.desc("ride_count"), "ride_status"))


def q03(t: Tables) -> DataFrame:
    """Peak demand hours."""
    return (t["rides"].groupBy(F.hour("request_time").alias("hour_of_day"))
            .agg(F.count("*").alias("total_rides"),
                 mean("fare").alias("avg_fare"),
                 mean("surge_multiplier").alias("avg_surge"))
            .orderBy("hour_of_day"))


def q04(t: Tables) -> DataFrame:
    """Revenue by payment method, completed payments only, with the share of transactions."""
    by_method = (t["payments"].filter(F.col("payment_status") == "completed")
                 .groupBy("payment_method")
                 .agg(F.count("*").alias("total_txns"),
                      total("amount").alias("total_revenue"),
                      mean("amount").alias("avg_amount"),
                      total("tip_amount").alias("total_tips")))
    return (share_of_total(by_method, "total_txns", "pct_of_total")
            .orderBy(F.desc_nulls_first("total_revenue"), "payment_method"))


def q05(t: Tables) -> DataFrame:
    """Top 10 drivers by completed rides; ties go to the lower driver id."""
    per_driver = (t["rides"].filter(F.col("ride_status") == "completed")
                  .groupBy("driver_id")
                  .agg(F.count("ride_id").alias("rides"), F.sum("fare").alias("earned")))
    attributes = ["driver_id", "driver_name", "vehicle_type", "city", "rating"]
    return (t["drivers"].withColumn("driver_name", full_name())
            .join(per_driver, "driver_id")
            .groupBy(*attributes)
            .agg(F.sum("rides").alias("completed_rides"), total("earned").alias("total_earnings"))
            .orderBy(F.desc("completed_rides"), "driver_id")
            .limit(10))


def q06(t: Tables) -> DataFrame:
    """Cancellation rate by city."""
    return (t["rides"].groupBy("pickup_city")
            .agg(F.count("*").alias("total_rides"), _status_is("cancelled").alias("cancellations"))
            .withColumn("cancellation_rate_pct", percent(F.col("cancellations"), F.col("total_rides")))
            .orderBy(F.desc("cancellation_rate_pct"), "pickup_city"))


def q07(t: Tables) -> DataFrame:
    """Monthly ride trend."""
    return (t["rides"].groupBy(F.trunc(F.to_date("request_time"), "month").alias("month"))
            .agg(F.count("*").alias("total_rides"),
                 _status_is("completed").alias("completed"),
                 total("fare").alias("total_revenue"))
            .orderBy("month"))


def q08(t: Tables) -> DataFrame:
    """Distance statistics with the exact median, completed rides with a positive distance."""
    rides = t["rides"].filter((F.col("ride_status") == "completed") & (F.col("distance_km") > 0))
    counts = mark_middle(value_counts(rides, ["pickup_city"], "distance_km"), ["pickup_city"], "distance_km")
    return (counts.groupBy("pickup_city")
            .agg(F.sum("n").alias("completed_rides"),
                 ratio(F.sum(F.col("distance_km") * F.col("n")), F.sum("n")).alias("avg_distance_km"),
                 lowest("distance_km").alias("min_distance_km"),
                 highest("distance_km").alias("max_distance_km"),
                 median_of("distance_km").alias("median_distance_km"))
            .orderBy(F.desc("avg_distance_km"), "pickup_city"))


def q09(t: Tables) -> DataFrame:
    """Top 10 customers by rides; spending covers every status. Ties go to the lower customer id."""
    per_customer = (t["rides"].groupBy("customer_id")
                    .agg(F.count("ride_id").alias("rides"),
                         _status_is("completed").alias("completed"),
                         F.sum("fare").alias("spent")))
    attributes = ["customer_id", "customer_name", "city", "is_active"]
    return (t["customers"].withColumn("customer_name", full_name())
            .join(per_customer, "customer_id")
            .groupBy(*attributes)
            .agg(F.sum("rides").alias("total_rides"),
                 F.sum("completed").alias("completed_rides"),
                 total("spent").alias("total_spent"))
            .orderBy(F.desc("total_rides"), "customer_id")
            .limit(10))


def q10(t: Tables) -> DataFrame:
    """Payment success rate by method."""
    counts = [_status_is(status, "payment_status").alias(name)
              for status, name in (("completed", "successful"), ("failed", "failed"),
                                   ("refunded", "refunded"), ("pending", "pending"))]
    return (t["payments"].groupBy("payment_method")
            .agg(F.count("*").alias("total_txns"), *counts)
            .withColumn("success_rate_pct", percent(F.col("successful"), F.col("total_txns")))
            .orderBy(F.desc("success_rate_pct"), "payment_method"))
