"""The four aggregate views for dashboards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rideflow.functions.numeric import mean, ratio, total

Tables = dict[str, DataFrame]


def v_rides_by_city(t: Tables) -> DataFrame:
    return (t["rides"].groupBy("pickup_city", "ride_status")
            .agg(F.count("*").alias("total_rides"),
                 mean("fare").alias("avg_fare"),
                 mean("distance_km").alias("avg_distance"),
                 mean("surge_multiplier").alias("avg_surge")))


def v_revenue_by_method(t: Tables) -> DataFrame:
    return (t["payments"].groupBy("payment_method", "payment_status")
            .agg(F.count("*").alias("total_payments"),
                 total("amount").alias("total_revenue"),
                 mean("amount").alias("avg_payment"),
                 total("tip_amount").alias("total_tips")))


def v_driver_performance(t: Tables) -> DataFrame:
    """Drivers without rides count as 0 rides. Rides are combined per driver before the join."""
    per_driver = (t["rides"].groupBy("driver_id")
                  .agg(F.count("ride_id").alias("rides"),
                       F.sum("fare").alias("fare_sum"), F.count("fare").alias("fare_n"),
                       F.sum("distance_km").alias("distance_sum"), F.count("distance_km").alias("distance_n")))
    return (t["drivers"].join(per_driver, "driver_id", "left")
            .groupBy("vehicle_type", "city")
            .agg(F.coalesce(F.sum("rides"), F.lit(0)).alias("total_rides"),
                 ratio(F.sum("fare_sum"), F.sum("fare_n")).alias("avg_fare"),
                 ratio(F.sum("distance_sum"), F.sum("distance_n")).alias("avg_distance")))


def v_hourly_demand(t: Tables) -> DataFrame:
    return (t["rides"].groupBy(F.hour("request_time").alias("hour_of_day"), "pickup_city")
            .agg(F.count("*").alias("total_rides"), mean("fare").alias("avg_fare"))
            .orderBy("hour_of_day", "pickup_city"))


VIEWS = {
    "v_rides_by_city": v_rides_by_city,
    "v_revenue_by_method": v_revenue_by_method,
    "v_driver_performance": v_driver_performance,
    "v_hourly_demand": v_hourly_demand,
}


def create_views(spark: SparkSession, t: Tables) -> list[str]:
    """Register the four views for SQL users."""
    for name, view in VIEWS.items():
        view(t).createOrReplaceTempView(name)
    return list(VIEWS)
