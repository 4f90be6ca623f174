"""KPIs over Silver rides and payments, and the lake queries over Gold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rideflow.functions.geo import geo_cell
from rideflow.functions.numeric import mean, percent, ratio, total
from rideflow.functions.times import minutes_between
from rideflow.operators.ranking import daily_counts, growth, ranked, rolling_mean

Tables = dict[str, DataFrame]


def executive(t: Tables) -> DataFrame:
    """One row: rides, revenue of completed rides, mean fare, cancellation rate, mean trip minutes."""
    minutes = minutes_between("pickup_time", "dropoff_time")
    return t["rides"].agg(
        F.count("*").alias("total_rides"),
        total(F.when(F.col("ride_status") == "completed", F.col("fare"))).alias("total_revenue"),
        mean("fare").alias("avg_fare"),
        percent(F.count_if(F.col("ride_status") == "cancelled"), F.count("*")).alias("cancellation_rate_pct"),
        ratio(F.sum(minutes).cast("decimal(18,0)"), F.count(minutes)).alias("avg_trip_minutes"))


def revenue_by_period(t: Tables) -> DataFrame:
    """Completed-ride revenue per day and per month. Months are summed from the daily rows."""
    daily = (t["rides"].filter(F.col("ride_status") == "completed")
             .groupBy(F.to_date("request_time").alias("day")).agg(F.sum("fare").alias("fare")))
    periods = F.explode(F.array(
        F.struct(F.lit("day").alias("grain"), F.col("day").alias("period")),
        F.struct(F.lit("month").alias("grain"), F.trunc("day", "month").alias("period"))))
    return (daily.select(periods.alias("p"), "fare").groupBy("p.grain", "p.period")
            .agg(total("fare").alias("revenue")))


def cancellation_by_place(t: Tables) -> DataFrame:
    return (t["rides"].groupBy("pickup_city", "pickup_area")
            .agg(F.count("*").alias("total_rides"),
                 F.count_if(F.col("ride_status") == "cancelled").alias("cancellations"))
            .withColumn("cancellation_rate_pct", percent(F.col("cancellations"), F.col("total_rides"))))


def driver_ranking(t: Tables) -> DataFrame:
    """Drivers ranked by completed rides within their city."""
    per_driver = (t["rides"].filter(F.col("ride_status") == "completed").groupBy("driver_id")
                  .agg(F.count("*").alias("completed_rides"), total("fare").alias("earnings")))
    named = per_driver.join(t["drivers"].select("driver_id", "city"), "driver_id")
    return ranked(named, "completed_rides", ["city"], "city_rank")


def city_ranking(t: Tables) -> DataFrame:
    by_city = t["rides"].groupBy("pickup_city").agg(F.count("*").alias("total_rides"), total("fare").alias("revenue"))
    return ranked(by_city, "total_rides", name="demand_rank", dense=True)


def demand_trend(t: Tables) -> DataFrame:
    """Daily rides with the mean of the seven days before."""
    return rolling_mean(daily_counts(t["rides"], "request_time"), "day", "rides")


def monthly_growth(t: Tables) -> DataFrame:
    monthly = t["rides"].groupBy(F.trunc(F.to_date("request_time"), "month").alias("month")).agg(F.count("*").alias("total_rides"))
    return growth(monthly, "month", "total_rides")


def demand_by_cell(t: Tables, precision: int = 6) -> DataFrame:
    """Rides and mean surge per pickup cell and hour."""
    rides = t["rides"]
    cell = F.col("pickup_cell") if "pickup_cell" in rides.columns else geo_cell("pickup_lat", "pickup_lon", precision)
    return (rides.groupBy(cell.alias("cell"), F.hour("request_time").alias("hour"))
            .agg(F.count("*").alias("rides"), mean("surge_multiplier").alias("avg_surge")))


def city_demand(g: Tables) -> DataFrame:
    """Rides and mean fare per city over Gold. The fact is combined per location before the join."""
    per_place = g["fact_rides"].groupBy("location_key").agg(F.count("*").alias("n"), F.sum("fare").alias("fare"))
    return (per_place.join(g["dim_location"], "location_key").groupBy("city")
            .agg(F.sum("n").alias("total_rides"), ratio(F.sum("fare"), F.sum("n")).alias("avg_fare"))
            .orderBy(F.desc("total_rides"), "city"))


def peak_hours(g: Tables) -> DataFrame:
    return g["fact_rides"].groupBy("ride_hour").agg(F.count("*").alias("demand")).orderBy(F.desc("demand"), "ride_hour")


def month_totals(fact: DataFrame, year: int | None = None, month: int | None = None) -> DataFrame:
    """Count and mean fare of all rides, or of one partition month."""
    if year is not None:
        fact = fact.filter((F.col("year") == year) & (F.col("month") == month))
    return fact.agg(F.count("*").alias("rides"), mean("fare").alias("avg_fare"))
