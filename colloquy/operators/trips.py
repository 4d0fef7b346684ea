"""Daily summaries of trip records."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.functions.calendar import within_year
from colloquy.operators.quantiles import quantiles

DAY = ("dt_year", "dt_month", "dt_day")

# Measures of the taxi trip table.
TAXI_COLUMNS = {
    "pickup": "tpep_pickup_datetime",
    "distance": "trip_distance",
    "tax": "mta_tax",
    "fare": "fare_amount",
    "tip": "tip_amount",
    "passengers": "passenger_count",
}


def trips_in_year(trips: DataFrame, ts: str, year: int) -> DataFrame:
    """Trips that start in ``year``, with calendar columns."""
    parts = {"dt_year": F.year(ts), "dt_month": F.month(ts), "dt_day": F.dayofmonth(ts)}
    return trips.filter(within_year(ts, year)).withColumns(parts)


def daily_summary(trips: DataFrame, year: int, columns: Mapping[str, str] = TAXI_COLUMNS) -> DataFrame:
    """One row per day of ``year``, latest first; the 95th percentile of the fares is exact."""
    c = columns
    wanted = trips_in_year(trips, c["pickup"], year)
    days = wanted.groupBy(*DAY).agg(
        F.count("*").alias("num_trips"),
        F.try_divide(F.sum(c["distance"]), F.count(c["distance"])).alias("mean_trip_distance"),
        F.max(c["tax"]).alias("max_mta_tax"),
        F.min(c["tip"]).alias("min_tip_amount"),
        F.ceil(F.try_divide(F.sum(c["passengers"]), F.count(c["passengers"]))).alias("mean_passenger_count"),
    )
    fares = quantiles(wanted.select(*DAY, F.col(c["fare"]).alias("fare")), DAY, "fare", {"q95_fare_amount": (95, 100)})
    columns_ = [*DAY, "num_trips", "mean_trip_distance", "max_mta_tax", "q95_fare_amount", "min_tip_amount", "mean_passenger_count"]
    # A trip in the year has a day: none is NULL.
    return days.join(fares, list(DAY)).select(*columns_).orderBy(*[F.desc(d) for d in DAY])


def daily_rollup(daily: DataFrame) -> DataFrame:
    """One row over the daily table: days, trips, mean per day, first and last day."""
    day = F.make_date(*DAY)
    return daily.agg(
        F.count("*").alias("days"),
        F.sum("num_trips").alias("total_trips"),
        F.round(F.avg("num_trips"), 0).alias("avg_daily_trips"),
        F.min(day).cast("string").alias("first_day"),
        F.max(day).cast("string").alias("last_day"),
    )
