"""Event time and calendar parts. Sessions run in UTC."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_event_time(df: DataFrame, epoch: str = "created_utc", out: str = "created_ts") -> DataFrame:
    """Epoch seconds to an instant, without a round trip through a string."""
    return df.withColumn(out, F.timestamp_seconds(F.col(epoch)))


def with_time_parts(df: DataFrame, ts: str = "created_ts") -> DataFrame:
    """year, month, day, hour and weekday (1 = Sunday ... 7 = Saturday)."""
    return df.withColumns(
        {
            "year": F.year(ts),
            "month": F.month(ts),
            "day": F.dayofmonth(ts),
            "hour": F.hour(ts),
            "weekday": F.dayofweek(ts),
        }
    )


def local_hour(ts: str | Column, zone: str) -> Column:
    return F.hour(F.from_utc_timestamp(ts, zone))


def with_local_hour(df: DataFrame, ts: str, zone: str, out: str = "hour_est") -> DataFrame:
    return df.withColumn(out, local_hour(ts, zone))


def weekday_name(weekday: str | Column) -> Column:
    """English name of a 1 = Sunday weekday number; NULL outside 1..7."""
    names = F.array(*[F.lit(d) for d in ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")])
    number = F.col(weekday) if isinstance(weekday, str) else weekday
    return F.get(names, number - 1)


def with_weekday_name(df: DataFrame, weekday: str = "weekday", out: str = "weekday_name") -> DataFrame:
    return df.withColumn(out, weekday_name(weekday))


def with_year_month(df: DataFrame, out: str = "year_month") -> DataFrame:
    """``YYYY-MM`` label from the year and month columns."""
    return df.withColumn(out, F.format_string("%d-%02d", F.col("year"), F.col("month")))


def within_year(ts: str, year: int) -> Column:
    """A range on the timestamp itself, so both bounds reach the Parquet scan."""
    column = F.col(ts)
    return (column >= F.lit(f"{year:04d}-01-01").cast("timestamp_ntz")) & (
        column < F.lit(f"{year + 1:04d}-01-01").cast("timestamp_ntz")
    )
