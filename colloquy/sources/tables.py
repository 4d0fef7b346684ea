"""Sources: Parquet tables, month partitions, file lists, summary CSVs."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A Parquet directory or glob. A given schema saves the footer read."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def read_month(
    spark: SparkSession, root: str, yyyy: int, mm: int, schema: T.StructType | None = None
) -> DataFrame:
    """One month of a ``yyyy=/mm=`` layout. Reading the root with a partition
    filter lists only that folder's files and keeps both columns."""
    wanted = (F.col("yyyy").cast("int") == yyyy) & (F.col("mm").cast("int") == mm)
    return read_table(spark, root, schema).where(wanted)


def read_files(spark: SparkSession, *paths: str) -> DataFrame:
    """Several files as one frame."""
    return spark.read.parquet(*paths)


def month_paths(root: str, year: int, months: Iterable[int], name: str = "yellow_tripdata") -> list[str]:
    """Paths of monthly files laid out as ``yyyy=2021/<name>_2021-03.parquet``."""
    return [f"{root.rstrip('/')}/yyyy={year}/{name}_{year}-{month:02d}.parquet" for month in months]


def read_summary_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).csv(path, header=True)


def integer_range(spark: SparkSession, n: int) -> DataFrame:
    return spark.range(n)


def query_view(df: DataFrame, view: str, sql: str) -> DataFrame:
    """Run SQL over ``df`` registered as a temporary view."""
    df.createOrReplaceTempView(view)
    return df.sparkSession.sql(sql)
