"""Tables stored by key, so that later jobs join and aggregate on it without a shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from colloquy.staging import new_path


def write_by_key(df: DataFrame, table: str, path: str, key: str, buckets: int) -> DataFrame:
    """Store ``df`` at ``path`` in ``buckets`` files by the hash of ``key``, each sorted by it, and name it ``table`` in the
    session's catalog. Tables that meet must have as many buckets, and their keys one type."""
    # One file per bucket: each task holds the rows of whole buckets.
    placed = df.repartition(buckets, key)
    placed.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", path).format("parquet").saveAsTable(table)
    return df.sparkSession.table(table)


def open_by_key(spark: SparkSession, df_schema: str, table: str, path: str, key: str, buckets: int) -> DataFrame:
    """Name a table another session has stored."""
    spark.sql(f"create table if not exists {table} ({df_schema}) using parquet clustered by ({key}) sorted by ({key}) into {buckets} buckets location '{path}'")
    return spark.table(table)


def stage_by_key(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """A staged table by key."""
    path = new_path(df.sparkSession, name)
    return write_by_key(df, path.rpartition("/")[2].replace("-", "_"), path, key, buckets)
