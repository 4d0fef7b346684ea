"""Share of flagged comments by any set of dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.functions.numbers import rate


def rate_by(df: DataFrame, dims: Sequence[str], flag: str = "controversiality") -> DataFrame:
    """Rows, flagged rows and their ratio per group. No order: callers sort."""
    return with_rate(rate_cube(df, dims, flag))


def rate_cube(df: DataFrame, dims: Sequence[str], flag: str = "controversiality") -> DataFrame:
    """Additive counts at the finest grain, from which :func:`roll_up` serves
    every coarser report without another pass over the comments."""
    return df.groupBy(*dims).agg(
        F.count("*").alias("total_comments"), F.sum(flag).alias("controversial_comments")
    )


def roll_up(cube: DataFrame, dims: Sequence[str]) -> DataFrame:
    rolled = cube.groupBy(*dims).agg(
        F.sum("total_comments").alias("total_comments"),
        F.sum("controversial_comments").alias("controversial_comments"),
    )
    return with_rate(rolled)


def with_rate(df: DataFrame) -> DataFrame:
    return df.withColumn("controversy_rate", rate("controversial_comments", "total_comments"))


def by_rate(df: DataFrame, tie: str) -> DataFrame:
    """Highest rate first."""
    return df.orderBy(F.desc("controversy_rate"), F.asc(tie))
