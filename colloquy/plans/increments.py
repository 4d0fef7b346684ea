"""New periods added to stored tables, without building them anew.

Feature and activity tables are laid out by period. A delivery replaces the periods it holds and leaves the others
alone (dynamic partition overwrite), so sending a period again is harmless. Activity is
additive: what a report needs is the sum of the stored periods, each a small aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from colloquy.operators.subsets import feature_base, subset
from colloquy.operators.users import author_activity, roll_up_activity
from colloquy.sources.tables import read_table
from colloquy.staging import COMPRESSION, setting

MONTHS = ("year", "month")
# Beyond so many periods in a task Spark sorts the rest of its rows.
OPEN_FILES = 64
GROUP_BYTES = 8 * 1024 * 1024


def replace_periods(df: DataFrame, path: str, periods: Sequence[str] = MONTHS) -> None:
    """Write the periods ``df`` holds in place of what is stored for them. A task keeps the files of up to ``OPEN_FILES`` periods
    open, with small row groups, instead of sorting rows with texts by their period."""
    with setting(df.sparkSession, "spark.sql.maxConcurrentOutputFileWriters", str(OPEN_FILES)):
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**{"parquet.block.size": GROUP_BYTES, "compression": COMPRESSION})
        writer.partitionBy(*periods).parquet(path)


def add_comments(spark: SparkSession, comments: DataFrame, features: str, activity: str, periods: Sequence[str] = MONTHS) -> None:
    """Add whole periods of raw comments to the feature table, and their activity to the activity table. The activity
    is made from the stored features of these periods alone."""
    made = feature_base(comments)
    replace_periods(made, features, periods)
    delivered = made.select(*periods).distinct()
    stored = read_table(spark, features).join(delivered.hint("broadcast"), list(periods), "left_semi")
    replace_periods(author_activity(subset(stored, "user"), periods), activity, periods)


def total_activity(spark: SparkSession, activity: str) -> DataFrame:
    """Activity per author and community over all stored periods."""
    return roll_up_activity(read_table(spark, activity))
