"""Flag rate of a stream of comments, by window and community.

Files that arrive in a folder are the stream. Counts are kept in state until the watermark, the latest
time seen by the triggers before less ``delay``, passes the end of their window; then the window is written once and its state
goes. A comment that a later trigger brings for a window that has been written is too late and is dropped. State and the list of files read lie
in the checkpoint folder: a run that is cut off goes on where it stood, and no row is counted twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from colloquy.functions.numbers import rate

RESULT = "window_start timestamp, window_end timestamp, community string, total_comments long, controversial_comments long"


def comment_stream(spark: SparkSession, folder: str, schema: str, files_at_once: int | None = None, names: str | None = None) -> DataFrame:
    """Files of a folder, oldest first, as they come; ``names`` is a pattern of file names."""
    reader = spark.readStream.schema(schema)
    if files_at_once:
        reader = reader.option("maxFilesPerTrigger", files_at_once)
    if names:
        reader = reader.option("pathGlobFilter", names)
    return reader.parquet(folder)


def windowed_flags(comments: DataFrame, window: str, delay: str) -> DataFrame:
    """Comments and flagged comments by window and community, from columns ``at``, ``community`` and ``flag``. Works on streams
    and, where the watermark means nothing, on tables."""
    cells = comments.withWatermark("at", delay).groupBy(F.window("at", window).alias("w"), "community")
    counted = cells.agg(F.count(F.lit(1)).alias("total_comments"), F.coalesce(F.sum("flag"), F.lit(0)).cast("long").alias("controversial_comments"))
    return counted.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "community", "total_comments", "controversial_comments")


def write_closed_windows(flags: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Work off all files that are there and append the windows that are closed to ``table``."""
    writer = flags.writeStream.outputMode("append").format("parquet").option("path", table).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def read_rates(spark: SparkSession, table: str) -> DataFrame:
    """The windows written so far, with their rate."""
    closed = spark.read.schema(RESULT).parquet(table)
    return closed.withColumn("controversy_rate", rate("controversial_comments", "total_comments"))
