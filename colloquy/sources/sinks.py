"""Sinks: Parquet tables, summary CSVs, run notes, previews."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Overwrite a Parquet table. Input that arrives in time order needs no
    shuffle before a calendar ``partition_by``: each task holds few periods."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_summary_csv(df: DataFrame, path: str, one_file: bool = True) -> None:
    """A CSV with a header: one file for frames of a fixed size, or part files for frames that
    grow with the data. Reports end in a sort, and part files in the order of their
    names keep it; only a single file runs as one task."""
    (df.coalesce(1) if one_file else df).write.mode("overwrite").option("header", True).csv(path)


def write_notes(notes: DataFrame, path: str) -> None:
    """``name: value`` lines of a (metric, value) frame."""
    lines = notes.select(F.concat_ws(": ", F.col("metric"), F.col("value").cast("string")).alias("value"))
    lines.coalesce(1).write.mode("overwrite").text(path)


def select_present(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The wanted columns the frame has, in the wanted order."""
    return df.select([c for c in cols if c in df.columns])


def preview(df: DataFrame, cols: Sequence[str], n: int = 10, width: int = 80) -> DataFrame:
    """First ``n`` rows with long strings cut to ``width`` characters."""
    rows = select_present(df, cols).limit(n)
    return rows.select([_cut(c, width) if t == "string" else F.col(c) for c, t in rows.dtypes])


def _cut(name: str, width: int) -> Column:
    text = F.col(name)
    short = F.concat(F.substring(text, 1, width - 3), F.lit("..."))
    return F.when(F.length(text) > width, short).otherwise(text).alias(name)


def schema_report(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, nullability."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, type string, nullable boolean")
