"""Removed and deleted markers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.functions.numbers import flag
from colloquy.schema import DELETED_AUTHOR, REMOVED_BODIES


def with_validity_flags(
    df: DataFrame,
    removed: Sequence[str] = REMOVED_BODIES,
    deleted_author: str = DELETED_AUTHOR,
) -> DataFrame:
    """0/1 flags. A missing body or author is not flagged."""
    return df.withColumns(
        {
            "is_removed_or_deleted": flag(F.col("body").isin(*removed)),
            "is_deleted_author": flag(F.col("author") == deleted_author),
        }
    )
