"""The four stored tables, each built from the one before it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from colloquy.operators.model_base import model_base
from colloquy.operators.subsets import feature_base, filter_members, group_counts, nlp_text_base
from colloquy.schema import SELECTED_COMMUNITIES
from colloquy.session import pin_utc
from colloquy.sources.sinks import write_table
from colloquy.sources.tables import read_month, read_table

CALENDAR = ("year", "month")


def list_communities(spark: SparkSession, raw: str, yyyy: int, mm: int) -> DataFrame:
    """Communities of one month of raw comments, most active first."""
    return group_counts(read_month(spark, raw, yyyy, mm), "subreddit")


def build_filtered(spark: SparkSession, raw: str, out: str, members: Sequence[str] = SELECTED_COMMUNITIES) -> DataFrame:
    """Comments of the chosen communities, in the raw layout."""
    kept = filter_members(read_table(spark, raw), "subreddit", members)
    layout = [c for c in ("yyyy", "mm") if c in kept.columns]
    # A few communities leave a few rows of every input split: they are gathered by month,
    # in files of the size adaptive execution aims at, large months in several.
    kept = kept.hint("rebalance", *layout) if layout else kept.hint("rebalance")
    write_table(kept, out, layout)
    return read_table(spark, out)


def build_features(spark: SparkSession, filtered: str, out: str) -> DataFrame:
    """Derived columns, one folder per month: calendar filters read less."""
    pin_utc(spark)
    write_table(feature_base(read_table(spark, filtered)), out, CALENDAR)
    return read_table(spark, out)


def build_text_base(spark: SparkSession, features: str, out: str) -> DataFrame:
    """Cleaned text, written so that no later report cleans it again."""
    pin_utc(spark)
    write_table(nlp_text_base(read_table(spark, features)), out, CALENDAR)
    return read_table(spark, out)


def build_model_base(spark: SparkSession, features: str, out: str, features_from: str = "all") -> DataFrame:
    pin_utc(spark)
    write_table(model_base(read_table(spark, features), features_from), out)
    return read_table(spark, out)
