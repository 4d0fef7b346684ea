"""The model table: valid comments with user and community features."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.functions.numbers import log_feature
from colloquy.operators.evaluation import split
from colloquy.operators.keyed_join import attach_by_key
from colloquy.operators.subsets import valid_text_rows
from colloquy.operators.users import author_activity, mean_of, multi_community_flag
from colloquy.schema import CATEGORY_FEATURES, MODEL_BASE_COLUMNS, NUMERIC_FEATURES
from colloquy.staging import delete, held, shuffles_freed, stage

# What the model inputs are made from.
INPUT_SOURCES = (
    "id", "author", "subreddit", "controversiality", "score",
    "month", "hour", "weekday", "body_length_chars", "body_length_words",
)


def user_features(activity: DataFrame) -> DataFrame:
    """One row per author, from :func:`author_activity` of the valid rows."""
    return (
        activity.groupBy("author")
        .agg(
            F.count("subreddit").alias("distinct_subreddits_per_user"),
            F.sum("comments").alias("total_comments_per_user"),
            mean_of("score").alias("avg_score_per_user"),
            F.sum("controversiality_sum").alias("total_controversial_comments_per_user"),
        )
        .withColumn("is_multi_subreddit_user", multi_community_flag("distinct_subreddits_per_user"))
    )


def community_features(activity: DataFrame) -> DataFrame:
    """One row per community, from the same activity rows."""
    return activity.groupBy("subreddit").agg(
        F.sum("comments").alias("subreddit_total_comments"),
        mean_of("score").alias("subreddit_avg_score"),
        mean_of("body_length_chars").alias("subreddit_avg_body_length_chars"),
        mean_of("body_length_words").alias("subreddit_avg_body_length_words"),
        mean_of("controversiality").alias("subreddit_controversy_rate"),
    )


def with_model_columns(df: DataFrame) -> DataFrame:
    """Label, rounded features and log features."""
    rounded = {
        "score_rounded": ("score", 2),
        "body_length_chars_rounded": ("body_length_chars", 2),
        "body_length_words_rounded": ("body_length_words", 2),
        "avg_score_per_user_rounded": ("avg_score_per_user", 2),
        "subreddit_avg_score_rounded": ("subreddit_avg_score", 2),
        "subreddit_controversy_rate_rounded": ("subreddit_controversy_rate", 4),
    }
    return df.withColumns(
        {
            "label": F.col("controversiality").cast("int"),
            **{out: F.round(source, dp) for out, (source, dp) in rounded.items()},
            "log_body_length_words": log_feature("body_length_words"),
            "log_total_comments_per_user": log_feature("total_comments_per_user"),
        }
    )


def feature_rows(valid: DataFrame, features_from: str = "all") -> DataFrame:
    """The rows that user and community features are made from: all of them, as published, or
    the training side alone, which keeps the test side's labels out of its features."""
    if features_from not in ("all", "train"):
        raise ValueError(f"features_from: {features_from}")
    return valid if features_from == "all" else split(valid)[0]


def attach_features(valid: DataFrame, features_from: str = "all", **join) -> DataFrame:
    """Valid rows with both feature tables.

    Activity is aggregated and written once; both feature tables come from it.
    ``join`` goes to :func:`attach_by_key`. Comments without an author or community
    keep NULL features, and so do, from the training side, those it does not know.
    """
    activity = stage(author_activity(feature_rows(valid, features_from)), "model-activity")
    users = stage(user_features(activity), "user-features")
    communities = stage(community_features(activity), "community-features")
    joined = attach_by_key(valid, users, "author", "total_comments_per_user", "left", **join)
    return attach_by_key(joined, communities, "subreddit", "subreddit_total_comments", "left", **join)


def with_features(valid: DataFrame, features_from: str = "all", **join) -> DataFrame:
    """Valid rows with both feature tables and the model columns."""
    return with_model_columns(attach_features(valid, features_from, **join))


def model_base(
    features: DataFrame,
    features_from: str = "all",
    bodies: Callable[[DataFrame], DataFrame] | None = None,
    source: Sequence[str] = (),
    **join,
) -> DataFrame:
    """The full model table, bodies included.

    Rows of a stored table cross the joins with their bodies. Where ``bodies`` can give rows their bodies
    back from the columns ``source``, these are read once for the valid rows and what is known of them, and
    the joins move narrow rows; what they were made of is deleted when they are written.
    """
    valid = valid_text_rows(features)
    if bodies is None:
        return with_features(valid, features_from, **{"wide": True, **join}).select(*MODEL_BASE_COLUMNS)
    spark = features.sparkSession
    with shuffles_freed(spark):
        with held(spark) as folder:
            rows = stage(valid.select(*INPUT_SOURCES, "year", "day", *source), "model-rows")
            joined = attach_features(rows, features_from, **join)
        joined = stage(joined, "model-features")
        delete(spark, folder)
    return with_model_columns(bodies(joined)).select(*MODEL_BASE_COLUMNS)


def model_input(features: DataFrame, features_from: str = "all", **join) -> DataFrame:
    """The columns the models read, as a written table: fitting passes over them
    often. Bodies are read once, to find the valid rows, and never shuffled."""
    valid = valid_text_rows(features).select(*INPUT_SOURCES)
    columns = ("id", "label", *CATEGORY_FEATURES, *NUMERIC_FEATURES)
    return stage(with_features(stage(valid, "model-rows"), features_from, **join).select(*columns), "model-input")
