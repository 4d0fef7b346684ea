"""The reports. Each passes over the comments as few times as its grains allow,
writes the small aggregate it found, and derives all its frames from that.

Every function returns named frames; names and columns are those of the summary
files they become.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.functions.calendar import with_local_hour, with_weekday_name
from colloquy.functions.text import clean_text, explode_tokens
from colloquy.operators import evaluation, models, rates, subsets, terms, users
from colloquy.operators.sentiment import comment_sentiment, sentiment_means, sentiment_sums
from colloquy.operators.trips import TAXI_COLUMNS, daily_rollup, daily_summary
from colloquy.schema import CATEGORY_FEATURES, LOCAL_ZONE, NUMERIC_FEATURES
from colloquy.sources.sinks import preview, schema_report
from colloquy.staging import stage

Frames = dict[str, DataFrame]

PROFILED = ("author", "subreddit", "body", "controversiality", "created_utc")
TEXT_SAMPLED = ("id", "author", "subreddit", "controversiality", "body", "body_clean", "clean_char_count", "clean_word_count")
SAMPLED = ("author", "subreddit", "controversiality", "score", "created_utc", "body")


def explore_report(comments: DataFrame) -> Frames:
    """A first look at a comment table."""
    frames = {
        "row_count": subsets.row_count(comments),
        "schema": schema_report(comments),
        "subreddit_counts": subsets.group_counts(comments, "subreddit"),
        "null_profile": subsets.null_profile(comments, PROFILED),
        "sample": preview(comments, SAMPLED),
    }
    if "controversiality" in comments.columns:
        frames["controversiality_distribution"] = subsets.distribution(comments, "controversiality")
    return frames


def subset_report(features: DataFrame) -> Frames:
    """Sizes of the four subsets and the flag rate, from one pass."""
    keys = ("subreddit", "controversiality", "is_removed_or_deleted", "is_deleted_author")
    cells = stage(features.groupBy(*keys).agg(F.count("*").alias("comments")), "subset-cells")
    n = F.sum("comments")

    def size(kind: str) -> Column:
        return F.coalesce(F.sum(F.when(subsets.in_subset(kind), F.col("comments"))), F.lit(0))

    sizes = {f"{kind}_df": size(kind) for kind in subsets.SUBSETS}
    frames = {"subset_row_counts": subsets.run_summary(sizes, cells)}
    for kind in subsets.SUBSETS:
        part = subsets.subset(cells, kind)
        counts = part.groupBy("subreddit").agg(n.alias("count"))
        frames[f"{kind}_subreddit_counts"] = counts.orderBy(F.desc("count"), "subreddit")
        frames[f"{kind}_controversiality_distribution"] = (
            part.groupBy("controversiality").agg(n.alias("count")).orderBy("controversiality")
        )
    flagged = F.sum(F.col("controversiality") * F.col("comments")).alias("controversial_comments")
    by_community = cells.groupBy("subreddit").agg(n.alias("total_comments"), flagged)
    frames["controversy_rate_by_subreddit"] = rates.by_rate(rates.with_rate(by_community), "subreddit")
    return frames


def time_report(features: DataFrame, zone: str = LOCAL_ZONE) -> Frames:
    """Flag rate by community, month, local hour and weekday, from one pass."""
    local = with_local_hour(features, "created_ts", zone)
    cube = stage(rates.rate_cube(local, ["subreddit", "year", "month", "weekday", "hour_est"]), "rate-cube")
    months = ["year", "month"]
    return {
        "controversy_by_subreddit": rates.by_rate(rates.roll_up(cube, ["subreddit"]), "subreddit"),
        "controversy_by_month": rates.roll_up(cube, months).orderBy(*months),
        "controversy_by_hour": rates.roll_up(cube, ["hour_est"]).orderBy("hour_est"),
        "controversy_by_weekday": with_weekday_name(rates.roll_up(cube, ["weekday"])).orderBy("weekday"),
        "controversy_over_time_by_subreddit": rates.roll_up(cube, ["subreddit", *months]).orderBy(
            "subreddit", *months
        ),
    }


def community_report(features: DataFrame) -> Frames:
    """Single- against multi-community users, from one pass."""
    monthly = stage(users.author_activity(subsets.subset(features, "user"), ("year", "month")), "activity")
    activity = stage(users.roll_up_activity(monthly), "activity-total")
    profiles = stage(users.profile_of(activity), "profiles")
    typed = stage(users.typed_activity(activity), "typed-activity")
    return {
        "distinct_users": subsets.row_count(profiles),
        "user_type_counts": users.user_type_counts(profiles),
        "user_type_comment_summary": users.user_type_comment_summary(typed),
        "user_type_user_summary": users.user_type_user_summary(profiles),
        "subreddit_user_type_summary": users.community_user_type_summary(typed),
        "cross_community_over_time": users.cross_community_over_time(users.typed_activity(monthly)),
        "subreddit_pair_counts": users.community_pairs(typed.select("author", "subreddit")),
    }


def notes(df: DataFrame, entries: dict[str, Column]) -> DataFrame:
    """(metric, value) lines from one pass over ``df``."""
    one = df.agg(*[value.cast("string").alias(name) for name, value in entries.items()])
    return one.unpivot([], list(entries), "metric", "value")


def filter_report(filtered: DataFrame) -> Frames:
    """What the filter kept: rows per community, most active first."""
    return {"subreddit_counts": subsets.group_counts(filtered, "subreddit")}


def feature_report(features: DataFrame) -> Frames:
    """Checks on the feature table: rows, flags and a sample."""
    flags = ("is_removed_or_deleted", "is_deleted_author", "controversiality")
    shown = ("author", "subreddit", "controversiality", "score", "year", "month", "hour", "body_length_chars", "body_length_words", *flags[:2], "body")
    return {
        "row_count": subsets.row_count(features),
        "flag_distributions": subsets.distributions(features, flags),
        "sample": preview(features, shown),
    }


def text_report(features: DataFrame, text_base: DataFrame | None = None) -> Frames:
    """Body lengths and common terms. Cleaned texts meet the user types and are exploded once, at
    the grain of all three rankings. The bodies of ``text_base`` are clean already; rows it
    leaves out have no terms, but their authors still count towards the user types."""
    rows = subsets.subset(features, "text_user").filter(F.col("author").isNotNull())
    dims = ["controversiality", "subreddit", "user_type"]
    if text_base is None:
        source = rows.withColumn("body_clean", clean_text("body"))
    else:
        source = text_base.filter(F.col("author").isNotNull())
    types = stage(users.user_types(rows), "user-types")
    labelled = users.with_user_type(source.select("id", "author", "subreddit", "controversiality", "body_clean"), types)
    counts = stage(terms.term_counts(explode_tokens(labelled, dims), dims), "term-counts")

    def top(dim: str) -> DataFrame:
        return terms.top_terms(terms.roll_up_terms(counts, [dim]), dim)

    by_community = subsets.length_stats(rows, "subreddit")
    return {
        "text_length_by_controversy": subsets.length_stats(rows, "controversiality").orderBy("controversiality"),
        "text_length_by_subreddit": by_community.orderBy(F.desc("total_comments"), "subreddit"),
        "top_terms_by_controversy": top("controversiality"),
        "top_terms_by_subreddit": top("subreddit"),
        "top_terms_by_user_type": top("user_type"),
    }


def base_notes(base: DataFrame, features: DataFrame, name: str) -> DataFrame:
    """Rows of the feature table, of its valid part and of the table made from that."""
    valid = subsets.in_subset("text_user") & (F.length(F.trim("body")) > 0)
    made = notes(base, {f"{name}_rows": F.count("*")})
    return notes(features, {"feature_base_rows": F.count("*"), "valid_rows": F.count_if(valid)}).unionByName(made)


def text_base_report(text_base: DataFrame, features: DataFrame | None = None) -> Frames:
    """Checks on the cleaned-text table, with notes where the feature table is given."""
    found = {} if features is None else {"notes": base_notes(text_base, features, "text_base")}
    return found | {
        "subreddit_counts": subsets.group_counts(text_base, "subreddit"),
        "controversiality_distribution": subsets.distribution(text_base, "controversiality"),
        "avg_clean_text_length_by_subreddit": subsets.clean_length_by(text_base, "subreddit"),
        "sample": preview(text_base, TEXT_SAMPLED),
    }


def nlp_report(text_base: DataFrame, min_count: int = 500, n: int = 20) -> Frames:
    """Sentiment and distinctive terms: one pass for each."""
    dims = ["controversiality", "subreddit"]
    sums = stage(sentiment_sums(comment_sentiment(text_base), dims), "sentiment-sums")
    counts = stage(terms.term_counts(explode_tokens(text_base, dims), dims), "term-counts")

    def distinctive(dim: str) -> DataFrame:
        rolled = stage(terms.roll_up_terms(counts, [dim]), f"term-counts-{dim}")
        return terms.distinctive_terms(rolled, dim, min_count, n)

    found = {
        "sentiment_by_controversy": sentiment_means(sums, "controversiality").orderBy("controversiality"),
        "sentiment_by_subreddit": sentiment_means(sums, "subreddit").orderBy(F.desc("total_comments"), "subreddit"),
        "top_distinctive_terms_by_controversy": distinctive("controversiality"),
        "top_distinctive_terms_by_subreddit": distinctive("subreddit"),
    }
    totals = notes(sums, {"comments_with_terms": F.sum("comments")}).unionByName(notes(counts, {"terms": F.sum("count")}))
    return found | {"notes": totals}


def model_base_report(base: DataFrame, features: DataFrame | None = None) -> Frames:
    """Checks on the model table, with notes where the feature table is given."""
    found = {} if features is None else {"notes": base_notes(base, features, "model_base")}
    return found | {
        "label_distribution": subsets.distribution(base, "label"),
        "subreddit_distribution": subsets.group_counts(base, "subreddit"),
        "multi_subreddit_user_distribution": subsets.distribution(base, "is_multi_subreddit_user"),
        "sample": preview(base, ("id", "author", "label", *CATEGORY_FEATURES, *NUMERIC_FEATURES)),
    }


def model_report(base: DataFrame) -> Frames:
    """Fit both classifiers on a stored model table and report on the test side."""
    columns = ("id", "label", *CATEGORY_FEATURES, *NUMERIC_FEATURES)
    rows = stage(base.select(*columns), "model-input")
    lr, rf = models.train_models(rows)
    metrics = stage(lr.metrics().unionByName(rf.metrics()), "model-metrics")
    labelled = rows.filter(F.col("label").isNotNull())
    lines = notes(rows, {"rows": F.count("*"), "rows_without_label": F.count_if(F.col("label").isNull())})
    scores = models.metrics_long(metrics).select(F.concat_ws(" ", "model", "metric").alias("metric"), F.col("value").cast("string").alias("value"))
    return {
        "notes": lines.unionByName(scores),
        "split_counts": evaluation.split_counts(labelled),
        "class_weights": evaluation.class_weights(evaluation.split(labelled)[0]),
        "model_metrics": metrics,
        "model_metrics_long": models.metrics_long(metrics),
        "confusion_summary": lr.summary().unionByName(rf.summary()),
        "logreg_confusion_counts": lr.confusion(),
        "rf_confusion_counts": rf.confusion(),
        "logreg_feature_coefficients": lr.weights(),
        "rf_feature_importances": rf.weights(),
    }


def trip_report(trips: DataFrame, year: int = 2021) -> Frames:
    daily = stage(daily_summary(trips, year, TAXI_COLUMNS), "daily")
    days = ("dt_year", "dt_month", "dt_day")
    return {
        "daily_averages": daily.orderBy(*[F.desc(d) for d in days]),
        "rollup": daily_rollup(daily),
    }
