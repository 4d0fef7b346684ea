"""Table shapes and the fixed values the reports depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw comments, stored under yyyy=/mm= folders.
COMMENT_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("author", T.StringType()),
        T.StructField("subreddit", T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("controversiality", T.IntegerType()),
        T.StructField("created_utc", T.LongType()),
        T.StructField("score", T.IntegerType()),
        T.StructField("link_id", T.StringType()),
        T.StructField("parent_id", T.StringType()),
    ]
)
COMMENT_COLUMNS = COMMENT_SCHEMA.fieldNames()

# The communities studied.
SELECTED_COMMUNITIES = (
    "politics",
    "worldnews",
    "news",
    "WhitePeopleTwitter",
    "conspiracy",
    "changemyview",
)

# How a removed body and a deleted author are written in the data.
REMOVED_BODIES = ("[removed]", "[deleted]")
DELETED_AUTHOR = "[deleted]"

# The user labels.
SINGLE_COMMUNITY = "single_subreddit"
MULTI_COMMUNITY = "multi_subreddit"

# Fixed value: the zone of the hour-of-day report.
LOCAL_ZONE = "America/New_York"

# The sentiment lexicon.
POSITIVE_WORDS = (
    "good", "great", "better", "best", "right", "love", "support", "peace",
    "safe", "success", "fair", "hope", "help", "agree", "freedom", "positive",
)
NEGATIVE_WORDS = (
    "bad", "worse", "worst", "wrong", "hate", "war", "dead", "death",
    "kill", "racist", "corrupt", "stupid", "evil", "lie", "lies", "violent",
    "violence", "terror", "terrorist", "crime", "illegal", "attack", "attacks",
)

# Column order of the cleaned-text table.
TEXT_BASE_COLUMNS = (
    "id", "author", "subreddit", "controversiality", "score",
    "created_utc", "created_ts_utc", "year", "month", "day", "hour", "weekday",
    "body", "body_clean", "body_length_chars", "body_length_words",
    "clean_char_count", "clean_word_count",
)

# Column order of the model table.
MODEL_BASE_COLUMNS = (
    "id", "author", "subreddit", "body", "label", "controversiality", "score_rounded",
    "year", "month", "day", "hour", "weekday",
    "body_length_chars_rounded", "body_length_words_rounded", "log_body_length_words",
    "distinct_subreddits_per_user", "total_comments_per_user", "log_total_comments_per_user",
    "avg_score_per_user_rounded", "total_controversial_comments_per_user",
    "is_multi_subreddit_user", "subreddit_total_comments", "subreddit_avg_score_rounded",
    "subreddit_avg_body_length_chars", "subreddit_avg_body_length_words",
    "subreddit_controversy_rate_rounded",
)

# The model inputs; vector slots follow this order after the category slots.
CATEGORY_FEATURES = ("subreddit",)
NUMERIC_FEATURES = (
    "score_rounded", "month", "hour", "weekday",
    "body_length_words_rounded", "log_body_length_words",
    "distinct_subreddits_per_user", "total_comments_per_user", "log_total_comments_per_user",
    "avg_score_per_user_rounded", "total_controversial_comments_per_user",
    "is_multi_subreddit_user", "subreddit_total_comments", "subreddit_avg_score_rounded",
    "subreddit_avg_body_length_chars", "subreddit_avg_body_length_words",
    "subreddit_controversy_rate_rounded",
)
