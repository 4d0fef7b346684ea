"""Lexicon sentiment, scored inside each row: no term rows, no shuffle."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.functions.text import english_stop_words, tokens_of
from colloquy.schema import NEGATIVE_WORDS, POSITIVE_WORDS

COMMENT_KEYS = (
    "id", "author", "subreddit", "controversiality", "score", "year", "month", "hour", "weekday",
)
COUNTS = ("positive_token_count", "negative_token_count", "token_count")
SCALE = 10_000  # per-token scores are kept to four places


def lexicon_flags(
    tokens: DataFrame,
    positive: Sequence[str] = POSITIVE_WORDS,
    negative: Sequence[str] = NEGATIVE_WORDS,
) -> DataFrame:
    """0/1 lexicon columns on term rows."""
    token = F.col("token")
    return tokens.withColumns(
        {
            "is_positive_token": token.isin(*positive).cast("int"),
            "is_negative_token": token.isin(*negative).cast("int"),
        }
    )


def comment_sentiment(
    text_base: DataFrame,
    keys: Sequence[str] = COMMENT_KEYS,
    clean: str = "body_clean",
    positive: Sequence[str] = POSITIVE_WORDS,
    negative: Sequence[str] = NEGATIVE_WORDS,
    stop: Sequence[str] | None = None,
    merge_repeats: bool = False,
) -> DataFrame:
    """One row per comment that has at least one term.

    ``merge_repeats`` adds up comments that agree in all ``keys``; it costs a
    shuffle of the narrow per-comment rows and is not needed where ids are unique.
    """
    words = english_stop_words() if stop is None else stop
    lexicon = {*positive, *negative}

    def size(tokens: str, test: Callable[[Column], Column]) -> Column:
        return F.size(F.filter(tokens, test)).cast("long")

    # Split and filtered in one expression: the pieces that are no terms are never written into a row.
    # Few terms are in the lexicon: only these are tested twice.
    kept = text_base.select(*keys, tokens_of(clean, words).alias("kept"))
    found = kept.select(*keys, F.size("kept").cast("long").alias("terms"), F.filter("kept", lambda t: t.isin(*lexicon)).alias("hits"))
    counts = F.struct(
        size("hits", lambda t: t.isin(*positive)).alias("positive_token_count"),
        size("hits", lambda t: t.isin(*negative)).alias("negative_token_count"),
        F.col("terms").alias("token_count"),
    )
    # The generator computes the counts once; a plain filter on them would be
    # pushed below the projection and cost a second tokenisation.
    counted = found.select(*keys, F.inline_outer(F.array(counts))).filter(F.col("token_count") > 0)
    if merge_repeats:
        counted = counted.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in COUNTS])
    score = F.col("positive_token_count") - F.col("negative_token_count")
    return counted.withColumn("sentiment_score", score).withColumn(
        "sentiment_score_per_token", F.round(F.col("sentiment_score") / F.col("token_count"), 4)
    )


def sentiment_sums(scored: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Additive sentiment totals per group. Everything is a whole number, the
    per-token score too (a multiple of 1/10000), so no total depends on row order."""
    points = F.round(F.col("sentiment_score_per_token") * SCALE).cast("long")
    return scored.groupBy(*dims).agg(
        F.count("*").alias("comments"),
        F.sum("positive_token_count").alias("positive"),
        F.sum("negative_token_count").alias("negative"),
        F.sum("sentiment_score").alias("score"),
        F.sum(points).alias("points"),
    )


def sentiment_means(sums: DataFrame, dim: str) -> DataFrame:
    """Mean sentiment per group from totals at that grain or a finer one."""

    def mean(name: str, dp: int = 2, scale: int = 1) -> Column:
        return F.round(F.sum(name) / F.sum("comments") / scale, dp)

    return sums.groupBy(dim).agg(
        F.sum("comments").alias("total_comments"),
        mean("positive").alias("avg_positive_tokens"),
        mean("negative").alias("avg_negative_tokens"),
        mean("score").alias("avg_sentiment_score"),
        mean("points", 4, SCALE).alias("avg_sentiment_score_per_token"),
    )


def sentiment_by(scored: DataFrame, dim: str) -> DataFrame:
    return sentiment_means(sentiment_sums(scored, [dim]), dim)
