"""Text cleaning and tokens, all inside the JVM."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import cache

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# One pass instead of five. Every maximal run of
#   - characters other than a-z and 0-9,
#   - "http" links up to the next white space,
#   - "www." links up to the next white space or the start of an "http" link
# becomes one space. The quantifiers are possessive: nothing follows the run, so
# giving characters back is useless, and long runs cannot exhaust the stack. The
# look-ahead rules out most letters with a single test.
NOISE = r"(?=[hw[^a-z0-9]])(?:[^a-z0-9]++|http\S++|www\.(?:(?!http\S)\S)++)++"
# What NOISE comes to in a text without links, at half the price.
PLAIN_NOISE = r"[^a-z0-9]++"

MIN_TERM_LENGTH = 3
# Pieces of more bytes are cleaned before they are counted: links and long runs seldom repeat.
LONG_PIECE = 32


def clean_text(body: str | Column) -> Column:
    """Lower-case words separated by single spaces, without links and symbols."""
    text = F.lower(body)
    noise = F.when(F.contains(text, F.lit("http")) | F.contains(text, F.lit("www.")), NOISE).otherwise(PLAIN_NOISE)
    return F.trim(F.regexp_replace(text, noise, F.lit(" ")))


def word_count(body: str | Column) -> Column:
    """Pieces between white space: an empty string is one piece, and white space at either
    end adds an empty one. NULL for NULL."""
    text = F.col(body) if isinstance(body, str) else body
    return F.when(text.isNotNull(), F.size(F.split(text, r"\s+", -1)))


def clean_word_count(clean: str | Column) -> Column:
    """Words in a cleaned text; 0 when nothing is left."""
    text = F.col(clean) if isinstance(clean, str) else clean
    return F.when(F.length(text) > 0, F.size(F.split(text, " "))).otherwise(0)


@cache
def english_stop_words() -> tuple[str, ...]:
    return tuple(StopWordsRemover.loadDefaultStopWords("english"))


def is_term(token: Column, stop: Sequence[str], min_len: int = MIN_TERM_LENGTH) -> Column:
    """Long enough, not a number, not a stop word."""
    # What sorts after the digits is no number: few tokens need the pattern.
    number = (token < ":") & token.rlike(r"^\d+$")
    return (F.length(token) >= min_len) & ~number & ~token.isin(*stop)


def tokens_of(clean: str | Column, stop: Sequence[str] | None = None, min_len: int = MIN_TERM_LENGTH) -> Column:
    """The terms of a cleaned text, in order and with repeats."""
    words = english_stop_words() if stop is None else stop
    text = F.col(clean) if isinstance(clean, str) else clean
    # A filter with a lambda is interpreted, with all that it holds. What is asked for twice is
    # computed below it: so the cleaning of the text stays compiled, and lower case is taken once.
    return F.when(text.isNotNull(), F.filter(F.split(text, " "), lambda t: is_term(t, words, min_len)))


def explode_pieces(df: DataFrame, keep: Sequence[str], body: str = "body", stop: Sequence[str] | None = None, min_len: int = MIN_TERM_LENGTH) -> DataFrame:
    """One row per piece of ``body`` between blanks and line ends, mostly as written. No link and no symbol
    reaches past white space, so the terms of a text are those of its pieces, cleaned one by one, and pieces may be
    counted before they are cleaned. Some that hold no term are left out; lower case makes no piece's words longer."""
    words = english_stop_words() if stop is None else stop
    lines = df.select(*keep, F.explode(F.split(body, "\n")).alias("_line"))
    pieces = lines.select(*keep, F.explode(F.split("_line", " ")).alias("piece"))
    plain = [word for word in words if re.fullmatch("[a-z0-9]+", word)]
    kept = pieces.filter((F.octet_length("piece") >= min_len) & ~F.col("piece").isin(plain))
    # After the filter: one above it would repeat the cleaning.
    short = F.when(F.octet_length("piece") > LONG_PIECE, clean_text("piece")).otherwise(F.col("piece"))
    return kept.withColumn("piece", short)


def explode_tokens(
    df: DataFrame,
    keep: Sequence[str],
    clean: str = "body_clean",
    stop: Sequence[str] | None = None,
    min_len: int = MIN_TERM_LENGTH,
) -> DataFrame:
    """One row per term. Terms are filtered after the explode, where the tests
    are compiled, not in an interpreted lambda."""
    words = english_stop_words() if stop is None else stop
    rows = df.select(*keep, F.explode(F.split(clean, " ")).alias("token"))
    return rows.filter(is_term(F.col("token"), words, min_len))
