"""Derived comment table, analysis subsets, counts and profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.functions.calendar import with_event_time, with_time_parts
from colloquy.functions.text import clean_text, clean_word_count, word_count
from colloquy.functions.validity import with_validity_flags
from colloquy.operators.quantiles import quantiles
from colloquy.schema import COMMENT_COLUMNS, TEXT_BASE_COLUMNS
from colloquy.staging import stage

SUBSETS = ("all", "text", "user", "text_user")


def filter_members(df: DataFrame, col: str, values: Sequence[str]) -> DataFrame:
    return df.filter(F.col(col).isin(*values))


def feature_base(comments: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Comments with time parts, body lengths and validity flags, and the further columns ``keep``."""
    timed = with_time_parts(with_event_time(comments.select(*COMMENT_COLUMNS, *keep)))
    sized = timed.withColumns({"body_length_chars": F.length("body"), "body_length_words": word_count("body")})
    return with_validity_flags(sized)


def in_subset(kind: str) -> Column:
    has_text = F.col("is_removed_or_deleted") == 0
    has_user = F.col("is_deleted_author") == 0
    return {"all": F.lit(True), "text": has_text, "user": has_user, "text_user": has_text & has_user}[kind]


def subset(df: DataFrame, kind: str) -> DataFrame:
    return df if kind == "all" else df.filter(in_subset(kind))


def valid_text_rows(df: DataFrame) -> DataFrame:
    """Both flags clear and a body that is not blank."""
    return subset(df, "text_user").filter(F.octet_length(F.trim("body")) > 0)


def nlp_text_base(features: DataFrame) -> DataFrame:
    """Valid rows with the cleaned text and its lengths."""
    cleaned = valid_text_rows(features).withColumn("body_clean", clean_text("body"))
    measured = with_event_time(cleaned, out="created_ts_utc").withColumns(
        {"clean_char_count": F.length("body_clean"), "clean_word_count": clean_word_count("body_clean")}
    )
    return measured.select(*TEXT_BASE_COLUMNS)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows"))


def run_summary(metrics: dict[str, Column], df: DataFrame) -> DataFrame:
    """(metric, value) rows of several aggregates from one pass over ``df``."""
    one_row = df.agg(*[expr.cast("long").alias(name) for name, expr in metrics.items()])
    return one_row.unpivot([], list(metrics), "metric", "value")


def subset_row_counts(df: DataFrame) -> DataFrame:
    """Sizes of the four subsets from one pass."""
    return run_summary({f"{kind}_df": F.count_if(in_subset(kind)) for kind in SUBSETS}, df)


def group_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows per group, largest first."""
    return df.groupBy(col).count().orderBy(F.desc("count"), F.asc(col))


def subset_group_counts(df: DataFrame, col: str) -> DataFrame:
    """:func:`group_counts` of all four subsets from one pass, in long form."""
    wide = df.groupBy(col).agg(*[F.count_if(in_subset(kind)).alias(kind) for kind in SUBSETS])
    return wide.unpivot([col], list(SUBSETS), "subset", "count").filter("count > 0")


def top_groups(df: DataFrame, col: str, n: int) -> DataFrame:
    return df.groupBy(col).count().orderBy(F.desc("count"), F.asc(col)).limit(n)


def distribution(df: DataFrame, col: str) -> DataFrame:
    """Rows per value, in value order."""
    return df.groupBy(col).count().orderBy(col)


def distributions(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows per value of several 0/1 columns, from one pass: the pass counts the
    combinations, and the few combinations are then counted per column."""
    combos = df.groupBy(*cols).agg(F.count("*").alias("n"))
    long = combos.unpivot(["n"], list(cols), "column", "value")
    return long.groupBy("column", "value").agg(F.sum("n").alias("count")).orderBy("column", "value")


def null_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row with the number of NULLs in each wanted column the frame has."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols if c in df.columns])


def distinct_count(df: DataFrame, col: str) -> DataFrame:
    """Number of different values; NULL counts as one of them."""
    return df.select(col).distinct().agg(F.count("*").alias(f"distinct_{col}"))


def clean_length_by(text_base: DataFrame, dim: str) -> DataFrame:
    """Mean cleaned length per group, from whole-number sums."""
    units = ("char", "word")
    totals = text_base.groupBy(dim).agg(
        *[F.sum(f"clean_{u}_count").alias(f"{u}s") for u in units], *[F.count(f"clean_{u}_count").alias(f"{u}_rows") for u in units]
    )
    means = {f"avg_clean_{u}_count": F.round(F.try_divide(F.col(f"{u}s"), F.col(f"{u}_rows")), 2) for u in units}
    return totals.select(dim, *[mean.alias(name) for name, mean in means.items()]).orderBy(F.desc("avg_clean_word_count"), F.asc(dim))


def length_stats(df: DataFrame, dim: str) -> DataFrame:
    """Mean and exact median length per group, for authored comments."""
    units = ("chars", "words")
    lengths = F.array(*[F.struct(F.lit(u).alias("unit"), F.col(f"body_length_{u}").alias("length")) for u in units])
    rows = stage(df.filter(F.col("author").isNotNull()).select(dim, F.explode(lengths).alias("of")).select(dim, "of.*"), "lengths")
    totals = rows.groupBy(dim, "unit").agg(F.count("*").alias("n"), F.sum("length").alias("total"), F.count("length").alias("known"))
    medians = quantiles(rows, [dim, "unit"], "length", {"median": (1, 2)})
    # One row per group and unit on either side.
    found = totals.select(F.col(dim).alias("group"), F.col("unit").alias("of"), "n", "total", "known").join(
        medians, F.col("group").eqNullSafe(F.col(dim)) & (F.col("of") == F.col("unit"))
    )

    def of(unit: str, value: Column) -> Column:
        return F.max(F.when(F.col("unit") == unit, value))

    aggregates = [of("chars", F.col("n")).alias("total_comments")]
    for unit in units:
        mean = F.round(F.try_divide(F.col("total"), F.col("known")), 2)
        aggregates += [of(unit, mean).alias(f"avg_body_length_{unit}"), of(unit, F.col("median")).cast("int").alias(f"median_body_length_{unit}")]
    return found.groupBy(dim).agg(*aggregates)
