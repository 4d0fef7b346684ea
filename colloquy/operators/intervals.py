"""Interval join: pairs of intervals that overlap, by bins of several widths.

An interval belongs to the level whose bins are the narrowest that are at least as long as it: it
touches two of them at most. Two intervals meet at the level of the longer one, where the
shorter one touches two bins at most, too. The levels are measured, not guessed: an interval is
copied to its own level and to the higher levels at which the other side has intervals. Equal bins are joined by
an equality, which Spark sorts and whose uneven bins adaptive execution splits; overlaps are then verified, and a pair is
taken in the bin that holds the later of the two starts, so once. Neither side is broadcast: Spark estimates the copies by
the bytes of the files they come from, which says little of their number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _level(start: Column, end: Column) -> Column:
    """Binary digits of the length: bins of level l are 2 ** l wide."""
    return F.length(F.bin(F.greatest(end - start, F.lit(1))))


def levels_of(df: DataFrame, start: str, end: str) -> list[int]:
    """The levels that occur, 63 at most."""
    return sorted(r[0] for r in df.select(_level(F.col(start), F.col(end))).distinct().collect())


def _in_bins(df: DataFrame, names: Sequence[str], start: str, end: str, on: Sequence[str], prefix: str, others: Sequence[int]) -> DataFrame:
    """Copies of each interval: a row per bin that it touches, at its own level and those in ``others`` above."""
    first, last = F.col(start).cast("long"), F.col(end).cast("long")
    known = df.select(F.struct(*names).alias(f"{prefix} row"), *[F.col(c).alias(f"{prefix} {c}") for c in on], first.alias(f"{prefix} start"), last.alias(f"{prefix} end"))
    known = known.filter(F.col(f"{prefix} start") <= F.col(f"{prefix} end"))
    own = _level(F.col(f"{prefix} start"), F.col(f"{prefix} end"))
    known = known.withColumn(f"{prefix} own", own)
    above = F.filter(F.array(*map(F.lit, others)) if others else F.array().cast("array<int>"), lambda level: level > F.col(f"{prefix} own"))
    known = known.withColumn(f"{prefix} level", F.explode(F.concat(F.array(F.col(f"{prefix} own")), above)))
    bins = [F.expr(f"shiftright(`{prefix} {at}`, `{prefix} level`)") for at in ("start", "end")]
    return known.withColumn(f"{prefix} bin", F.explode(F.sequence(*bins)))


def interval_join(
    left: DataFrame,
    right: DataFrame,
    left_span: tuple[str, str],
    right_span: tuple[str, str],
    on: Sequence[str] = (),
) -> DataFrame:
    """``left`` and ``right`` (structs) for each pair of rows whose closed intervals of whole numbers overlap and whose ``on`` columns
    are equal. Rows with a NULL bound or key, or an end before the start, meet nothing. Both sides are read twice."""
    left_levels, right_levels = levels_of(left, *left_span), levels_of(right, *right_span)
    a = _in_bins(left, left.columns, *left_span, on, "l", right_levels)
    b = _in_bins(right, right.columns, *right_span, on, "r", left_levels)
    same = (F.col("l level") == F.col("r level")) & (F.col("l bin") == F.col("r bin"))
    for c in on:
        same &= F.col(f"l {c}") == F.col(f"r {c}")
    overlap = (F.col("l start") <= F.col("r end")) & (F.col("r start") <= F.col("l end"))
    meet = (F.col("l level") == F.greatest("l own", "r own")) & (F.col("l bin") == F.expr("shiftright(greatest(`l start`, `r start`), `l level`)"))
    return a.join(b.hint("merge"), same & overlap & meet).select(F.col("l row").alias("left"), F.col("r row").alias("right"))
