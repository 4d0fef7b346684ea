"""Events along time: running values, as-of joins, sessions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.operators.running import running
from colloquy.staging import stage


def author_course(comments: DataFrame) -> DataFrame:
    """Each comment with its place among its author's comments, the seconds since the one before and the flags
    so far. Comments of one second go by their id; those without an author have no course and are left out."""
    known = comments.filter(F.col("author").isNotNull()).select("id", "author", "created_utc", "controversiality")
    along = running(
        stage(known, "authored"), "author", ("created_utc", "id"),
        sums={"place": F.lit(1).cast("long"), "flags_so_far": F.col("controversiality").cast("long")}, lags={"before": F.col("created_utc")},
    )
    return along.select("id", "author", "place", (F.col("created_utc") - F.col("before")).alias("seconds_since_last"), "flags_so_far")


def as_of(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_time: str,
    right_time: str,
    values: Mapping[str, str],
    ties: Sequence[str] = (),
    inclusive: bool = True,
    slots: int | None = None,
) -> DataFrame:
    """Every row of ``left`` with ``values`` (new name to column of ``right``) of the last row of ``right`` of its key
    that is not later (``inclusive``) or is earlier; NULLs where there is none, or the key or time is
    NULL. Of rows of ``right`` at one time the last by ``ties`` counts.

    Both sides are put in one order and the last row of ``right`` is carried along, also from one task to the
    next: a key with very many rows is spread over tasks, and nothing is joined.
    """
    carried = F.struct(*[F.col(f"right {column}").alias(name) for name, column in values.items()])
    # At equal times, rows of the side that counts for the other come first.
    side = {"left": 1 if inclusive else 0, "right": 0 if inclusive else 1}
    kept = left.columns
    one = left.select(F.col(key).alias("on"), F.col(left_time).alias("time"), F.lit(side["left"]).alias("side"), F.struct(*kept).alias("row"))
    columns = dict.fromkeys([*values.values(), *ties])
    other = right.filter(F.col(key).isNotNull() & F.col(right_time).isNotNull())
    other = other.select(F.col(key).alias("on"), F.col(right_time).alias("time"), F.lit(side["right"]).alias("side"), *[F.col(c).alias(f"right {c}") for c in columns])
    both = stage(one.unionByName(other, allowMissingColumns=True), "both-sides")
    order = ("time", "side", *[f"right {c}" for c in ties])
    joined = running(both, "on", order, lasts={"found": F.when(F.col("side") == side["right"], carried)}, slots=slots)
    met = F.col("on").isNotNull() & F.col("time").isNotNull()
    return joined.filter(F.col("side") == side["left"]).select("row.*", *[F.when(met, F.col("found")[name]).alias(name) for name in values])


def sessions(events: DataFrame, key: str, time: str, ties: Sequence[str], gap_seconds: int, measures: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per session: its ``key``, ``session`` (number within the key), ``session_start``, ``session_end``, ``events`` and
    ``measures`` (aggregates). A session ends where the next event is more than ``gap_seconds`` later. Events
    without a key or time are left out. ``ties`` order events of one time.

    Sessions are numbered by a running count of long gaps, so a key with very many events is spread
    over tasks, and a session that crosses a border between tasks is one.
    """
    known = stage(events.filter(F.col(key).isNotNull() & F.col(time).isNotNull()), "timed")
    order = (time, *ties)
    gapped = running(known, key, order, lags={"earlier": F.col(time)})
    # Differences of whole microseconds: no rounding decides.
    apart = F.unix_micros(F.col(time).cast("timestamp")) - F.unix_micros(F.col("earlier").cast("timestamp"))
    starts = F.col("earlier").isNull() | (apart > gap_seconds * 1_000_000)
    marked = stage(gapped.withColumn("starts", starts.cast("long")), "gaps")
    numbered = running(marked, key, order, sums={"session": F.col("starts")})
    found = [F.min(time).alias("session_start"), F.max(time).alias("session_end"), F.count(F.lit(1)).alias("events")]
    return numbered.groupBy(key, "session").agg(*found, *[value.alias(name) for name, value in (measures or {}).items()])
