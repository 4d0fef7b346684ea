"""Exact quantiles of groups by histograms that narrow round by round.

Each number has a whole-number code in the same order. A round counts, for each group and
quantile, the rows in equal cells between the bounds at hand, over all tasks and combined map-side; the cell in
which the wanted rank lies gives closer bounds for the next. A round narrows the bounds by ``BITS`` bits at
least, so it takes five at most, however the values lie. What is shuffled is cells, never
rows, and no task orders the values of a group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colloquy.operators.keyed_join import attach_by_key
from colloquy.staging import stage

# Cells of a histogram: 2 ** BITS, and one more at a border.
BITS = 14
WHOLE = ("tinyint", "smallint", "int", "bigint")
# Fixed by the format of double-precision numbers.
MANTISSA, BIAS, SMALLEST = 2.0**52, 1023, 2.0**-1022


def order_code(value: Column, kind: str) -> Column:
    """A long in the order of the values: whole numbers as they are, others by the bits of their double
    (exponent, then mantissa; negative ones mirrored). -0.0 is 0.0; NaN comes last."""
    if kind in WHOLE:
        return value.cast("long")
    x = value.cast("double")
    size = F.abs(x)
    # The logarithm may be off by one at powers of two; scaling by a power of two is exact.
    near = F.greatest(F.least(F.floor(F.log2(size)), F.lit(BIAS)), F.lit(1 - BIAS)).cast("double")
    scaled = size / F.pow(F.lit(2.0), near)
    exponent = near + F.when(scaled >= 2, 1).when(scaled < 1, -1).otherwise(0)
    normal = (exponent + BIAS) * MANTISSA
    fraction = (size / F.pow(F.lit(2.0), exponent) - 1) * MANTISSA
    code = (
        F.when(size == 0, F.lit(0).cast("long"))
        .when(F.isnan(x), F.lit(2047 * 2**52 + 2**51))
        .when(size == float("inf"), F.lit(2047 * 2**52))
        .when(size < SMALLEST, (size * 2.0**537 * 2.0**537).cast("long"))
        .otherwise(normal.cast("long") + fraction.cast("long"))
    )
    return F.when(x < 0, -code).otherwise(code)


def _shift(low: Column, high: Column) -> Column:
    """How many lower bits a cell leaves out, so that at most 2 ** BITS + 1 cells lie between the bounds."""
    half = F.shiftright(high, 1) - F.shiftright(low, 1)
    return F.greatest(F.length(F.bin(half)) + 1 - BITS, F.lit(0))


def quantiles(df: DataFrame, group: Sequence[str], value: str, shares: Mapping[str, tuple[int, int]]) -> DataFrame:
    """One row per group with the quantiles named in ``shares`` (numerator, denominator): the least value that so large a
    share of the known values do not exceed. NULL values count for nothing; a group without a known one has NULLs.

    ``df`` is a written table, or cheap to read: each round reads it.
    """
    names = [f"of {c}" for c in group]
    code = order_code(F.col(value), dict(df.dtypes)[value])
    rows = df.select(*[F.col(c).alias(n) for c, n in zip(group, names, strict=True)], F.col(value).alias("value"), code.alias("code"))
    rows = stage(rows.withColumns({"group": F.xxhash64(*names), "at": F.monotonically_increasing_id()}), "quantile-values")
    known = rows.filter(F.col("value").isNotNull())

    wanted = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(a).alias("a"), F.lit(b).alias("b")) for n, (a, b) in shares.items()])
    every = known.groupBy("group", *names).agg(F.count(F.lit(1)).alias("rows"), F.min("code").alias("low"), F.max("code").alias("high"), F.min("value").alias("found"))
    rank = F.greatest(F.ceil(F.col("share.a") * F.col("rows") / F.col("share.b")), F.lit(1)).cast("long")
    if any(b > 2**20 for _, b in shares.values()):
        raise ValueError("shares are ratios of small whole numbers")
    state = every.withColumn("share", F.explode(wanted)).withColumns({"name": F.col("share.name"), "rank": rank}).drop("share")
    state, ready = stage(state, "quantile-bounds"), []
    while True:
        ready.append(state.filter(F.col("low") == F.col("high")))
        state = state.filter(F.col("low") < F.col("high"))
        if state.isEmpty():
            break
        state = stage(_narrowed(known, state, names), "quantile-bounds")
    done = reduce(DataFrame.unionByName, ready)
    found = done.groupBy(*names).agg(*[F.max(F.when(F.col("name") == n, F.col("found"))).alias(n) for n in shares])
    same = reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(f"group {n}")) for n in names])
    found = found.select(*[F.col(n).alias(f"group {n}") for n in names], *shares)
    groups = rows.select(*names).distinct()
    return groups.join(found, same, "left").select(*[F.col(n).alias(c) for c, n in zip(group, names, strict=True)], *shares)


def _narrowed(known: DataFrame, state: DataFrame, names: Sequence[str]) -> DataFrame:
    """The cell of each group and quantile in which its rank lies, as the bounds of the codes in it."""
    bounds = state.select("group", *[F.col(n).alias(f"group {n}") for n in names], "rows", "name", "rank", "low", "high", _shift(F.col("low"), F.col("high")).alias("bits"))
    met = attach_by_key(known, stage(bounds, "quantile-cells"), "group", "rows", spread_by=("at",))
    # Hashes bring them together; the columns decide.
    same = reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(f"group {n}")) for n in names])
    inside = met.filter(same & F.col("code").between(F.col("low"), F.col("high")))
    keys = ["group", *names, "rows", "name", "rank"]
    cells = inside.groupBy(*keys, F.expr("shiftright(code, bits)").alias("cell")).agg(
        F.count(F.lit(1)).alias("n"), F.min("code").alias("low"), F.max("code").alias("high"), F.min("value").alias("found")
    )
    until = F.sum("n").over(Window.partitionBy("group", *names, "name").orderBy("cell"))
    placed = cells.withColumn("until", until).filter((F.col("until") - F.col("n") < F.col("rank")) & (F.col("rank") <= F.col("until")))
    return placed.withColumn("rank", F.col("rank") - (F.col("until") - F.col("n"))).select("group", *names, "rows", "low", "high", "found", "name", "rank")
