"""Running totals and earlier values along the order of each key, however many rows a key has.

A window over a key holds all its rows in one task. Here keys with more than a task's share of the
rows are told apart first (fewer of them can exist than there are tasks). All others go through
one plain window. The rows of the hot keys are range partitioned by key and order, so that one key
covers many partitions; each partition works on its own rows, and what it owes to the
partitions before it (totals so far, the last row, the last known value) is carried over from a
table with one row per key and partition.

The order must be total within a key: rows that tie in all of its columns are in no defined order. NULL is a key of
its own, and sorts first in the order.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colloquy.staging import stage

PART = "_part"


def running(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    sums: Mapping[str, Column] | None = None,
    lags: Mapping[str, Column] | None = None,
    lasts: Mapping[str, Column] | None = None,
    slots: int | None = None,
) -> DataFrame:
    """``df`` (read several times: a written table, or cheap to read) with new columns:

    * ``sums``: total of the values up to and with the row; NULL counts as nothing;
    * ``lags``: the value of the row before, NULL in a key's first row;
    * ``lasts``: the last value up to and with the row that is not NULL.

    ``slots`` is the number of tasks (default: the session's shuffle partitions).
    """
    slots = slots or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = {"sum": dict(sums or {}), "lag": dict(lags or {}), "last": dict(lasts or {})}
    given = {f"{kind} of {name}": value for kind, of in wanted.items() for name, value in of.items()}
    rows, out = df.withColumns(given), [*df.columns, *(name for of in wanted.values() for name in of)]

    hot = hot_keys(df, key, slots)
    if hot.isEmpty():
        return _along(rows, [key], order, wanted).select(*out)
    is_hot = F.col(key).eqNullSafe(F.col("hot key"))
    cold = _along(rows.join(F.broadcast(hot), is_hot, "left_anti"), [key], order, wanted).select(*out)
    spread = rows.join(F.broadcast(hot), is_hot, "left_semi").repartitionByRange(slots, key, *order)
    placed = stage(spread.withColumn(PART, F.spark_partition_id()), "hot-rows")
    return cold.unionByName(_carried(placed, key, order, wanted).select(*out))


def hot_keys(df: DataFrame, key: str, slots: int) -> DataFrame:
    """Keys (``hot key``) that hold more than one in ``slots`` of the rows: fewer than ``slots``."""
    sizes = stage(df.groupBy(F.col(key).alias("hot key")).agg(F.count(F.lit(1)).alias("rows")), "key-sizes")
    return sizes.filter(F.col("rows") * slots > sizes.agg(F.sum("rows")).scalar()).select("hot key")


def _along(rows: DataFrame, by: Sequence[str], order: Sequence[str], wanted: Mapping[str, Mapping[str, Column]]) -> DataFrame:
    """The columns within groups of ``by``, each a bounded part of the rows."""
    line = Window.partitionBy(*by).orderBy(*order)
    so_far = line.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = {name: F.coalesce(F.sum(f"sum of {name}").over(so_far), F.lit(0)) for name in wanted["sum"]}
    found |= {name: F.lag(f"lag of {name}").over(line) for name in wanted["lag"]}
    found |= {name: F.last(f"last of {name}", ignorenulls=True).over(so_far) for name in wanted["last"]}
    if PART in by:
        found["_place"] = F.row_number().over(line)
    return rows.withColumns(found)


def _carried(placed: DataFrame, key: str, order: Sequence[str], wanted: Mapping[str, Mapping[str, Column]]) -> DataFrame:
    """The columns of hot keys: within a partition, plus what the partitions before hold."""
    at = F.struct(*order)
    ends = [F.sum(f"sum of {name}").alias(f"total {name}") for name in wanted["sum"]]
    ends += [F.max_by(F.struct(f"lag of {name}"), at).alias(f"end {name}") for name in wanted["lag"]]
    for name in wanted["last"]:
        value = F.col(f"last of {name}")
        ends.append(F.max_by(value, F.when(value.isNotNull(), at)).alias(f"known {name}"))
    parts = Window.partitionBy(key).orderBy(PART)
    before = parts.rowsBetween(Window.unboundedPreceding, -1)
    owed = [F.coalesce(F.sum(f"total {name}").over(before), F.lit(0)).alias(f"total {name}") for name in wanted["sum"]]
    owed += [F.lag(f"end {name}").over(parts)[f"lag of {name}"].alias(f"end {name}") for name in wanted["lag"]]
    owed += [F.last(f"known {name}", ignorenulls=True).over(before).alias(f"known {name}") for name in wanted["last"]]
    # At most one row per partition and one more per hot key.
    carry = placed.groupBy(key, PART).agg(F.count(F.lit(1)), *ends).select(F.col(key).alias("key of"), F.col(PART).alias("part of"), *owed)

    inner = _along(placed, [key, PART], order, wanted)
    joined = inner.join(F.broadcast(carry), F.col(key).eqNullSafe(F.col("key of")) & (F.col(PART) == F.col("part of")))
    found = {name: F.col(name) + F.col(f"total {name}") for name in wanted["sum"]}
    found |= {name: F.when(F.col("_place") == 1, F.col(f"end {name}")).otherwise(F.col(name)) for name in wanted["lag"]}
    found |= {name: F.coalesce(name, f"known {name}") for name in wanted["last"]}
    return joined.withColumns(found)
