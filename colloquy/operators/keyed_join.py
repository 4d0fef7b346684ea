"""Attach a per-key table to a fact table whose keys may be very uneven.

The per-key table knows how many fact rows each key has. One small aggregate over
it decides the strategy:

* the table's measured size is under a limit: broadcast it;
* no key is hot: a plain shuffle join, which adaptive execution tunes;
* some keys are hot: a key holding a share s of all rows gets ceil(s * slots)
  salts, so its rows spread over that many partitions. Fewer than ``slots`` keys
  can be hot, which bounds the broadcast list of salt counts, and the salted
  per-key table has fewer than ``slots`` extra rows plus one per hot key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_LIMIT = 32 * 1024 * 1024


def attach_by_key(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    rows: str,
    how: str = "inner",
    spread_by: Sequence[str] = ("id",),
    slots: int | None = None,
    broadcast_limit: int = BROADCAST_LIMIT,
    wide: bool = False,
) -> DataFrame:
    """Join ``dim`` (one row per ``key``, a written table) to ``fact`` on ``key``.

    ``rows`` is the column of ``dim`` holding the key's number of fact rows.
    ``spread_by`` are fact columns that tell rows of one key apart; the
    salt is a hash of them, so a recomputed task repeats it. ``wide`` fact rows (with
    texts) are shuffled but not sorted: a task hashes its part of ``dim`` instead.
    """
    spark = fact.sparkSession
    slots = slots or int(spark.conf.get("spark.sql.shuffle.partitions"))
    known = dim.filter(F.col(key).isNotNull())
    facts = _measure(known, rows)
    total = facts["total"] or 0

    if (facts["bytes"] or 0) <= broadcast_limit:
        return fact.join(F.broadcast(known), key, how)

    salts = F.ceil(F.col(rows) * slots / F.lit(max(total, 1))).cast("int")
    if (facts["largest"] or 0) * slots <= total and how == "inner":
        return fact.join(known.hint("shuffle_hash") if wide else known, key, how)

    hot = known.select(key, salts.alias("_salts")).filter(F.col("_salts") > 1)
    spread = F.xxhash64(*spread_by)
    # Rows without a key match nothing, but must not pile up in one partition.
    width = F.when(F.col(key).isNull(), F.lit(slots)).otherwise(F.coalesce(F.col("_salts"), F.lit(1)))
    salted_fact = (
        fact.join(F.broadcast(hot), key, "left")
        .withColumn("_salt", F.pmod(spread, width.cast("long")).cast("int"))
        .drop("_salts")
    )
    copies = F.sequence(F.lit(0), F.greatest(salts, F.lit(1)) - 1)
    salted_dim = known.withColumn("_salt", F.explode(copies))
    salted_dim = salted_dim.hint("shuffle_hash") if wide else salted_dim
    return salted_fact.join(salted_dim, [key, "_salt"], how).drop("_salt")


def _measure(dim: DataFrame, rows: str) -> dict:
    """Total and largest number of fact rows, and the table's size in memory."""
    return (
        dim.agg(
            F.sum(rows).alias("total"),
            F.max(rows).alias("largest"),
            F.sum(_row_bytes(dim)).alias("bytes"),
        )
        .first()
        .asDict()
    )


def _row_bytes(dim: DataFrame) -> Column:
    """Bytes of a row: 8 per column plus 16 of header, plus its string contents."""
    size = F.lit(16 + 8 * len(dim.columns)).cast("long")
    for name, kind in dim.dtypes:
        if kind == "string":
            size = size + F.coalesce(F.octet_length(name), F.lit(0))
    return size
