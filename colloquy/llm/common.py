"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Words are runs of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Rows that cross to a Python worker at once. Texts have no upper bound, so a batch is
# kept far below Spark's default of 10,000 rows.
BATCH_ROWS = 512


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, UPPER.lower())


def word_count(text: Column) -> Column:
    """Number of words as long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def small_batches(spark: SparkSession) -> None:
    """Bound the rows of an Arrow batch for the rest of the session."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


@contextmanager
def batch_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Another bound for the jobs that run inside the block."""
    small_batches(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def without(df: DataFrame, names: Sequence[str]) -> list[str]:
    """Columns of ``df`` but ``names``; Spark resolves names without regard to case."""
    drop = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in drop]


def shield(df: DataFrame, known: Sequence[str], replaced: Sequence[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``df`` with all columns but ``known`` under names that no operator uses, without those in
    ``replaced``, and a function that gives the names back."""
    extra = [c for c in without(df, replaced) if c not in known]
    hidden = {f"extra {i}": c for i, c in enumerate(extra)}
    named = [F.col("`" + c.replace("`", "``") + "`").alias(h) for h, c in hidden.items()]
    return df.select(*known, *named), lambda result: result.withColumnsRenamed(hidden)


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, giving back at its end what Arrow keeps of the memory of its batches: workers outlive their
    tasks, and one keeps tens of megabytes from each stage on."""

    def run_and_release(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()

    return run_and_release


def append_columns(
    df: DataFrame,
    fields: Sequence[T.StructField],
    compute: Callable[[Iterator[pa.RecordBatch]], Iterator[Sequence[pa.Array]]],
    drop: Sequence[str] = (),
) -> DataFrame:
    """``df`` plus ``fields``, computed batch by batch in Python.

    ``compute`` gets an iterator of batches and yields the arrays of the new columns for
    each. Columns of the same name in ``df`` are replaced, ``drop`` is left out.
    """
    small_batches(df.sparkSession)
    keep = without(df, [f.name for f in fields] + list(drop))
    schema = T.StructType([df.schema[c] for c in keep] + list(fields))
    target = [(f.name, _arrow(f.dataType)) for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def tap() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                held.append(batch)
                yield batch

        for arrays in compute(tap()):
            batch = held.pop(0)
            kept = [batch.column(batch.schema.get_field_index(c)) for c in keep]
            new = [a if isinstance(a, pa.Array) else pa.array(a, t) for a, (_, t) in zip(arrays, target, strict=True)]
            yield pa.RecordBatch.from_arrays(kept + new, names=keep + [n for n, _ in target])

    return df.mapInArrow(released(run), schema)


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def texts(batch: pa.RecordBatch, column: str) -> list[str]:
    """The texts of a batch, null as the empty text."""
    return [t or "" for t in batch.column(column).to_pylist()]


# Rows of a few numbers each that may be broadcast: some tens of megabytes.
BROADCAST_ROWS = 500_000


def bounded(rows: DataFrame) -> DataFrame:
    """A written table of narrow rows, marked for broadcast if it is small enough; beyond that
    Spark joins by shuffling."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def _bits(key: str) -> tuple[Column, Column]:
    """The word of a sieve that a key falls in, and its bit there."""
    place = F.pmod(F.xxhash64(F.col(key)), F.lit(64 * BROADCAST_ROWS).cast("long"))
    return F.shiftright(place, 6), F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(63).cast("int"))


def sifted(rows: DataFrame, keys: DataFrame, key: str, how: str = "left_semi") -> DataFrame:
    """The rows whose key may be one of ``keys``, or with ``left_anti`` those whose key is none for sure, without
    moving them: the hashes of the keys are bits of at most ``BROADCAST_ROWS`` words, which are broadcast. Keys beyond
    some 30 bits a word let most rows pass, and rows are never lost."""
    word, bit = _bits(key)
    words = keys.select(word.alias("_word"), bit.alias("_bit")).groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    word, bit = _bits(key)
    return rows.join(F.broadcast(words), (word == F.col("_word")) & (F.col("_bits").bitwiseAND(bit) != 0), how)


def attached(rows: DataFrame, narrow: DataFrame, key: str) -> DataFrame:
    """``rows``, which hold texts, joined with a written table of narrow rows. Beyond what may be broadcast
    only rows whose key may be among those are shuffled."""
    if narrow.count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(narrow), key)
    return sifted(rows, narrow, key).join(narrow, key)


def without_keys(rows: DataFrame, dropped: DataFrame, key: str) -> DataFrame:
    """``rows``, which hold texts, without those whose key is in a written table; rows are shuffled as in :func:`attached`."""
    if dropped.count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(dropped), key, "left_anti")
    unsure = sifted(rows, dropped, key).join(dropped, key, "left_anti")
    return sifted(rows, dropped, key, "left_anti").select(*rows.columns).union(unsure.select(*rows.columns))
