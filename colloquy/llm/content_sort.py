"""Exact duplicates by sorting the contents.

Texts are normalised, dealt out by sampled splitters and sorted in each partition, which Spark
does externally. Equal texts are then neighbours, and one pass that compares each text in full
with the one before cuts the rows into runs. The splitters are the first bytes of the text, of
its digest and the identifier: Spark gathers a sample of them on the driver, where whole texts
would not fit. Identifiers are part of them, so a group with a third of all rows is spread over
a third of the partitions; runs that meet at a border of two partitions are joined by comparing
the last text of one with the first of the next.

Only the sort moves texts. To mark duplicates the pass writes one small row per document, and the per-run
summaries that decide who stays have one row per run and partition; to drop them it writes the first
row of each run.

Rows: null counts as the empty text, and all empty texts are one group. Of equal texts the row
with the smallest (or largest) identifier stays; a null identifier stays only where the group
has no other. Of rows equal in text and identifier one stays. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colloquy.llm.common import ascii_lower, shield, small_batches, texts, without
from colloquy.staging import stage

# What the pass over sorted texts gives for each row.
PLACES = T.StructType(
    [
        T.StructField("_part", T.IntegerType()),
        T.StructField("_run", T.LongType()),
        T.StructField("_border", T.IntegerType()),
        T.StructField("_edge", T.BinaryType()),
    ]
)
FIRST, LAST = 1, 2
# Bytes of the text, and digits of its digest, in a splitter.
HEAD = 16


def mark_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", keep: str = "smallest") -> DataFrame:
    """``docs`` without its text, with ``keep_id`` (of the row that stays), ``group_size``, ``kept`` and
    ``text_sha256`` of the normalised text. Columns of ``docs`` called so are replaced."""
    docs, restore = shield(docs, [key, text], ["keep_id", "group_size", "kept", "text_sha256"])
    own = without(docs, [text])
    placed = stage(_sorted_runs(docs, text, key, keep, own, digest=True), "content-sort")

    best = F.min(key) if keep == "smallest" else F.max(key)
    runs = placed.groupBy("_part", "_run").agg(best.alias("_best"), F.count(F.lit(1)).alias("_n"))
    groups = runs.join(F.broadcast(_joined_runs(placed)), ["_part", "_run"], "left").select(
        "_part",
        "_run",
        "_best",
        "_n",
        F.coalesce("_home_part", "_part").alias("_home_part"),
        F.coalesce("_home_run", "_run").alias("_home_run"),
    )
    best = F.min("_best") if keep == "smallest" else F.max("_best")
    home = Window.partitionBy("_home_part", "_home_run")
    decided = groups.select(
        "_part",
        "_run",
        best.over(home).alias("keep_id"),
        F.sum("_n").over(home).alias("group_size"),
        # Runs of one group follow each other in the order of identifiers: its first row stays.
        ((F.col("_part") == F.col("_home_part")) & (F.col("_run") == F.col("_home_run"))).alias("_leads"),
    )
    first_of_run = F.col("_border").bitwiseAND(FIRST) != 0
    kept = F.col("_leads") & first_of_run
    return restore(placed.join(decided, ["_part", "_run"]).select(*own, "keep_id", "group_size", kept.alias("kept"), "text_sha256"))


def without_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", keep: str = "smallest") -> DataFrame:
    """The rows of ``docs`` that stay, with their texts. The first row of each run stays, but where the run goes on from
    the partition before: no text moves after the sort, and only one row per partition is joined."""
    docs, restore = shield(docs, [key, text], [])
    placed = _sorted_runs(docs, text, key, keep, docs.columns, digest=False)
    border = F.col("_border") != 0
    placed = stage(placed.filter(border | F.col("_edge").isNotNull()), "content-sort")
    goes_on = F.broadcast(_joined_runs(placed).select("_part", "_run"))
    first = placed.filter(F.col("_border").bitwiseAND(FIRST) != 0)
    return restore(first.join(goes_on, ["_part", "_run"], "left_anti").select(*docs.columns))


def _sorted_runs(docs: DataFrame, text: str, key: str, keep: str, own: list[str], digest: bool) -> DataFrame:
    """Columns ``own`` (and ``text_sha256``) of all rows, sorted by text and cut into runs of equal texts (:data:`PLACES`)."""
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep: {keep}")
    small_batches(docs.sparkSession)
    body = ascii_lower(F.coalesce(F.col(text), F.lit("")))
    order = F.col(key).asc_nulls_last() if keep == "smallest" else F.col(key).desc_nulls_last()
    # The number of partitions follows the session, not adaptive merging, which counts bytes only.
    slots = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Sort keys are columns: a sort by expressions would compute them in every comparison.
    # The normalised text is made after the shuffle, which moves each text once.
    whole = docs.select(*own, *([] if text in own else [text])).withColumn("text_sha256", F.sha2(body, 256))
    given = [*own, "text_sha256"] if digest else own
    ordered = (
        whole.withColumns({"_head": F.substring(F.encode(body, "UTF-8"), 1, HEAD), "_mark": F.substring("text_sha256", 1, HEAD)})
        .repartitionByRange(slots, "_head", "_mark", order)
        .withColumn("_body", F.encode(body, "UTF-8"))
        .sortWithinPartitions("_head", "_mark", "_body", order)
        .select(*given, *([] if text in given else [text]))
    )
    return ordered.mapInArrow(_places(given, text), T.StructType([ordered.schema[c] for c in given] + PLACES.fields))


def _places(names: list[str], text: str):
    """Cut the sorted rows of a partition into runs of equal texts. ``_border`` marks the first
    row of a run; ``_edge`` holds the text of the first and the last row of the partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        before, number, held = None, -1, None
        for batch in batches:
            if not batch.num_rows:
                continue
            # Bytes lower-case A-Z alone.
            bodies = [t.encode().lower() for t in texts(batch, text)]
            numbers, borders, edges = [], [], [None] * batch.num_rows
            if before is None:
                edges[0] = bodies[0]
            for body in bodies:
                new = body != before
                number += new
                numbers.append(number)
                borders.append(FIRST if new else 0)
                before = body
            if held is not None:
                yield _batch(*held)
            held = (batch, names, part, numbers, borders, edges)
        if held is not None:
            held[-1][-1] = before
            held[-2][-1] |= LAST
            yield _batch(*held)

    return run


def _batch(batch: pa.RecordBatch, names: list[str], part: int, numbers: list, borders: list, edges: list) -> pa.RecordBatch:
    kept = [batch.column(n) for n in names]
    new = [
        pa.array([part] * batch.num_rows, pa.int32()),
        pa.array(numbers, pa.int64()),
        pa.array(borders, pa.int32()),
        pa.array(edges, pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(kept + new, names=[*names, *PLACES.names])


def _joined_runs(placed: DataFrame) -> DataFrame:
    """For each partition's first run that continues the run before it: the partition and
    run where that group begins. At most one row per partition.

    The two texts at each border are compared in full; only numbers of partitions and
    runs go through the one-task window after that, two rows per partition.
    """
    edges = placed.filter(F.col("_edge").isNotNull())
    heads = edges.filter((F.col("_run") == 0) & (F.col("_border").bitwiseAND(FIRST) != 0)).select("_part", F.col("_edge").alias("_head"))
    tails = edges.filter(F.col("_border").bitwiseAND(LAST) != 0).select("_part", F.col("_run").alias("_last"), F.col("_edge").alias("_tail"))
    # Partitions that hold rows follow each other in this order; empty ones do not count.
    line = Window.orderBy("_part")
    follows = tails.select("_part", F.lag("_part").over(line).alias("_prior")).filter(F.col("_prior").isNotNull())
    same = (
        follows.join(heads, "_part")
        .join(tails.select(F.col("_part").alias("_prior"), "_tail"), "_prior")
        .filter(F.col("_head") == F.col("_tail"))
        .select("_part", F.lit(True).alias("_same"))
    )
    chain = tails.select("_part", "_last").join(same, "_part", "left")
    # The last run of a partition begins there, unless the partition is one run that continues.
    begins = F.when(F.col("_same").isNull() | (F.col("_last") > 0), F.struct("_part", "_last"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return (
        chain.withColumn("_home", F.last(begins, ignorenulls=True).over(before))
        .filter(F.col("_same"))
        .select("_part", F.lit(0).cast("long").alias("_run"), F.col("_home._part").alias("_home_part"), F.col("_home._last").alias("_home_run"))
    )
