"""Token totals for every context limit from one exact length histogram.

Documents are encoded by a public vocabulary and aggregated to one row per encoded length.
Suffix sums over that histogram answer totals, quantiles and truncated totals for every
limit without another look at the documents.

The suffix sums run in two levels, so that no task sees the whole histogram: lengths fall
into blocks of ``BLOCK``; a window within each block adds up its lengths, and a window over
the few block totals adds what lies beyond.

Rows: a null text counts as empty, an empty text has length 0 and is counted; repeated rows
count each; an empty table gives no rows. The result holds no column of the input.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colloquy.llm.common import append_columns, texts

BLOCK = 256


@lru_cache(maxsize=2)
def _encoding(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def with_length(docs: DataFrame, path: str, pattern: str, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """``docs`` without its text, with the number of tokens of the whole text as long."""

    def compute(batches: Iterator[pa.RecordBatch]):
        encode = _encoding(path, pattern).encode_ordinary
        for batch in batches:
            yield [[len(encode(t)) for t in texts(batch, text)]]

    return append_columns(docs, [T.StructField(out, T.LongType())], compute, (text,))


def histogram(lengths: DataFrame, length: str = "n_tokens") -> DataFrame:
    """One row per different length: ``n_tokens``, ``n_docs``. Null lengths count as 0."""
    return lengths.groupBy(F.coalesce(F.col(length), F.lit(0)).cast("long").alias("n_tokens")).agg(F.count(F.lit(1)).alias("n_docs"))


def suffix_sums(counts: DataFrame) -> DataFrame:
    """The histogram with, for each length:

    ``docs_at_least``, ``tokens_at_least``: documents of that length or more, and their tokens;
    ``truncated_tokens``: tokens that remain of all documents when each is cut to that length;
    ``docs_up_to``: documents that fit into that length whole, from which quantiles follow.

    ``counts`` is read twice: pass a written table.
    """
    block = F.floor(F.col("n_tokens") / BLOCK)
    rows = counts.select("n_tokens", "n_docs", block.alias("_block"))
    # One row per block of lengths: as many as the longest document has blocks.
    blocks = rows.groupBy("_block").agg(F.sum("n_docs").alias("_docs"), F.sum(F.col("n_docs") * F.col("n_tokens")).alias("_tokens"))
    beyond = Window.orderBy(F.desc("_block")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    blocks = blocks.select(
        "_block",
        F.coalesce(F.sum("_docs").over(beyond), F.lit(0)).alias("_docs_beyond"),
        F.coalesce(F.sum("_tokens").over(beyond), F.lit(0)).alias("_tokens_beyond"),
        F.sum("_docs").over(everything).alias("_all_docs"),
        F.sum("_tokens").over(everything).alias("_all_tokens"),
    )
    inside = Window.partitionBy("_block").orderBy(F.desc("n_tokens"))
    docs = F.sum("n_docs").over(inside) + F.col("_docs_beyond")
    tokens = F.sum(F.col("n_docs") * F.col("n_tokens")).over(inside) + F.col("_tokens_beyond")
    return (
        rows.join(blocks, "_block")
        .select("n_tokens", "n_docs", docs.alias("docs_at_least"), tokens.alias("tokens_at_least"), "_all_docs", "_all_tokens")
        .select(
            "n_tokens",
            "n_docs",
            "docs_at_least",
            "tokens_at_least",
            (F.col("_all_tokens") - F.col("tokens_at_least") + F.col("n_tokens") * F.col("docs_at_least")).alias("truncated_tokens"),
            (F.col("_all_docs") - F.col("docs_at_least") + F.col("n_docs")).alias("docs_up_to"),
        )
    )


def answer_limits(counts: DataFrame, limits: Sequence[int]) -> DataFrame:
    """One row per stated context limit: ``context_limit``, ``truncated_tokens``, ``lost_tokens``,
    ``cut_docs``. Limits need not be lengths that occur."""
    asked = F.explode(F.array(*[F.lit(int(limit)).cast("long") for limit in sorted(set(limits))]))
    kept = F.least("n_tokens", "context_limit")
    return (
        counts.withColumn("context_limit", asked)
        .groupBy("context_limit")
        .agg(
            F.sum(F.col("n_docs") * kept).alias("truncated_tokens"),
            F.sum(F.col("n_docs") * (F.col("n_tokens") - kept)).alias("lost_tokens"),
            F.sum(F.when(F.col("n_tokens") > F.col("context_limit"), F.col("n_docs")).otherwise(0)).alias("cut_docs"),
        )
    )


def quantiles(sums: DataFrame, shares: Sequence[float]) -> DataFrame:
    """One row per share: ``share`` and ``n_tokens``, the least length that at least that share
    of the documents does not exceed."""
    total = sums.agg(F.max("docs_up_to")).first()[0] or 0
    asked = F.explode(F.array(*[F.lit(float(s)) for s in sorted(set(shares))]))
    return (
        sums.withColumn("share", asked)
        .filter(F.col("docs_up_to") >= F.col("share") * total)
        .groupBy("share")
        .agg(F.min("n_tokens").alias("n_tokens"))
    )
