"""Distinct counts that add up: a stored sketch per cell, united for any roll-up.

A sketch of fixed size stands for the set of values it has seen, and the union of sketches is the
sketch of the union: months or communities are counted together without reading a comment again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Registers of a sketch: 2 ** PRECISION; the error is about 1.04 / sqrt of that (one deviation).
PRECISION = 12
ERROR = 1.04 / 2 ** (PRECISION / 2)


def distinct_sketches(df: DataFrame, column: str, cells: Sequence[str]) -> DataFrame:
    """A sketch of the known values of ``column`` per cell: a small table, to be written."""
    return df.groupBy(*cells).agg(F.hll_sketch_agg(column, PRECISION).alias("sketch"))


def estimate_by(sketches: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Estimated distinct values at a coarser grain, from sketches alone."""
    united = sketches.groupBy(*dims).agg(F.hll_union_agg("sketch").alias("sketch"))
    return united.select(*dims, F.hll_sketch_estimate("sketch").alias("estimate"))
