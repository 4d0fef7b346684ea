"""Intermediate tables written to shared storage.

A written table is computed once, ends the lineage and outlives lost executors.
It goes to the folder the cluster names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress

from pyspark.sql import DataFrame, SparkSession

# Written tables may hold whole texts, which Spark's default packs little.
COMPRESSION = "zstd"

_scopes: list[str] = []
_roots: set[str] = set()


def staging_root(spark: SparkSession) -> str:
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    root = f"{configured.rstrip('/')}/colloquy/{spark.sparkContext.applicationId}"
    if root not in _roots:
        _roots.add(root)
        atexit.register(_delete_at_exit, spark, root)
    return root


def _delete_at_exit(spark: SparkSession, root: str) -> None:
    """What queries have staged outside any scope goes with the process that staged it."""
    with suppress(Exception):  # the session may be gone by then
        delete(spark, root)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a staged table, or a folder of them."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def new_path(spark: SparkSession, name: str) -> str:
    """A path nothing has been written to."""
    return "/".join([staging_root(spark), *_scopes[-1:], f"{name}-{uuid.uuid4().hex}"])


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and return the written table."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", COMPRESSION).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Another value of a session setting for the jobs that run inside the block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def shuffles_freed(spark: SparkSession):
    """Shuffle files of the jobs inside the block go when their job ends, not when the driver's collector finds them."""
    return setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


@contextmanager
def held(spark: SparkSession) -> Iterator[str]:
    """Tables staged inside the block lie in one folder, whose path this gives; whoever holds it
    deletes it when what was made of them has been written."""
    _scopes.append(f"held-{uuid.uuid4().hex}")
    try:
        yield f"{staging_root(spark)}/{_scopes[-1]}"
    finally:
        _scopes.pop()


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Delete the tables staged inside the block when it ends: a job's frames must
    be written out within it."""
    with held(spark) as folder:
        try:
            yield
        finally:
            delete(spark, folder)
