"""Spark session settings shared by every job."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

DEFAULTS = {
    # Calendar parts are defined on UTC wall time.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

OBJECT_STORE = {
    "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
    "spark.hadoop.fs.s3a.aws.credentials.provider": "com.amazonaws.auth.InstanceProfileCredentialsProvider",
}


def build_session(
    app: str,
    master: str | None = None,
    conf: Mapping[str, str] | None = None,
    object_store: bool = False,
) -> SparkSession:
    """Open a session. ``conf`` wins over the defaults; sizes (memory, cores,
    shuffle partitions) are the cluster's business and come from it or ``conf``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**DEFAULTS, **(OBJECT_STORE if object_store else {}), **(conf or {})}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> None:
    """Calendar parts depend on the session zone; every plan runs in UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
