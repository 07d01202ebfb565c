"""Session settings that the models rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.caseSensitive": "false",
}


def session(master: str | None = None, shuffle_partitions: int | None = None, **more: str) -> SparkSession:
    """A session with ``SETTINGS``; on a cluster the master and the sizes come from spark-submit."""
    builder = SparkSession.builder.appName("fieldspark")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", shuffle_partitions)
    for key, value in {**SETTINGS, **more}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
