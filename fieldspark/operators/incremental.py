"""Incremental facts: the last days before the target's newest row are computed again and upserted."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldspark.operators.merge import upsert

#: What an empty target counts as having last.
NEVER = "1900-01-01 00:00:00"


def since_last(source: DataFrame, target: DataFrame, ts: str, target_ts: str, days: int) -> DataFrame:
    """Rows of ``source`` not older than ``days`` before the newest ``target_ts``; all of them for an empty target.

    The newest value is one row, which Spark broadcasts as a scalar subquery; no value goes through the driver.
    """
    newest = target.agg(F.coalesce(F.max(target_ts), F.lit(NEVER).cast(target.schema[target_ts].dataType)).alias("__newest"))
    return source.join(F.broadcast(newest), F.col(ts) >= F.col("__newest") - F.make_dt_interval(F.lit(days))).drop("__newest")


def reprocess(source: DataFrame, target: DataFrame, ts: str, keys: list[str], days: int, build: Callable[[DataFrame], DataFrame] = lambda df: df, target_ts: str | None = None) -> DataFrame:
    """The target after the rows built from the last days have been upserted by ``keys``."""
    return upsert(target, build(since_last(source, target, ts, target_ts or ts, days)), keys)
