"""Data tests: each gives the rows that fail, so an empty result passes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    failed = F.lit(False)
    for c in columns:
        failed = failed | F.col(c).isNull()
    return df.where(failed)


def not_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys without nulls that more than one row has, and how many."""
    return df.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def orphans(df: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose non-null key no parent has."""
    return df.where(F.col(key).isNotNull()).join(parent.select(F.col(parent_key).alias("__parent")).distinct(), F.col(key) == F.col("__parent"), "left_anti")


def not_accepted(df: DataFrame, column: str, values: list) -> DataFrame:
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(values))


def failing(df: DataFrame, valid: Column) -> DataFrame:
    """Rows for which a rule is false; a rule that is null passes."""
    return df.where(~valid)


def freshness(df: DataFrame, loaded_at: str, now: Column, warn_hours: int, error_hours: int) -> DataFrame:
    """(newest, status) with status pass, warn or error by the age of the newest row; an empty source is an error."""
    newest = df.agg(F.max(loaded_at).alias("newest"))
    age = lambda hours: F.col("newest") >= now - F.make_dt_interval(F.lit(0), F.lit(hours))
    return newest.withColumn("status", F.when(age(warn_hours), "pass").when(age(error_hours), "warn").otherwise("error"))


def reconciled(left: DataFrame, right: DataFrame, keys: list[str], measures: list[str], tolerance: float = 1e-6) -> DataFrame:
    """Keys that one side lacks, or whose measures differ by more than the tolerance."""
    a = left.select(*keys, *[F.col(m).alias(f"left_{m}") for m in measures], F.lit(True).alias("__l"))
    b = right.select(*keys, *[F.col(m).alias(f"right_{m}") for m in measures], F.lit(True).alias("__r"))
    differs = F.col("__l").isNull() | F.col("__r").isNull()
    for m in measures:
        x, y = F.col(f"left_{m}"), F.col(f"right_{m}")
        differs = differs | ~x.eqNullSafe(y) & F.coalesce(F.abs(x - y) > tolerance, F.lit(True))
    return a.join(b, keys, "full").where(differs).drop("__l", "__r")
