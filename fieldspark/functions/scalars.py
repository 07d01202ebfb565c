"""Tolerant parses and other scalar rules of the staging models."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def timestamp_or_null(c: str) -> Column:
    """Zone-less timestamp of ISO text, its wall clock kept; null for anything else."""
    return F.expr(f"try_cast(`{c}` as timestamp_ntz)")


def utc_or_null(c: str) -> Column:
    """Zone-less UTC timestamp of ISO text with an offset; null for anything else."""
    return F.expr(f"cast(to_utc_timestamp(try_cast(`{c}` as timestamp), current_timezone()) as timestamp_ntz)")


def date_or_null(c: str) -> Column:
    return F.expr(f"try_cast(`{c}` as date)")


def integer_or_null(c: str) -> Column:
    return F.expr(f"try_cast(`{c}` as bigint)")


def id_of_float(c: Column) -> Column:
    """An id that arrives as a float because other rows have none: NaN is null."""
    return F.when(~F.isnan(c), c).cast("long")


def json_or_null(c: str) -> Column:
    return F.try_parse_json(F.col(c))


def at_path(c: str | Column, path: str, kind: str) -> Column:
    """The value at a path of a variant as ``kind``; null where it is missing, JSON null or of another kind."""
    return F.try_variant_get(F.col(c) if isinstance(c, str) else c, path, kind)


def is_truthy(c: Column) -> Column:
    """Whether loose text says true; false for null."""
    return F.coalesce(F.lower(F.trim(c.cast("string"))).isin("true", "1", "yes", "y", "t"), F.lit(False))


def safe_ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is null or zero."""
    return a / F.nullif(b, F.lit(0).cast("double"))


def versus(a: Column, b: Column) -> Column:
    """Both names with " vs " between; null where either is."""
    return F.concat(a, F.lit(" vs "), b)


def season_year(c: Column) -> Column:
    """The year in which a season like 2023, 23/24 or 2023/2024 begins; null for other text."""
    head = F.try_element_at(F.split(F.trim(c), "/"), F.lit(1))
    year = F.when(head.rlike(r"^\d{4}$"), head.try_cast("int")).when(head.rlike(r"^\d{2}$"), head.try_cast("int") + 2000)
    return year


def truncated(c: Column, n: int) -> Column:
    return F.substring(c, 1, n)


def cleaned_columns(df: DataFrame) -> DataFrame:
    """Column names in upper case with one underscore for each run of other characters, none at the ends."""
    return df.toDF(*[re.sub(r"[^0-9A-Za-z]+", "_", c).strip("_").upper() for c in df.columns])
