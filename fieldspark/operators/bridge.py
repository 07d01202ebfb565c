"""The resolution bridge: one canonical id per (system, source id), manual overrides before ranked identities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldspark.operators.ranking import first_by, primary_first


def best_identities(identities: DataFrame, keys: list[str], canonical: str = "canonical_id", flag: str = "is_primary", confidence: str = "confidence", updated: str = "updated_at") -> DataFrame:
    """One identity per key: primary first, then the highest confidence, the newest, the least canonical id; nulls last."""
    order = [primary_first(F.col(flag)), F.col(confidence).desc_nulls_last(), F.col(updated).desc_nulls_last(), F.col(canonical).asc_nulls_last()]
    return first_by(identities, keys, order)


def resolutions(identities: DataFrame, overrides: DataFrame, keys: list[str], canonical: str = "canonical_id") -> DataFrame:
    """(keys, canonical id, resolution_source): the override where there is one, else the best identity; null ids go."""
    found = best_identities(identities, keys, canonical).select(*keys, F.col(canonical).alias("__found"))
    given = overrides.select(*keys, F.col(canonical).alias("__given"))
    return (
        given.join(found, keys, "full")
        .select(*keys, F.coalesce("__given", "__found").alias(canonical), F.when(F.col("__given").isNotNull(), "OVERRIDE").otherwise("IDENTITY").alias("resolution_source"))
        .where(F.col(canonical).isNotNull())
    )
