"""Merges of a target table with a set of changes, as whole new states of the target.

Parquet has no MERGE: each function returns the target after the merge, to be written beside the old files and swapped
in (``sources.sinks.swap``). The changes have one row a key unless said otherwise; keys that are null match nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MATCHED, DEALT = "__matched", "__dealt"


def upsert(target: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """Changed rows replace the target's rows of their key, new ones are added; columns that one side lacks are null."""
    return target.join(changes.select(*keys), keys, "left_anti").unionByName(changes, allowMissingColumns=True)


def looked_up(rows: DataFrame, known: DataFrame, key: str, by: str) -> DataFrame:
    """``rows`` with what ``known`` has for their ``key``, a left join. Rows without a key, which find nothing, are dealt out by
    their ``by``: a plain join sends all of them to one task."""
    dealt = F.when(F.col(key).isNull(), F.xxhash64(by)).otherwise(0)
    return rows.withColumn(DEALT, dealt).join(known.withColumn(DEALT, F.col(key).isNull().cast("long")), [key, DEALT], "left").drop(DEALT)


def insert_only(target: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """Only rows with new keys are added; what is there stays."""
    return target.unionByName(missing(changes, target, keys), allowMissingColumns=True)


def missing(changes: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """The changes whose key the target lacks: what an idempotent insert appends."""
    return changes.join(target.select(*keys).distinct(), keys, "left_anti")


def update_only(target: DataFrame, changes: DataFrame, keys: list[str], columns: list[str], prefer_new: bool = False) -> DataFrame:
    """``columns`` of matched rows from the changes, also where those are null; with ``prefer_new`` null keeps the old."""
    new = changes.select(*keys, *[F.col(c).alias(f"__new_{c}") for c in columns], F.lit(True).alias(MATCHED))
    joined = target.join(new, keys, "left")
    value = lambda c: F.coalesce(f"__new_{c}", c) if prefer_new else F.when(F.col(MATCHED), F.col(f"__new_{c}")).otherwise(F.col(c))
    return joined.select(*[value(c).alias(c) if c in columns else F.col(c) for c in target.columns])


def replace_keys(target: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """All rows of every key that occurs in the changes are replaced by the changes' rows, however many a key has."""
    return target.join(changes.select(*keys).distinct(), keys, "left_anti").unionByName(changes, allowMissingColumns=True)


def delete_keys(target: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    return target.join(gone.select(*keys).distinct(), keys, "left_anti")


def merge(target: DataFrame, changes: DataFrame, keys: list[str], matched: dict[str, Column], inserted: dict[str, Column]) -> DataFrame:
    """A full merge with an expression per column: over ``old.c`` and ``new.c`` for matched rows, ``new.c`` for new ones.

    Columns without an expression keep the old value when matched and take the new one when inserted.
    """
    old, new = target.withColumn("__old", F.lit(True)).alias("old"), changes.withColumn("__new", F.lit(True)).alias("new")
    on = [F.col(f"old.{k}") == F.col(f"new.{k}") for k in keys]
    joined = old.join(new, on, "full")
    columns = []
    for c in target.columns:
        if c in keys:
            columns.append(F.coalesce(f"old.{c}", f"new.{c}").alias(c))
            continue
        fresh = inserted.get(c, F.col(f"new.{c}") if c in changes.columns else F.lit(None))
        both = matched.get(c, F.col(f"old.{c}"))
        columns.append(F.when(F.col("new.__new").isNull(), F.col(f"old.{c}")).when(F.col("old.__old").isNull(), fresh).otherwise(both).alias(c))
    return joined.select(*columns)


def changed(current: DataFrame, stored: DataFrame, keys: list[str], compare: list[str]) -> DataFrame:
    """Rows of ``current`` that are new or whose ``compare`` columns differ from the stored ones, nulls being equal."""
    other = stored.select(*keys, F.struct(*compare).alias("__stored"), F.lit(True).alias("__known"))
    joined = current.join(other, keys, "left")
    return joined.where(F.col("__known").isNull() | ~F.struct(*compare).eqNullSafe(F.col("__stored"))).select(*current.columns)


def update_guarded(target: DataFrame, changes: DataFrame, keys: list[str], columns: list[str], guard: DataFrame, guard_keys: list[str]) -> DataFrame:
    """``update_only`` for rows whose ``guard_keys`` the guard doesn't have (an update with NOT EXISTS)."""
    held = target.join(guard.select(*guard_keys).distinct(), guard_keys, "left_semi")
    return update_only(target.join(guard.select(*guard_keys).distinct(), guard_keys, "left_anti"), changes, keys, columns).unionByName(held).select(*target.columns)


def update_if(target: DataFrame, changes: DataFrame, keys: list[str], columns: list[str], condition: Column) -> DataFrame:
    """``columns`` from the changes for matched rows where ``condition``, over ``old.c`` and ``new.c``, is true."""
    new = changes.select(*keys, *columns).withColumn(MATCHED, F.lit(True)).alias("new")
    joined = target.alias("old").join(new, [F.col(f"old.{k}") == F.col(f"new.{k}") for k in keys], "left")
    use = F.coalesce(F.col(f"new.{MATCHED}") & condition, F.lit(False))
    return joined.select(*[F.when(use, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c) if c in columns else F.col(f"old.{c}").alias(c) for c in target.columns])


def not_done(rows: DataFrame, done: DataFrame, keys: list[str], except_for: Column | None = None) -> DataFrame:
    """Rows whose key isn't done yet, and those that ``except_for`` has done again."""
    flagged = rows.join(done.select(*keys).distinct().withColumn("__done", F.lit(True)), keys, "left")
    again = F.lit(False) if except_for is None else F.coalesce(except_for, F.lit(False))
    return flagged.where(F.col("__done").isNull() | again).select(*rows.columns)
