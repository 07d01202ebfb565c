"""Newest or best row per key, top rows per key, and running values in an order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fieldspark.sources.sinks import written

RANK = "__rank"


def ranked(df: DataFrame, keys: list[str], order: list[Column], name: str = RANK) -> DataFrame:
    """``df`` with each row's place within its key. Give ``order`` a last tiebreak, and say where nulls go."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the first in ``order``. Spark filters groups while it sorts, so rows beyond the first aren't kept."""
    return ranked(df, keys, order).where(F.col(RANK) == 1).drop(RANK)


def top_by(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each key."""
    return ranked(df, keys, order).where(F.col(RANK) <= n).drop(RANK)


def best_value(df: DataFrame, keys: list[str], score: Column, value: str, name: str) -> DataFrame:
    """One row per key with the ``value`` of the highest ``score``, the least value on ties and null scores last, as a plain
    aggregate.

    Unlike ``first_by`` this is combined before the shuffle, so a key with a third of all rows costs one row per task.
    """
    return df.groupBy(*keys).agg(F.min_by(value, F.struct(score.isNull().alias("n"), (-score).alias("s"), F.col(value).alias("v"))).alias(name))


def primary_first(flag: Column) -> Column:
    """Sort key that puts true before false and null."""
    return F.when(flag, 0).otherwise(1).asc()


def sum_before(df: DataFrame, keys: list[str], order: list[Column], value: str, name: str) -> DataFrame:
    """The sum of ``value`` over all earlier rows of the key, 0 for the first."""
    window = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(name, F.coalesce(F.sum(value).over(window), F.lit(0)))


def next_or(df: DataFrame, keys: list[str], order: list[Column], value: str, default: Column, name: str) -> DataFrame:
    """The next row's ``value`` within the key, or ``default`` for the last row."""
    return df.withColumn(name, F.coalesce(F.lead(value).over(Window.partitionBy(*keys).orderBy(*order)), default))


def exact_quantiles(df: DataFrame, keys: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """(keys, a column for each of ``shares``): exact quantiles, interpolated between neighbours (0.5 is the median).

    Values are counted, dealt out in ranges of (keys, value) and ranked within a range, moved by the sizes of the ranges
    before; so no task or buffer has all values of a key. Null values, and rows with a null key, count for nothing.
    """
    counted = df.dropna(subset=[*keys, value]).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"))
    ranged = written(counted.repartitionByRange(*keys, value).withColumn("__part", F.spark_partition_id()), "quantiles")
    sizes = ranged.groupBy(*keys, "__part").agg(F.sum("__n").alias("__size"))  # a row a key and range
    key = Window.partitionBy(*keys)
    before = F.coalesce(F.sum("__size").over(key.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select(*keys, "__part", before.alias("__before"), F.sum("__size").over(key).alias("__all"))
    inside = Window.partitionBy(*keys, "__part").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    placed = ranged.join(sizes, [*keys, "__part"]).withColumn("__end", F.col("__before") + F.sum("__n").over(inside))
    at = lambda rank: F.max(F.when((F.col("__end") - F.col("__n") <= rank) & (rank < F.col("__end")), F.col(value)))
    columns = []
    for name, share in shares.items():
        place = share * (F.col("__all") - 1)
        columns += [at(F.floor(place)).alias(f"__low_{name}"), at(F.ceil(place)).alias(f"__high_{name}"), F.max(place - F.floor(place)).alias(f"__rest_{name}")]
    found = placed.groupBy(*keys).agg(*columns)
    return found.select(*keys, *[(F.col(f"__low_{n}") + (F.col(f"__high_{n}") - F.col(f"__low_{n}")) * F.col(f"__rest_{n}")).alias(n) for n in shares])
