"""Shapes of JSON payloads: which paths occur, of which types, how often, and how that differs from what is known.

Payloads are variants and are taken apart by Spark, level by level; a shape is an aggregate of them, so it has as many rows
as there are different paths, however many payloads there are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHAPE = "path string, type string, n long"
#: SQL types of the kinds of values, and what a path with several kinds is.
KINDS = {"BIGINT": "bigint", "DOUBLE": "double", "STRING": "string", "BOOLEAN": "boolean", "ARRAY": "variant", "MIXED": "variant"}


def _kind(value: Column) -> Column:
    """BIGINT, DOUBLE (whatever has decimals), STRING, BOOLEAN, ARRAY, OBJECT; null for a JSON null."""
    name = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
    return F.when(name.isin("DECIMAL", "FLOAT"), "DOUBLE").when(name != "VOID", name)


def shape(df: DataFrame, column: str, deepest: int = 20) -> DataFrame:
    """(path, type, n) of every path to a value in the JSON text of ``column``: how many payloads' values it has, null ones left
    out. Objects count only by what is in them, arrays as a whole; a path with values of several types, but whole numbers
    among decimals, is MIXED. Null payloads, and texts that aren't JSON objects, have no paths; a name with a dot in it
    stands in backticks. Objects further down than ``deepest`` are an error, not left out."""
    level = df.select(F.lit("").alias("at"), F.try_parse_json(F.col(f"`{column}`")).alias("value"))
    counts = []
    for depth in range(deepest + 1):
        inside = level.where(F.col("value").isNotNull() & F.schema_of_variant("value").startswith("OBJECT"))
        if depth and inside.isEmpty():
            break
        if depth == deepest:
            raise ValueError(f"objects in {column} are more than {deepest} deep")
        exploded = inside.lateralJoin(inside.sparkSession.tvf.variant_explode(F.col("value").outer()).select(F.col("key"), F.col("value").alias("inner")))
        own = F.when(F.col("key").contains("."), F.concat(F.lit("`"), F.col("key"), F.lit("`"))).otherwise(F.col("key"))
        level = exploded.select(F.concat(F.col("at"), own, F.lit(".")).alias("at"), F.col("inner").alias("value"))
        kinds = level.select(F.expr("substring(at, 1, length(at) - 1)").alias("path"), _kind(F.col("value")).alias("kind")).where("kind is not null and kind <> 'OBJECT'")
        counts.append(kinds.groupBy("path", "kind").agg(F.count(F.lit(1)).alias("n")))
    every = reduce(DataFrame.unionByName, counts).groupBy("path", "kind").agg(F.sum("n").alias("n"))
    found = F.array_sort(F.collect_set("kind"))
    kind = F.when(F.size(found) == 1, found[0]).when(found == F.array(F.lit("BIGINT"), F.lit("DOUBLE")), "DOUBLE").otherwise("MIXED")
    return every.groupBy("path").agg(kind.alias("type"), F.sum("n").alias("n"))


def drift(found: DataFrame, known: DataFrame) -> DataFrame:
    """(path, change, type, was) of each path that ``found`` (path, type) has beyond ``known``, lacks, or has of another type:
    added, lost, retyped."""
    a, b = found.select("path", "type"), known.select("path", F.col("type").alias("was"))
    change = F.when(F.col("was").isNull(), "added").when(F.col("type").isNull(), "lost").when(F.col("type") != F.col("was"), "retyped")
    return a.join(b, "path", "full").select("path", change.alias("change"), "type", "was").where("change is not null")


def columns(df: DataFrame, column: str, paths: list[tuple[str, str]]) -> DataFrame:
    """``df`` with a column for each (path, type) of the payload, called like the path; what can't be cast is null, and mixed
    values and arrays stay variants. ``paths`` are a shape's rows, few and on the driver."""
    v = F.try_parse_json(F.col(f"`{column}`"))
    place = lambda p: "$" + "".join(f'["{x}"]' for x in _names(p))
    return df.select("*", *[F.try_variant_get(v, place(p), KINDS[kind]).alias(p) for p, kind in sorted(paths)])


def _names(path: str) -> list[str]:
    """The names of a path's levels, without backticks."""
    out, rest = [], path
    while rest:
        if rest[0] == "`":
            name, _, rest = rest[1:].partition("`")
            rest = rest[1:]
        else:
            name, _, rest = rest.partition(".")
        out.append(name)
    return out
