"""Nested payloads to flat rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def flat_columns(schema: T.StructType, path: tuple[str, ...] = (), separator: str = ".") -> list[Column]:
    """A column for every leaf of nested structs, named by its path; arrays and maps are leaves."""
    out: list[Column] = []
    for field in schema:
        here = (*path, field.name)
        if isinstance(field.dataType, T.StructType):
            out += flat_columns(field.dataType, here, separator)
        else:
            column = F.col(f"`{here[0]}`")
            for name in here[1:]:
                column = column.getField(name)
            out.append(column.alias(separator.join(here)))
    return out


def flatten_structs(df: DataFrame, separator: str = ".") -> DataFrame:
    return df.select(*flat_columns(df.schema, separator=separator))


def explode_rows(df: DataFrame, array: str | Column, item: str, keep: list[str] | None = None, outer: bool = False, position: str | None = None) -> DataFrame:
    """A row for each element of ``array`` beside the kept columns; with ``outer`` null and empty arrays keep one row."""
    column = F.col(array) if isinstance(array, str) else array
    names = keep if keep is not None else [c for c in df.columns if c != array]
    kept = [F.col(f"`{c}`") for c in names]
    if position:
        return df.select(*kept, (F.posexplode_outer if outer else F.posexplode)(column).alias(position, item))
    return df.select(*kept, (F.explode_outer if outer else F.explode)(column).alias(item))


def both_sides(df: DataFrame, sides: dict[str, dict[str, str]], tag: str = "side") -> DataFrame:
    """Wide to long: for each side its columns under common names (``{side: {common: own}}``) and its tag."""
    parts = [df.select(*[F.col(own).alias(common) for common, own in names.items()], F.lit(side).alias(tag)) for side, names in sides.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def named_values(df: DataFrame, keys: list[str], name: Column, value: str, order: str, into: str) -> DataFrame:
    """(keys, into map): values by name; of several with one name the last in ``order`` counts."""
    rows = df.select(*keys, name.alias("__name"), F.col(value).alias("__value"), F.col(order).alias("__order"))
    last = rows.groupBy(*keys, "__name").agg(F.max_by("__value", "__order").alias("__value"))
    return last.groupBy(*keys).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("__name", "__value")))).alias(into))


def attach_named_values(values: DataFrame, dictionary: DataFrame, event: str, who: list[str], name_id: str, value: str, order: str, prefix: str) -> DataFrame:
    """(event, entries): for every event the list of its (who, map of values by dictionary name), in the order of who.

    ``dictionary`` (id, name) is small by nature and broadcast by Spark's own size rule; ids it lacks become prefix + id.
    """
    named = values.join(dictionary.select(F.col("id").alias(name_id), F.col("name").alias("__known")), name_id, "left")
    name = F.coalesce("__known", F.concat(F.lit(prefix), F.col(name_id).cast("string")))
    one = named_values(named, [event, *who], name, value, order, "values")
    return one.groupBy(event).agg(F.sort_array(F.collect_list(F.struct(*who, F.to_json("values").alias("values")))).alias("entries"))


def first_mapping(array: str, provider: str) -> Column:
    """The first value of ``provider`` in an array of maps from provider to a list of ids; null where there is none."""
    has = F.filter(F.col(array), lambda m: F.element_at(m, provider).isNotNull() & (F.size(F.element_at(m, provider)) > 0))
    return F.try_element_at(F.element_at(F.try_element_at(has, F.lit(1)), provider), F.lit(1))


def only_known_columns(df: DataFrame, target: DataFrame) -> DataFrame:
    """The columns of ``df`` that the target has, in the target's order."""
    own = {c.lower(): c for c in df.columns}
    return df.select(*[F.col(f"`{own[c.lower()]}`").alias(c) for c in target.columns if c.lower() in own])


def stacked(frames: list[DataFrame]) -> DataFrame:
    """Rows of frames whose columns may differ."""
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out
