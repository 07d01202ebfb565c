"""Declared source tables and file readers."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


@dataclass(frozen=True)
class Source:
    """A declared table: its place below a root, its schema if fixed, and the column that tells when a row was loaded; or the
    ``table`` of Spark's catalogue that it is (``sources.buckets``)."""

    name: str
    path: str
    schema: str | None = None
    loaded_at: str | None = None
    table: str | None = None


@dataclass
class Sources:
    root: str
    declared: dict[str, Source] = field(default_factory=dict)

    def add(self, *sources: Source) -> Sources:
        self.declared |= {s.name: s for s in sources}
        return self

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        """The table; an undeclared name is a file of that name below the root."""
        s = self.declared.get(name, Source(name, f"{name}.parquet"))
        if s.table:
            return spark.table(s.table)
        reader = spark.read.schema(s.schema) if s.schema else spark.read
        return reader.parquet(f"{self.root}/{s.path}")


def read_json(spark: SparkSession, path: str, schema: T.StructType | str, lines: bool = True) -> DataFrame:
    """JSON objects, one a line or one array a file; broken records are null rows."""
    return spark.read.schema(schema).option("multiLine", not lines).option("mode", "PERMISSIVE").json(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header; without a schema all columns are text."""
    reader = spark.read.option("header", True)
    return (reader.schema(schema) if schema else reader).csv(path)


def read_payloads(spark: SparkSession, path: str, max_bytes: int, glob: str = "*") -> DataFrame:
    """(path, length, modified, content): whole files; the content of those over ``max_bytes`` is null.

    Files over the bound are listed by a scan that doesn't read content, and only the others are loaded.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    small = files.where(f"length <= {max_bytes}").selectExpr("path", "length", "modificationTime as modified", "content")
    large = files.where(f"length > {max_bytes}").selectExpr("path", "length", "modificationTime as modified", "cast(null as binary) as content")
    return small.unionByName(large)


def inline(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def id_block(spark: SparkSession, start: int, n: int, name: str = "id") -> DataFrame:
    return spark.range(start, start + n).withColumnRenamed("id", name)
