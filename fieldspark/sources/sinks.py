"""Write modes. A new state of a table is written beside the old one and swapped in, never over what it reads."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def shared_dir(spark: SparkSession) -> str:
    """The folder that all machines share, ``spark.checkpoint.dir``; a local session (tests) may use one of its own."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        where = tempfile.mkdtemp(prefix="fieldspark-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def uri(path: str) -> str:
    """The path with a scheme, as readers outside of Spark want it; one without is on this machine."""
    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme:
        return f"file://{path}"
    return path if rest.startswith("//") else f"{scheme}://{rest}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the shared folder and read again: computed once, and safe from lost executors."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    fs, path_of = _fs(spark, path)
    return fs.exists(path_of(path))


def overwrite(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def write_parts(frames, path: str, resume: bool = False) -> int:
    """Frames one after the other: the first replaces the table unless resuming, later ones are appended."""
    n = 0
    for n, df in enumerate(frames, 1):
        df.write.mode("overwrite" if n == 1 and not resume else "append").parquet(path)
    return n


class SwapFailed(RuntimeError):
    """A table couldn't be moved; what stood at its path before stands there still, or beside it as the message says."""


def swap(df: DataFrame, path: str) -> None:
    """Write a new state of the table at ``path``, which ``df`` may read, and put it in the old one's place.

    A job that fails while it writes leaves the old state untouched, and so does a rename that fails (Hadoop says so by
    its result alone): the old state is moved back, and it is deleted last. Between the two renames the table is absent;
    ``sources.versions`` has tables that readers always find.
    """
    spark = df.sparkSession
    fs, path_of = _fs(spark, path)
    new, old = f"{path}.new-{uuid.uuid4().hex}", f"{path}.old-{uuid.uuid4().hex}"
    df.write.parquet(new)

    def move(a: str, b: str) -> bool:
        return fs.rename(path_of(a), path_of(b))

    there = fs.exists(path_of(path))
    if there and not move(path, old):
        fs.delete(path_of(new), True)
        raise SwapFailed(f"{path} could not be moved aside")
    if not move(new, path):
        if there and not move(old, path):
            raise SwapFailed(f"{path} is at {old}, its new state at {new}")
        fs.delete(path_of(new), True)
        raise SwapFailed(f"{path} keeps its old state: the new one could not be moved in")
    if there:
        fs.delete(path_of(old), True)


def replace_partitions(df: DataFrame, path: str, by: list[str]) -> None:
    """Only the partitions that occur in ``df`` are replaced."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def staged_json(df: DataFrame, path: str, json_columns: list[str], order: list[str]) -> None:
    """One write of text rows whose JSON columns become variants, each file sorted by ``order``."""
    typed = df.withColumns({c: F.try_parse_json(F.col(c)) for c in json_columns})
    typed.sortWithinPartitions(*order).write.mode("append").parquet(path)


def write_clustered(df: DataFrame, path: str, by: list[str], rows_a_file: int = 2_000_000, mode: str = "append") -> int:
    """Write files of about ``rows_a_file`` rows that each hold a range of the order of ``by``, sorted: a filter on its first
    columns reads the files that have such rows, by their footers. Rows of one value are in as many files as they fill,
    since the range goes on over the columns behind. Gives the number of files asked for."""
    files = max(1, -(-df.count() // rows_a_file))
    df.repartitionByRange(files, *by).sortWithinPartitions(*by).write.mode(mode).parquet(path)
    return files


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    """A folder of CSV files, each with a header; ``read_csv`` reads them as one table."""
    df.write.mode("append").option("header", True).csv(path)


def empty_like(df: DataFrame) -> DataFrame:
    """No rows, the same columns."""
    return df.limit(0)
