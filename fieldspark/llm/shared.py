"""What every text operator uses: columns passed by whatever their names, bounded slices of Arrow batches, intermediate
tables in the shared folder, and how many rows may be broadcast."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes of text that a task works on at a time (a longer text is a slice of its own).
SLICE_BYTES = 1 << 19
#: Rows that aren't worth being spread over more tasks.
FEW_ROWS = 4_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the corpus, read by Spark only (the path may be in any store Spark knows)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """``df`` in as many partitions as there are cores, where fewer than that have rows (one row group is read by one task
    alone, into however many splits its file is cut); a table of as many files, or of few rows, stays as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if len(df.inputFiles()) >= cores or within(df.select(F.lit(1)), FEW_ROWS):
        return df
    held = df.select(F.spark_partition_id().alias("p")).distinct().count()  # reads footers of a few files
    return df if held >= cores else df.repartition(cores)


def column(name: str) -> Column:
    """The column of exactly this name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``. Only a local session (tests) may go without one, and then
    uses a temporary folder of its machine; on a cluster an unset folder is an error."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        where = tempfile.mkdtemp(prefix="fieldspark-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_path = path
    return out


def removed(*frames: DataFrame) -> None:
    """Delete tables made by ``written`` that nothing reads any more."""
    for df in frames:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._written_path)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, UPPER, LOWER)


def within(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has at most ``rows`` rows; reads no further than that."""
    return df.limit(rows + 1).count() <= rows


def slices(batch: pa.RecordBatch, place: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts in the column at ``place`` have at most ``most`` bytes together, or one longer text."""
    sizes = pc.fill_null(pc.binary_length(batch.column(place)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    i = 0
    while i < batch.num_rows:
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + most, "right")))
        yield batch.slice(i, j - i)
        i = j


def bit_table(df: DataFrame, hashes: str, bits: int) -> np.ndarray:
    """A bit set for the lowest ``bits`` bits of each of the 64-bit ``hashes``: of a fixed size whatever the table's, put
    together by Spark. What it leaves out isn't in the table; of the rest some isn't either."""
    cell = F.col(hashes).bitwiseAND((1 << bits) - 1)
    rows = df.select(F.shiftright(cell, 6).alias("k"), F.expr(f"shiftleft(1L, cast(`{hashes}` & 63 as int))").alias("b")).groupBy("k").agg(F.bit_or("b").alias("b")).toArrow()
    out = np.zeros(1 << (bits - 6), np.int64)
    out[rows["k"].to_numpy()] = rows["b"].to_numpy()
    return out.view(np.uint64)


def in_bit_table(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    cell = hashes & np.uint64(64 * len(table) - 1)
    return (table[cell >> np.uint64(6)] >> (hashes & np.uint64(63))) & np.uint64(1) > 0


class Packed:
    """Rows as (row, text): all columns but the text in a struct under names of its own, so that columns of any names pass.

    Columns that are called like one of ``new`` (in any case) are left out; the new ones come after the others.
    """

    def __init__(self, docs: DataFrame, text: str, new: dict[str, T.DataType], keep_text: bool = True):
        names = {n.lower() for n in new}
        self.new, self.text = new, text
        self.keep = [c for c in docs.columns if c.lower() not in names and (keep_text or c != text)]
        self.others = [c for c in self.keep if c != text]
        self.keeps_text = text in self.keep
        row = F.struct(F.lit(True).alias("here"), *[column(c).alias(f"c{k}") for k, c in enumerate(self.others)])
        self.rows = docs.select(row.alias("row"), column(text).alias("text"))

    def unpacked(self, out: DataFrame, *values: Column) -> DataFrame:
        """``out`` (row, text where it is kept, and what ``values`` are made of) under the original names."""
        own = [F.col("text").alias(c) if c == self.text else F.col(f"row.c{self.others.index(c)}").alias(c) for c in self.keep]
        return out.select(*own, *[v.cast(kind).alias(n) for v, (n, kind) in zip(values, self.new.items())])

    def mapped(self, start: Callable[[], Callable[[pa.Array], list]], most: int = SLICE_BYTES) -> DataFrame:
        """The new columns from ``start()``, called once a task, whose function turns a slice of texts into their arrays."""
        keeps, count = self.keeps_text, len(self.new)

        def run(batches):
            f = start()
            for batch in batches:
                for part in slices(batch, 1, most):
                    held = [part.column(0), part.column(1)] if keeps else [part.column(0)]
                    yield pa.RecordBatch.from_arrays([*held, *f(part.column(1))], [*(["row", "text"] if keeps else ["row"]), *[f"n{k}" for k in range(count)]])

        fields = [self.rows.schema["row"], *([T.StructField("text", self.rows.schema["text"].dataType)] if keeps else [])]
        schema = T.StructType([*fields, *[T.StructField(f"n{k}", kind) for k, kind in enumerate(self.new.values())]])
        return self.unpacked(self.rows.mapInArrow(run, schema), *[F.col(f"n{k}") for k in range(count)])
