"""Tables of Spark's catalogue in hash buckets of their keys: what joins or groups them by those keys reads them bucket by
bucket, without an exchange."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Rows of a bucket at most, where they are dealt evenly: a bucket is read by one task.
BUCKET_ROWS = 1_000_000


def enough(rows: int, least: int = 8, rows_a_bucket: int = BUCKET_ROWS) -> int:
    """As many buckets as ``rows`` need, so that more rows make more buckets and not larger ones."""
    return max(least, -(-rows // rows_a_bucket))


def write_bucketed(df: DataFrame, table: str, path: str, keys: list[str], buckets: int) -> DataFrame:
    """``df`` as the table ``table`` with its files at ``path``, in ``buckets`` buckets of ``keys``, a file each and sorted.

    One shuffle, once; later none. A bucket is read by one task, so take as many that one fits into its memory (``enough``), and keys no
    value of which holds a large share of the rows. Rows with a null among their keys, which no join asks for, aren't
    shuffled: they are in files of their own, as many as there are tasks, whose footers let a join pass them over.
    """
    keyed: Column = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    dealt = df.where(keyed).repartition(buckets, *keys).unionByName(df.where(~keyed))
    dealt.write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)
