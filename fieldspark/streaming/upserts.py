"""Structured Streaming into tables that keep one row per key.

The stream's checkpoint is the cursor: offsets are committed after the batch function has returned, so a failed batch is
read again. Batches are upserts or whole-key replacements, hence reading something twice changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fieldspark.operators.merge import delete_keys, insert_only, replace_keys, upsert
from fieldspark.operators.ranking import first_by
from fieldspark.sources.sinks import exists, swap


def into_table(path: str, keys: list[str], order: list[Column]) -> Callable[[DataFrame, int], None]:
    """A batch function: the newest row of each key in the batch is upserted into the table at ``path``."""

    def run(batch: DataFrame, _: int) -> None:
        newest = first_by(batch, keys, order)
        spark = batch.sparkSession
        swap(upsert(spark.read.parquet(path), newest, keys) if exists(spark, path) else newest, path)

    return run


def changes_into(path: str, key: str, group: str | None = None, op: str = "op") -> Callable[[DataFrame, int], None]:
    """A batch function for change feeds: rows with op ``delete`` go first, then the others' keys are replaced.

    With ``group``, all rows of a group are replaced together (ids within it may have been given anew).
    """

    def run(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        new = batch.where(F.col(op) != "delete").drop(op)
        by = [group or key]
        if exists(spark, path):
            new = replace_keys(delete_keys(spark.read.parquet(path), batch.where(F.col(op) == "delete"), by), new, by)
        swap(new, path)

    return run


def start(stream: DataFrame, batch: Callable[[DataFrame, int], None], checkpoint: str, available_now: bool = True) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")).start()


def daily_counts(events: DataFrame, ts: str = "ts", late: str = "7 days") -> DataFrame:
    """Events and their sum per day and type; days stay open for rows as late as ``late``."""
    timed = events.withColumn("__ts", F.col(ts).cast("timestamp")).withWatermark("__ts", late)
    return timed.groupBy(F.window("__ts", "1 day").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).alias("total")).select(F.col("w.start").alias("day"), "event_type", "n", "total")


def since_cursor(rows: DataFrame, ts: str, cursor: DataFrame, overlap_minutes: int = 15, bootstrap_days: int = 7, now: Column | None = None) -> DataFrame:
    """Rows at or after the cursor less an overlap; without a cursor, of the last days. ``cursor``: one column, one row."""
    now = F.current_timestamp() if now is None else now
    kind = rows.schema[ts].dataType
    at = cursor.agg(F.max(cursor.columns[0]).cast(kind).alias("__at"))
    begin = F.coalesce(F.col("__at") - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(overlap_minutes)), (now - F.make_dt_interval(F.lit(bootstrap_days))).cast(kind))
    return rows.join(F.broadcast(at)).where(F.col(ts) >= begin).drop("__at")


def advanced(cursor: DataFrame, feed: str, started_at: Column, failed: int) -> DataFrame:
    """The cursor table (feed, at) after a run: moved to the run's start if nothing failed."""
    if failed:
        return cursor
    row = cursor.sparkSession.range(1).select(F.lit(feed).alias("feed"), started_at.cast(cursor.schema["at"].dataType).alias("at"))
    return upsert(cursor, row, ["feed"])


def seeded(cursor: DataFrame, feeds: list[str], at: Column) -> DataFrame:
    """The cursor table with a row at ``at`` for each feed that has none."""
    kind = cursor.schema["at"].dataType
    new = cursor.sparkSession.createDataFrame([(f,) for f in feeds], "feed string").select("feed", at.cast(kind).alias("at"))
    return insert_only(cursor, new, ["feed"])


def file_stream(spark: SparkSession, path: str, name: str, schema) -> DataFrame:
    return spark.readStream.schema(schema).option("pathGlobFilter", name).parquet(path)
