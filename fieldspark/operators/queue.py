"""A claim queue as states of one small table: claims, results, releases and counts. One writer at a time."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# States of an entry, hours of a lease and of a pause after a failure, and the longest error kept.
PENDING, RUNNING, SUCCESS, NO_DATA, FAILED = "PENDING", "RUNNING", "SUCCESS", "NO_EVENT_DATA", "FAILED"
LEASE_HOURS, PAUSE_HOURS, ERROR_CHARS = 12, 12, 4_000
#: Bytes of error texts that a task gets to join. They are counted as they are in memory: Spark deals tasks out by bytes after
#: compression, and texts that are much alike would be many times that.
TASK_BYTES = 64 << 20


def _hours(n: int) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(n))


def released_stale(queue: DataFrame, now: Column, hours: int = LEASE_HOURS) -> DataFrame:
    """Entries that have run for longer than the lease are pending again."""
    stale = (F.col("status") == RUNNING) & (F.col("claimed_at") < now - _hours(hours))
    return queue.withColumns({"status": F.when(stale, PENDING).otherwise(F.col("status")), "claimed_by": F.when(stale, F.lit(None)).otherwise(F.col("claimed_by")), "claimed_at": F.when(stale, F.lit(None)).otherwise(F.col("claimed_at"))})


def is_claimable(now: Column, attempts: int) -> Column:
    return F.col("status").isin(PENDING, FAILED) & (F.col("next_attempt_at").isNull() | (F.col("next_attempt_at") <= now)) & (F.col("attempt_count") < attempts)


def next_batch(queue: DataFrame, now: Column, n: int, attempts: int, lane: tuple[int, int] | None = None) -> DataFrame:
    """The next ``n`` claimable entries: the oldest scheduled first, those without a date before all; of one lane of some."""
    rows = queue.where(is_claimable(now, attempts))
    if lane:
        rows = rows.where(F.pmod(F.col("match_id"), F.lit(lane[1])) == lane[0])
    return rows.orderBy(F.col("scheduled_at").asc_nulls_first(), "match_id").limit(n)


def claimed(queue: DataFrame, now: Column, worker: str, n: int, attempts: int, lane: tuple[int, int] | None = None) -> DataFrame:
    """The queue with the next batch running for ``worker`` and an attempt more."""
    queue = released_stale(queue, now)
    batch = next_batch(queue, now, n, attempts, lane).select("match_id", F.lit(True).alias("__mine"))
    mine = F.coalesce("__mine", F.lit(False))
    out = queue.join(batch, "match_id", "left").withColumns({
        "status": F.when(mine, RUNNING).otherwise(F.col("status")), "claimed_by": F.when(mine, worker).otherwise(F.col("claimed_by")),
        "claimed_at": F.when(mine, now).otherwise(F.col("claimed_at")), "attempt_count": F.col("attempt_count") + mine.cast("int"),
    })
    return out.select(*queue.columns)


def _bytes_of(*texts: DataFrame) -> int:
    """Bytes of the texts in frames of one column each."""
    sizes = [t.agg(F.sum(F.octet_length(t.columns[0])).alias("n")) for t in texts]
    return reduce(DataFrame.union, sizes).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def finished(queue: DataFrame, results: DataFrame, now: Column, hours: int = PAUSE_HOURS) -> DataFrame:
    """The queue after results (match_id, outcome, event_count, error): failures wait, errors are cut.

    Errors are cut before they are joined, and only those of failures are. One job measures them, so that a task gets
    ``TASK_BYTES`` of them however many there are.
    """
    error = F.when(F.col("outcome") == FAILED, F.substring("error", 1, ERROR_CHARS))
    new = results.select("match_id", F.col("outcome").alias("__outcome"), F.col("event_count").alias("__count"), error.alias("__error"))
    done, outcome = F.col("__outcome").isNotNull(), F.col("__outcome")
    failed = outcome == FAILED
    tasks = -(-_bytes_of(queue.select("last_error"), new.select("__error")) // TASK_BYTES)
    if tasks > 1:
        tasks = max(tasks, queue.sparkSession.sparkContext.defaultParallelism)
        queue, new = queue.repartition(tasks, "match_id"), new.repartition(tasks, "match_id")
    out = queue.join(new, "match_id", "left").withColumns({
        "status": F.when(done, outcome).otherwise(F.col("status")),
        "event_count": F.when(done, F.col("__count")).otherwise(F.col("event_count")),
        "last_error": F.when(failed, F.col("__error")).when(done, F.lit(None)).otherwise(F.col("last_error")),
        "next_attempt_at": F.when(failed, now + _hours(hours)).when(done, F.lit(None)).otherwise(F.col("next_attempt_at")),
        "completed_at": F.when(done & ~failed, now).otherwise(F.col("completed_at")),
        "claimed_by": F.when(done, F.lit(None)).otherwise(F.col("claimed_by")), "claimed_at": F.when(done, F.lit(None)).otherwise(F.col("claimed_at")),
    })
    return out.select(*queue.columns)


def released(queue: DataFrame, worker: str) -> DataFrame:
    """What ``worker`` still runs is pending again, and the attempt isn't counted."""
    mine = (F.col("status") == RUNNING) & (F.col("claimed_by") == worker)
    return queue.withColumns({
        "attempt_count": F.when(mine, F.greatest(F.col("attempt_count") - 1, F.lit(0))).otherwise(F.col("attempt_count")), "claimed_at": F.when(mine, F.lit(None)).otherwise(F.col("claimed_at")),
        "status": F.when(mine, PENDING).otherwise(F.col("status")), "claimed_by": F.when(mine, F.lit(None)).otherwise(F.col("claimed_by")),
    })


def retried_empty(queue: DataFrame, now: Column, days: int) -> DataFrame:
    """Entries that had no data, of matches of the last ``days``, are pending again."""
    again = (F.col("status") == NO_DATA) & (F.col("scheduled_at") >= now - F.make_dt_interval(F.lit(days)))
    return queue.withColumn("status", F.when(again, PENDING).otherwise(F.col("status")))


def counts(queue: DataFrame, now: Column, attempts: int, by: list[str] | None = None) -> DataFrame:
    """How many entries are in each situation, in one pass."""
    waits = F.col("status").isin(PENDING, FAILED)
    ready = is_claimable(now, attempts)
    return queue.groupBy(*(by or [])).agg(
        F.count_if((F.col("status") == PENDING) & ready).alias("pending"), F.count_if(F.col("status") == RUNNING).alias("running"),
        F.count_if((F.col("status") == FAILED) & ready).alias("retryable"), F.count_if(waits & (F.col("attempt_count") < attempts) & (F.col("next_attempt_at") > now)).alias("deferred"),
        F.count_if(waits & (F.col("attempt_count") >= attempts)).alias("exhausted"), F.count_if(F.col("status") == SUCCESS).alias("loaded"), F.count_if(F.col("status") == NO_DATA).alias("no_data"),
        F.max("completed_at").alias("last_completed"),
    )


def stage_status(c: dict[str, str] | None = None) -> Column:
    """``complete`` where nothing is left to do and something is loaded, ``in_progress`` where something is, else ``pending``."""
    left = F.col("pending") + F.col("running") + F.col("retryable") + F.col("deferred")
    done = F.col("loaded") + F.col("no_data")
    return F.when((left == 0) & (done > 0), "complete").when((done > 0) | (F.col("running") > 0), "in_progress").otherwise("pending")


def grouped_by_budget(sizes: list[int], most: int) -> list[list[int]]:
    """Places of successive ``sizes`` in groups of at most ``most`` together; a larger one is alone."""
    groups: list[list[int]] = []
    total = most + 1
    for k, size in enumerate(sizes):
        if total + size > most:
            groups.append([])
            total = 0
        groups[-1].append(k)
        total += size
    return groups
