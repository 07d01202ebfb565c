"""Feeds of changes: a streaming source whose offset is a time cursor, batches that several tables take over as one, and
the newest version of each key as stream state."""

from __future__ import annotations

import importlib
import json
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StatefulProcessor

from fieldspark.operators.ranking import first_by
from fieldspark.sources import ranges
from fieldspark.sources.versions import VersionedTable

FEED = "id long, op string, at timestamp, payload string"
DELETE = "delete"


def _time(text: str) -> datetime:
    at = datetime.fromisoformat(text)
    return at if at.tzinfo else at.replace(tzinfo=timezone.utc)


class Span(InputPartition):
    """Changes from ``since`` on and before ``until``, or one piece of them that the feed has named."""

    def __init__(self, since: str, until: str, piece: tuple | None = None):
        self.since, self.until, self.piece = since, until, piece


class FeedReader(DataSourceStreamReader):
    """Batches from the cursor, less an overlap, to the time the batch is planned. The cursor moves in Spark's own log of
    offsets, only after a batch has been applied: a batch that fails is planned again with the times it had. Its span is cut
    into parts that executors ask for at once, and those into the pieces that the feed can give by themselves (its function
    ``pieces``), since a part of time may hold any number of changes."""

    def __init__(self, options):
        self.options = dict(options)
        module, _, name = options["fetch"].partition(":")
        self.module, self.function = module, name
        self.overlap = timedelta(minutes=float(options.get("overlapminutes", options.get("overlapMinutes", "15"))))
        self.bootstrap = timedelta(days=float(options.get("bootstrapdays", options.get("bootstrapDays", "7"))))
        self.part = timedelta(hours=float(options.get("parthours", options.get("partHours", "24"))))

    def _now(self) -> datetime:
        now = self.options.get("now")
        return _time(now) if now else datetime.now(timezone.utc)

    def initialOffset(self) -> dict:
        return {"at": (self._now() - self.bootstrap).isoformat()}

    def latestOffset(self) -> dict:
        return {"at": self._now().isoformat()}

    def partitions(self, start: dict, end: dict) -> list[Span]:
        begin, until = _time(start["at"]) - self.overlap, _time(end["at"])
        pieces = getattr(self._fetch(), "pieces", None)
        out = []
        while begin < until:
            after = min(begin + self.part, until)
            found = pieces(self.options, begin, after) if pieces else []
            out += [Span(begin.isoformat(), after.isoformat(), piece) for piece in found or [None]]
            begin = after
        return out

    def _fetch(self) -> Callable:
        return getattr(importlib.import_module(self.module), self.function)

    def read(self, partition: Span) -> Iterator[tuple]:
        since, until = _time(partition.since), _time(partition.until)
        piece = [] if partition.piece is None else [partition.piece]
        for x in self._fetch()(self.options, since, until, *piece):
            at = _time(x["at"])
            if since <= at < until:
                payload = x.get("payload")
                yield int(x["id"]), x.get("op") or "update", at, payload if payload is None or isinstance(payload, str) else json.dumps(payload)


class ChangeFeed(DataSource):
    """``spark.readStream.format("change_feed")``. Options: ``fetch`` ("module:function", called with the options, since and
    until, which gives records with id, op, at and payload; if it has a function ``pieces`` of the same, it is called for each
    of these, as its last argument), ``overlapMinutes`` (15), ``bootstrapDays`` (7, without a cursor), ``partHours`` (24), ``now``
    (a time that counts as the present)."""

    @classmethod
    def name(cls) -> str:
        return "change_feed"

    def schema(self) -> str:
        return FEED

    def streamReader(self, schema) -> DataSourceStreamReader:
        return FeedReader(self.options)


def _day_files(options: dict, since: datetime, until: datetime) -> tuple:
    """The file system of the folder, and its files of the days asked for."""
    from pyarrow.fs import FileSelector, FileSystem

    fs, base = FileSystem.from_uri(options["folder"])
    asked = {f"day={since.date() + timedelta(days=k)}" for k in range((until.date() - since.date()).days + 1)}
    days = sorted(f.path for f in fs.get_file_info(FileSelector(base, allow_not_found=True)) if f.base_name in asked)
    return fs, [f for day in days for f in fs.get_file_info(FileSelector(day)) if f.path.endswith(".json")]


def from_folder(options: dict, since: datetime, until: datetime, piece: tuple[str, int, int] | None = None) -> Iterator[dict]:
    """A feed kept as JSON lines in folders ``day=2024-01-31`` below the option ``folder``; only the days asked for are read, or
    the lines that begin in one ``piece`` of a file (path, start, end)."""
    from pyarrow.fs import FileSystem

    if piece is None:
        fs, files = _day_files(options, since, until)
        pieces = [(f.path, 0, f.size) for f in files]
    else:
        (fs, _), pieces = FileSystem.from_uri(options["folder"]), [piece]
    for path, start, end in pieces:
        with fs.open_input_file(path) as f:
            yield from (json.loads(line) for _, line in ranges.lines_of(f, start, end))


def pieces_of_folder(options: dict, since: datetime, until: datetime) -> list[tuple[str, int, int]]:
    """What ``from_folder`` can be asked for by itself: byte ranges (option ``rangeBytes``, 8 MB) of the files of these days."""
    if "folder" not in options:
        return []
    size = int(options.get("rangebytes", options.get("rangeBytes", str(8 << 20))))
    return [(f.path, k, min(k + size, f.size)) for f in _day_files(options, since, until)[1] for k in range(0, f.size, size)]


from_folder.pieces = pieces_of_folder


@dataclass
class Dependent:
    """A table that follows a feed: the rows that a batch's newest changes put there, and what makes a row one (``keys``).

    All rows with an id of the batch in the column ``owner`` go first, unless ``marks`` is set: then only rows of ``keys`` are
    replaced, and ``rows`` gets deletions too, to mark them.
    """

    table: VersionedTable
    rows: Callable[[DataFrame], DataFrame]
    keys: list[str]
    owner: str = "id"
    marks: bool = False


def applied_to(dependents: list[Dependent], feed: str) -> Callable[[DataFrame, int], None]:
    """A batch function that takes the newest change of each id over into all ``dependents``, one after the other.

    Each table's state records the last batch of the ``feed`` in it, published with the rows themselves. A batch that fails
    between two tables is run again by Spark, and then completed: tables that have it are left alone. The record goes with the
    stream's checkpoint, so a new checkpoint needs a new name for the feed.
    """

    def run(batch: DataFrame, number: int) -> None:
        todo = [d for d in dependents if d.table.state().applied.get(feed, -1) < number]
        if not todo:
            return
        newest = first_by(batch, ["id"], [F.desc("at"), F.asc(F.when(F.col("op") == DELETE, 0).otherwise(1)), F.desc("payload")])
        once = VersionedTable(batch.sparkSession, f"{todo[0].table.path}/batches/{uuid.uuid4().hex}")
        try:
            newest = once.of(once.staged(newest))  # one request, and one look for the newest, for all tables
            for d in todo:
                version = d.table.number()
                if d.marks:
                    state = d.table.staged_upsert(d.rows(newest), d.keys)
                else:
                    gone = newest.select(F.col("id").alias(d.owner))
                    state = d.table.staged_upsert(d.rows(newest.where(F.col("op") != DELETE)), d.keys, gone, [d.owner])
                state.applied[feed] = number
                d.table.publish(state, version)
        finally:
            once.drop()

    return run


class NewestVersion(StatefulProcessor):
    """The newest version of a key, by (loaded_at, run_id): rows that are newer than what the state holds come out."""

    def __init__(self, columns: list[str], expires_ms: int | None):
        self.columns, self.expires_ms = columns, expires_ms

    def init(self, handle) -> None:
        self.kept = handle.getValueState("newest", "loaded_at timestamp, run_id long", self.expires_ms)

    def handleInputRows(self, key, rows, timerValues):
        best = None
        for part in rows:
            part = part.sort_values(["loaded_at", "run_id"], na_position="first", kind="stable")
            last = part.iloc[[-1]]
            if best is None or self._order(last) > self._order(best):
                best = last
        held = self.kept.get() if self.kept.exists() else None
        order = self._order(best)
        if held is None or order > self._of(held[0], held[1]):
            self.kept.update((None if best["loaded_at"].isna().iloc[0] else best["loaded_at"].iloc[0].to_pydatetime(), None if best["run_id"].isna().iloc[0] else int(best["run_id"].iloc[0])))
            yield best[self.columns]

    def _order(self, row) -> tuple:
        at, run = row["loaded_at"].iloc[0], row["run_id"].iloc[0]
        return self._of(None if row["loaded_at"].isna().iloc[0] else at.to_pydatetime(), None if row["run_id"].isna().iloc[0] else int(run))

    @staticmethod
    def _of(at, run) -> tuple:
        at = None if at is None else at.replace(tzinfo=None)
        return (at is not None, at or datetime.min, run is not None, run or 0)

    def close(self) -> None:
        pass


#: State of streams with ``NewestVersion``: on local disk, with snapshots in the checkpoint, so it may outgrow memory.
ROCKS = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


def newest_versions(stream: DataFrame, key: str = "fixture_id", expires_days: int | None = None) -> DataFrame:
    """A stream of versions (``key``, loaded_at, run_id, ...) as a stream of those that are newer than all before of their key.

    The state holds a key's newest (loaded_at, run_id) and, with ``expires_days``, forgets keys that have been silent for so long;
    a version of one comes out again, so what it goes into must take a repeated row (an upsert does). Null times are oldest.
    The session needs ``ROCKS``.
    """
    columns = stream.columns
    schema = T.StructType([stream.schema[c] for c in columns])
    processor = NewestVersion(columns, None if expires_days is None else expires_days * 86_400_000)
    return stream.groupBy(key).transformWithStateInPandas(processor, schema, "Update", "None" if expires_days is None else "ProcessingTime")
