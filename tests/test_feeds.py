"""Feeds of changes: cursor and overlap, failed and half-applied batches, and the newest version as state."""

import json
from datetime import datetime, timezone

import pytest
from pyspark.errors.exceptions.captured import StreamingQueryException
from pyspark.sql import functions as F

from fieldspark.sources.versions import VersionedTable
from fieldspark.streaming import feeds, upserts


def reader(**options):
    return feeds.FeedReader({"fetch": "fieldspark.streaming.feeds:from_folder", **options})


def test_spans_overlap_and_meet():
    r = reader(now="2024-01-10T00:00:00", parthours="36")
    assert r.initialOffset() == {"at": "2024-01-03T00:00:00+00:00"} and r.latestOffset() == {"at": "2024-01-10T00:00:00+00:00"}
    spans = r.partitions({"at": "2024-01-07T00:00:00+00:00"}, r.latestOffset())
    assert spans[0].since == "2024-01-06T23:45:00+00:00" and spans[-1].until == "2024-01-10T00:00:00+00:00"
    assert [a.until for a in spans[:-1]] == [b.since for b in spans[1:]] and len(spans) == 3
    assert r.partitions({"at": "2024-01-07T00:00:00+00:00"}, {"at": "2024-01-06T00:00:00+00:00"}) == []


def test_records_of_a_span(tmp_path):
    for day, lines in {"2024-01-01": [{"id": 1, "at": "2024-01-01T23:50:00", "payload": {"a": 1}}], "2024-01-02": [{"id": "2", "op": "delete", "at": "2024-01-02T00:00:00Z"}, {"id": 3, "at": "2024-01-02T05:00:00"}]}.items():
        (tmp_path / f"day={day}").mkdir()
        (tmp_path / f"day={day}" / "x.json").write_text("\n".join(map(json.dumps, lines)))
    found = list(reader(folder=f"file://{tmp_path}").read(feeds.Span("2024-01-01T12:00:00", "2024-01-02T05:00:00")))
    utc = lambda *a: datetime(*a, tzinfo=timezone.utc)
    assert found == [(1, "update", utc(2024, 1, 1, 23, 50), '{"a": 1}'), (2, "delete", utc(2024, 1, 2), None)]


def test_a_span_is_read_in_pieces_of_bounded_size(tmp_path):
    (tmp_path / "day=2024-01-01").mkdir()
    for name, ids in (("a", range(40)), ("b", range(40, 100))):
        (tmp_path / "day=2024-01-01" / f"{name}.json").write_text("".join(json.dumps({"id": i, "at": "2024-01-01T01:00:00"}) + "\n" for i in ids))
    r = reader(folder=f"file://{tmp_path}", now="2024-01-03T00:00:00", parthours="2400", rangebytes="300")
    spans = r.partitions({"at": "2024-01-01T00:15:00+00:00"}, r.latestOffset())
    found = [[x[0] for x in r.read(s)] for s in spans]
    assert len(spans) > 10 and max(map(len, found)) < 10 and sorted(sum(found, [])) == list(range(100))


@pytest.fixture
def feed(spark, tmp_path):
    """Two tables that follow a feed in a folder; ``say`` adds records to the feed, ``run`` applies what it has until a time."""
    spark.dataSource.register(feeds.ChangeFeed)
    events, info = VersionedTable(spark, str(tmp_path / "events")), VersionedTable(spark, str(tmp_path / "info"))
    rows = {events: lambda c: c.select("id", F.explode(F.sequence(F.lit(1), F.col("payload").cast("int"))).alias("index")), info: lambda c: c.select("id", "at", F.col("payload").cast("int").alias("n"))}
    for table, f in rows.items():
        table.replace(f(spark.createDataFrame([], feeds.FEED)))
    apply = feeds.applied_to([feeds.Dependent(events, rows[events], ["id", "index"]), feeds.Dependent(info, rows[info], ["id"])], "f")

    def say(*records):
        for k, (i, op, at, n) in enumerate(records):
            where = tmp_path / "source" / f"day={at[:10]}"
            where.mkdir(parents=True, exist_ok=True)
            (where / f"{i}-{at}-{k}.json").write_text(json.dumps({"id": i, "op": op, "at": at, "payload": n}))

    def run(now, batch=apply):
        stream = spark.readStream.format("change_feed").options(fetch="fieldspark.streaming.feeds:from_folder", folder=f"file://{tmp_path}/source", now=now).load()
        upserts.start(stream, batch, str(tmp_path / "cursor")).awaitTermination()

    return events, info, apply, say, run


def held(table, *columns):
    return sorted(tuple(r) for r in table.read().select(*columns).collect())


def test_a_half_applied_batch_is_completed(feed, monkeypatch):
    events, info, _, say, run = feed
    say((1, "update", "2024-01-05T10:00:00", "2"), (2, "update", "2024-01-05T10:00:00", "1"), (3, "update", "2024-01-02T00:00:00", "9"))
    run("2024-01-10T00:00:00")
    assert held(events, "id", "index") == [(1, 1), (1, 2), (2, 1)] and held(info, "id", "n") == [(1, 2), (2, 1)]  # 3 is before the first seven days
    say((1, "update", "2024-01-11T00:00:00", "1"), (2, "delete", "2024-01-11T00:00:00", None), (4, "update", "2024-01-09T23:50:00", "1"), (1, "update", "2024-01-10T12:00:00", "7"))
    publish, failed = VersionedTable.publish, []

    def fails_once(self, state, after):
        if self.path == info.path and not failed:
            failed.append(1)
            raise OSError("lost between the two tables")
        return publish(self, state, after)

    monkeypatch.setattr(VersionedTable, "publish", fails_once)
    with pytest.raises(StreamingQueryException):
        run("2024-01-12T00:00:00")
    assert held(events, "id", "index") == [(1, 1), (4, 1)] and held(info, "id", "n") == [(1, 2), (2, 1)]
    before = events.number()
    run("2024-01-12T06:00:00")  # the same batch again; 4 came late, and is found by the overlap
    assert held(events, "id", "index") == [(1, 1), (4, 1)] and held(info, "id", "n") == [(1, 1), (4, 1)]
    assert events.state(before).applied == {"f": 1} and info.state().applied["f"] >= 1


def test_a_failed_batch_keeps_the_cursor(feed):
    events, _, apply, say, run = feed
    run("2024-01-10T00:00:00")
    say((5, "update", "2024-01-11T00:00:00", "1"))
    with pytest.raises(StreamingQueryException):
        run("2024-01-12T00:00:00", lambda batch, n: (_ for _ in ()).throw(OSError("no")))
    say((6, "update", "2024-01-13T00:00:00", "1"))
    run("2024-01-14T00:00:00", apply)
    run("2024-01-14T00:00:00", apply)
    assert held(events, "id") == [(5,), (6,)]


def test_newest_versions_go_on_from_their_state(spark, tmp_path):
    for k, v in feeds.ROCKS.items():
        spark.conf.set(k, v)
    schema, out = "fixture_id long, loaded_at timestamp, run_id long, v string", []

    def run(*rows):
        spark.createDataFrame([(f, None if d is None else datetime(2024, 1, d), r, v) for f, d, r, v in rows], schema).write.mode("append").parquet(str(tmp_path / "source"))
        out.clear()
        newest = feeds.newest_versions(spark.readStream.schema(schema).parquet(str(tmp_path / "source")))
        upserts.start(newest, lambda batch, n: out.extend(tuple(r)[::3] for r in batch.collect()), str(tmp_path / "state")).awaitTermination()
        return sorted(out)

    assert run((1, 1, 1, "a"), (1, 2, 1, "b"), (2, None, 1, "c"), (2, None, None, "z"), (3, 5, 1, "d")) == [(1, "b"), (2, "c"), (3, "d")]
    assert run((1, 2, 1, "same"), (1, 1, 9, "old"), (2, 1, None, "e"), (3, 5, 2, "f"), (4, None, None, "g")) == [(2, "e"), (3, "f"), (4, "g")]
    for k in feeds.ROCKS:
        spark.conf.unset(k)
