"""Payload shapes, byte ranges of large files, clustered files and mergeable season values."""

import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from fieldspark.operators import shapes
from fieldspark.plans import models
from fieldspark.sources import ranges, sinks
from fieldspark.sources.versions import VersionedTable


def test_shape_and_drift(spark):
    said = ['{"a": 1, "b": {"c": "x", "d.e": {"f": true}}, "l": [1, {"z": 2}]}', '{"a": 2.5, "b": null, "u": null}', '{"a": null, "b": {"c": 5}, "g": {}}', "[1, 2]", "7", "no json", None, '{"": 1, "a": 3}']
    found = shapes.shape(spark.createDataFrame([(s,) for s in said], "`p.q` string"), "p.q")
    rows = {r["path"]: (r["type"], r["n"]) for r in found.collect()}
    assert rows == {"a": ("DOUBLE", 3), "b.c": ("MIXED", 2), "b.`d.e`.f": ("BOOLEAN", 1), "l": ("ARRAY", 1), "": ("BIGINT", 1)}
    known = spark.createDataFrame([("a", "BIGINT"), ("l", "ARRAY"), ("old", "STRING")], "path string, type string")
    assert {tuple(r) for r in shapes.drift(found, known).collect()} == {("a", "retyped", "DOUBLE", "BIGINT"), ("b.c", "added", "MIXED", None), ("b.`d.e`.f", "added", "BOOLEAN", None), ("", "added", "BIGINT", None), ("old", "lost", None, "STRING")}
    wide = shapes.columns(spark.createDataFrame([(s,) for s in said], "p string"), "p", [("a", "DOUBLE"), ("b.`d.e`.f", "BOOLEAN"), ("b.c", "MIXED")])
    assert [tuple(r) for r in wide.select("a", "`b.``d.e``.f`").collect()] == [(1.0, True), (2.5, None)] + [(None, None)] * 5 + [(3.0, None)]
    assert shapes.shape(spark.createDataFrame([], "p string"), "p").count() == 0
    deep = "".join('{"x": ' for _ in range(6)) + "1" + "}" * 6
    df = spark.createDataFrame([(deep,)], "p string")
    assert shapes.shape(df, "p").first()["path"] == "x.x.x.x.x.x"
    with pytest.raises(ValueError):
        shapes.shape(df, "p", deepest=3)


def test_byte_ranges(spark, tmp_path):
    r = random.Random(2)
    files = {"a.txt": b"", "b.txt": b"\n", "c.txt": b"one", "d.txt": b"\n\nx\n", "e.txt": b"".join(bytes(r.choice(b"ab\n\xc3") for _ in range(r.choice([0, 3, 90]))) + b"\n" for _ in range(60)), "f.txt": b"q" * 700}
    for name, content in files.items():
        (tmp_path / name).write_bytes(content)
    spark.dataSource.register(ranges.ByteRanges)
    read = lambda **o: spark.read.format("byte_ranges").options(paths=f"file://{tmp_path}", **o).load()
    name = lambda row: row["path"].rsplit("/", 1)[1]
    for size in (7, 64, 1000):
        lines, pieces = {n: [] for n in files}, {n: b"" for n in files}
        for row in sorted(read(rangeBytes=str(size), lines="true").collect(), key=lambda x: x["at"]):
            assert files[name(row)][row["at"] :].startswith(bytes(row["content"]))
            lines[name(row)].append(bytes(row["content"]))
        for row in sorted(read(rangeBytes=str(size)).collect(), key=lambda x: x["at"]):
            assert len(row["content"]) <= size
            pieces[name(row)] += bytes(row["content"])
        assert pieces == files
        assert lines == {n: (c[:-1] if c.endswith(b"\n") else c).split(b"\n") if c else [] for n, c in files.items()}
    reader = ranges.RangeReader({"paths": f"file://{tmp_path}/f.txt", "rangeBytes": "100"})
    assert [(p.start, p.end) for p in reader.partitions()] == [(k, k + 100) for k in range(0, 700, 100)]


def test_clustered_files_can_be_skipped(spark, tmp_path):
    df = spark.range(10_000).select((F.col("id") % 100).alias("match_id"), F.floor(F.col("id") / 100).alias("event_index")).unionByName(spark.range(3_000).select(F.lit(7).cast("long").alias("match_id"), F.col("id").alias("event_index"))).repartition(7)
    path = str(tmp_path / "t")
    assert sinks.write_clustered(df, path, ["match_id", "event_index"], 1_000) == 13
    bounds = []
    for f in tmp_path.glob("t/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        stats = [meta.row_group(g).column(0).statistics for g in range(meta.num_row_groups)]
        if stats:
            bounds.append((min(s.min for s in stats), max(s.max for s in stats), meta.num_rows))
    holding = lambda m: sum(low <= m <= high for low, high, _ in bounds)
    assert len(bounds) >= 10 and holding(50) <= 2 and 3 <= holding(7) <= 6 and max(n for *_, n in bounds) < 2_500  # a hot match is cut up
    assert spark.read.parquet(path).count() == 13_000


def test_season_parts_replace_fixtures_that_come_again(spark, tmp_path):
    schema = "player_id long, season_id long, competition_id long, kpi_id long, fixture_id long, kpi_value double, play_duration_seconds double"
    rows = lambda *r: spark.createDataFrame(r, schema)
    table = VersionedTable(spark, str(tmp_path / "s"), F.col("season_id"))
    first = rows((1, 1, None, 1, 10, 2.0, 60.0), (1, 1, None, 1, 10, 3.0, 30.0), (1, 1, None, 1, 11, None, 60.0), (2, 2, 5, 1, 20, 1.0, None))
    table.replace(models.season_state(first))
    kept = table.state().folders["2"]
    table.upsert(models.season_state_changes(table.read(), rows((1, 1, 4, 1, 10, 9.0, 1.0), (1, 1, 4, 1, 12, 1.0, 1.0))), list(models.SEASON_GRAIN))
    later = rows((1, 1, 4, 1, 10, 7.0, 2.0))
    table.upsert(models.season_state_changes(table.read(), later), list(models.SEASON_GRAIN))
    got = sorted(map(tuple, models.season_kpis_of(table.read()).collect()), key=str)
    assert got == [(1, 1, 4, 1, 8.0, 4.0, 2, 3.0), (1, 1, None, 1, 5.0, 2.5, 2, 150.0), (2, 2, 5, 1, 1.0, 1.0, 1, None)]
    assert table.state().folders["2"] == kept
    whole = models.season_kpis(first)
    assert sorted(map(tuple, models.season_kpis_of(models.season_state(first)).select(*whole.columns).collect()), key=str) == sorted(map(tuple, whole.collect()), key=str)


def test_season_parts_are_shuffled_once(spark):
    kpis = spark.range(100).selectExpr("id % 3 as player_id", "id % 2 as season_id", "id % 4 as competition_id", "id % 5 as kpi_id", "id as fixture_id", "1.0d as kpi_value", "60.0d as play_duration_seconds")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = models.season_state(kpis)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange hashpartitioning") == 1


def test_the_newest_date_of_a_kpi_is_hashed_not_sorted(spark):
    from fieldspark.plans import kept

    kpis = spark.sql("select * from values (1L, '1995-01-02 00:00:00', 2.0d), (1L, '1996-01-02 00:00:00', 1.0d), (2L, '1995-01-02 00:00:00', 3.0d) t(playerId, scheduledDate, value)").repartition(2)
    one = kept._one_a_grain(kpis)
    assert sorted(map(tuple, one.select("playerId", "scheduledDate", "value").collect())) == [(1, "1996-01-02 00:00:00", 2.0), (2, "1995-01-02 00:00:00", 3.0)]
    assert "SortAggregate" not in one._jdf.queryExecution().executedPlan().toString()


def test_more_rows_make_more_buckets():
    from fieldspark.sources import buckets

    assert buckets.enough(5) == 8 and buckets.enough(216_000_000) == 216


def test_a_table_cut_by_its_keys_finds_its_slices_in_the_changes(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"), F.col("k") % 4, by_keys=True)
    t.replace(spark.range(8).selectExpr("id as k", "0 as v"))
    first = t.state()
    t.upsert(spark.createDataFrame([(1, 5), (9, 6)], "k long, v int"), ["k"])
    assert {s for s, f in t.state().folders.items() if f != first.folders[s]} == {"1"}
    assert sorted(map(tuple, t.read().where("v > 0 or k = 5").collect())) == [(1, 5), (5, 0), (9, 6)]
