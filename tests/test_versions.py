"""Versioned tables, incremental models, and what a failure leaves behind."""

import os

import pytest
from pyspark.sql import functions as F

from fieldspark.plans.registry import INCREMENTAL, TABLE, FailedTest, Plan
from fieldspark.sources import sinks, tables
from fieldspark.sources.versions import Overtaken, VersionedTable

ROWS = "k long, at timestamp_ntz, v string"


def frame(spark, *rows):
    return spark.createDataFrame(rows, "k long, day string, v string").select("k", F.col("day").cast("timestamp_ntz").alias("at"), "v")


def rows(df):
    return sorted((tuple(str(x) for x in r) for r in df.collect()))


def monthly(spark, path):
    return VersionedTable(spark, str(path), F.date_format("at", "yyyy-MM"))


def files(path):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_upsert_writes_only_the_slices_it_touches(spark, tmp_path):
    t = monthly(spark, tmp_path / "t")
    t.replace(frame(spark, (1, "2024-01-05", "a"), (2, "2024-02-05", "b"), (3, "2024-03-05", "c"), (4, None, "d")))
    first, before = t.state(), files(tmp_path)
    assert set(first.folders) == {"2024-01", "2024-02", "2024-03", "none"}
    # 2 moves to another month, 5 is new in that month: both months are written again, the others aren't
    changes = frame(spark, (2, "2024-03-07", "B"), (5, "2024-03-08", "e")).withColumns({"w": F.lit(1), "k": F.col("k").cast("int")})
    assert t.upsert(changes, ["k"]) == 2
    now = t.state()
    assert {s for s in now.folders if now.folders[s] == first.folders.get(s)} == {"2024-01", "none"} and "2024-02" not in now.folders
    assert all(files(tmp_path).get(f) == at for f, at in before.items())
    assert t.read().dtypes == [("k", "bigint"), ("at", "timestamp_ntz"), ("v", "string"), ("w", "int")]
    assert rows(t.read().select("k", "v", "w")) == [("1", "a", "None"), ("2", "B", "1"), ("3", "c", "None"), ("4", "d", "None"), ("5", "e", "1")]
    assert rows(t.read(1).select("k", "v")) == [("1", "a"), ("2", "b"), ("3", "c"), ("4", "d")]
    assert rows(t.read(slices={"2024-01"}).select("k")) == [("1",)]
    t.publish(t.staged_upsert(frame(spark), ["k"], frame(spark, (1, None, None), (9, None, None)).select("k")), 2)
    assert rows(t.read().select("k")) == [("2",), ("3",), ("4",), ("5",)]
    t.drop_old(1)
    assert t.numbers() == [3] and t.read().count() == 4
    with pytest.raises(Exception):
        t.state(1)


def test_a_table_without_rows(spark, tmp_path):
    t = monthly(spark, tmp_path / "t")
    assert not t.exists() and t.replace(frame(spark)) == 1
    assert t.read().count() == 0 and t.upsert(frame(spark, (1, "2024-01-05", "a")), ["k"]) == 2 and t.read().count() == 1
    assert t.upsert(frame(spark), ["k"]) == 3 and t.read().count() == 1


def test_a_failed_or_overtaken_publish_leaves_the_table(spark, tmp_path, monkeypatch):
    t = monthly(spark, tmp_path / "t")
    t.replace(frame(spark, (1, "2024-01-05", "a")))
    late = t.staged(frame(spark, (9, "2024-01-05", "late")))
    assert t.upsert(frame(spark, (2, "2024-01-06", "b")), ["k"]) == 2
    with pytest.raises(Overtaken):
        t.publish(late, 1)
    monkeypatch.setattr(VersionedTable, "_rename", lambda *a: (_ for _ in ()).throw(OSError("no")))
    with pytest.raises(OSError):
        t.replace(frame(spark, (3, "2024-01-06", "c")))
    monkeypatch.undo()
    assert t.number() == 2 and rows(t.read().select("k")) == [("1",), ("2",)]


class Refusing:
    """A file system whose renames fail (False, as Hadoop says it) where they go to a path that ``which`` names."""

    def __init__(self, fs, which):
        self.fs, self.which = fs, which

    def __getattr__(self, name):
        return getattr(self.fs, name)

    def rename(self, a, b):
        return False if self.which(a.toString(), b.toString()) else self.fs.rename(a, b)


@pytest.mark.parametrize("which", [lambda a, b: ".old-" in b, lambda a, b: ".new-" in a])
def test_swap_keeps_the_old_rows_if_a_rename_fails(spark, tmp_path, monkeypatch, which):
    p = str(tmp_path / "t")
    sinks.swap(spark.range(3), p)
    found = sinks._fs
    monkeypatch.setattr(sinks, "_fs", lambda s, path: (Refusing(found(s, path)[0], which), found(s, path)[1]))
    with pytest.raises(sinks.SwapFailed):
        sinks.swap(spark.range(5), p)
    assert spark.read.parquet(p).count() == 3 and len(os.listdir(tmp_path)) == 1
    monkeypatch.undo()
    sinks.swap(spark.range(5), p)
    assert spark.read.parquet(p).count() == 5


def test_incremental_model(spark, tmp_path):
    source = str(tmp_path / "raw" / "src.parquet")
    put = lambda *r: frame(spark, *r).write.mode("overwrite").parquet(source)
    plan = Plan(tables.Sources(str(tmp_path / "raw")), str(tmp_path / "out"))
    how = dict(kept=INCREMENTAL, grain=("k",), cursor=("at", 7), slices=lambda: F.date_format("at", "yyyy-MM"))
    plan.model("fact", "src", rules=(("no x", "v <> 'x'"),), **how)(lambda s: s)
    put((1, "2024-01-05", "a"), (2, "2024-02-05", "b"), (3, "2024-03-20", "c"))
    assert plan.build(spark)["fact"].count() == 3
    before = files(tmp_path / "out")
    # the first is too old to be read again, the third is recalculated, the fourth is new
    put((1, "2024-01-05", "A"), (2, "2024-02-05", "b"), (3, "2024-03-20", "C"), (4, "2024-04-01", "d"))
    assert rows(plan.build(spark)["fact"].select("k", "v")) == [("1", "a"), ("2", "b"), ("3", "C"), ("4", "d")]
    assert all(files(tmp_path / "out").get(f) == at for f, at in before.items())
    assert plan.table(spark, "fact").number() == 2
    # tests fail before a state is published: a rule, and the grain
    for bad in ((5, "2024-04-01", "x"), (4, "2024-04-02", "twice")):
        put((4, "2024-04-01", "d"), bad)
        with pytest.raises(FailedTest):
            plan.build(spark)
        assert plan.table(spark, "fact").number() == 2
    plan.model("fact", "src", **how)(lambda s: s.withColumn("w", F.upper("v")))
    put((4, "2024-04-01", "d2"), (6, "2024-05-01", "f"))
    assert rows(plan.build(spark)["fact"].select("k", "v", "w")) == [("1", "a", "None"), ("2", "b", "None"), ("3", "C", "None"), ("4", "d2", "D2"), ("6", "f", "F")]


def test_rules_of_empty_and_broken_tables(spark, tmp_path):
    frame(spark, (1, "2024-01-05", "a"), (1, "2024-01-05", None)).write.parquet(str(tmp_path / "src.parquet"))
    plan = Plan(tables.Sources(str(tmp_path)), str(tmp_path / "out"))
    plan.model("none", "src", kept=TABLE, grain=("k",), rules=(("r", "v = 'a'"),))(lambda s: s.where("k > 7"))
    plan.model("nulls", "src", kept=TABLE, required=("v",))(lambda s: s)
    plan.model("view", "src", rules=(("r", "v = 'b'"),))(lambda s: s)
    plan.model("parents", "src", "none", parents=(("k", "none", "k"),), kept=TABLE)(lambda s, n: s)
    plan.check("same k", "one", "other")(lambda a, b: a.join(b, "k", "left_anti"))
    plan.model("one", "src")(lambda s: s)
    plan.model("other", "src")(lambda s: s.where("false"))
    assert plan.build(spark, ["none"])["none"].count() == 0
    for name, says in (("nulls", "v not null fails in 1 rows"), ("view", "r fails"), ("parents", "k in none fails")):
        with pytest.raises(FailedTest, match=says):
            plan.build(spark, [name])
        assert not plan.table(spark, name).exists()
    with pytest.raises(FailedTest, match="same k"):
        plan.build(spark, ["one", "other"])
    assert [tuple(r) for r in plan.failures(plan.build(spark, ["one", "other"], test=False)).collect()] == [("same k", 2)]
