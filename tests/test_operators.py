"""Operators on small fixtures computed by hand."""

import datetime

import pytest
from pyspark.sql import functions as F

from fieldspark.functions import scalars, text
from fieldspark.operators import bridge, discovery, flatten, identity, incremental, merge, quality, queue, ranking, spells

T = datetime.datetime


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


MATCH = f"match_id long, iteration_id long, home_squad_id long, home_starting {spells.STARTS}, home_changes {spells.CHANGES}, away_squad_id long, away_starting {spells.STARTS}, away_changes {spells.CHANGES}"


def test_participation(spark):
    events = spark.createDataFrame([(1, 1, 0.0), (1, 1, 2760.0), (1, 2, 10000.0), (1, 2, 12880.0), (1, None, 5.0), (1, 2, None)], "match_id long, period_id long, clock double")
    starts = [(1, "CENTRAL_DEFENDER", "LEFT"), (2, "GOALKEEPER", "CENTRE"), (3, "CENTER_FORWARD", "CENTRE")]
    changes = [(1, (1800.0,), "RIGHT_WINGBACK_DEFENDER", "RIGHT"), (3, (12000.0,), "BANK", None), (4, (12000.0,), "CENTER_FORWARD", "CENTRE"), (5, (20010.0,), "GOALKEEPER", "CENTRE"), (2, (0.0,), "GOALKEEPER", "LEFT"), (None, (1.0,), "X", None)]
    matches = spark.createDataFrame([(1, 100, 10, starts, changes, 20, [], []), (2, 100, 10, starts, changes, 20, None, None)], MATCH)
    got = spells.participation(events, matches).select("player_id", "position", "position_side", "started", "first_second", "last_second", "play_duration", F.round("match_share", 6), "side", "squad_id")
    assert rows(got, "player_id", "first_second") == [
        (1, "CENTRAL_DEFENDER", "LEFT", True, 0.0, 1800.0, 1800.0, 0.319149, "HOME", 10),
        (1, "RIGHT_WINGBACK_DEFENDER", "RIGHT", True, 1800.0, 5640.0, 3840.0, 0.680851, "HOME", 10),
        (2, "GOALKEEPER", "LEFT", True, 0.0, 5640.0, 5640.0, 1.0, "HOME", 10),
        (3, "CENTER_FORWARD", "CENTRE", True, 0.0, 4760.0, 4760.0, 0.843972, "HOME", 10),
        (4, "CENTER_FORWARD", "CENTRE", False, 4760.0, 5640.0, 880.0, 0.156028, "HOME", 10),
    ]


def test_resolutions(spark):
    t1, t2, t3 = T(2024, 1, 1), T(2024, 1, 2), T(2024, 1, 3)
    ids = spark.createDataFrame([("A", "x", 7, False, 100, t2), ("A", "x", 8, True, 90, t1), ("A", "y", 7, False, 90, t1), ("A", "y", 9, False, None, t3), ("A", "z", 7, True, 100, t1)], "source_system string, source_id string, canonical_id long, is_primary boolean, confidence int, updated_at timestamp")
    overrides = spark.createDataFrame([("A", "z", 5), ("A", "w", 6)], "source_system string, source_id string, canonical_id long")
    assert rows(bridge.resolutions(ids, overrides, ["source_system", "source_id"])) == [("A", "w", 6, "OVERRIDE"), ("A", "x", 8, "IDENTITY"), ("A", "y", 7, "IDENTITY"), ("A", "z", 5, "OVERRIDE")]


def test_merges(spark):
    target = spark.createDataFrame([(1, "a", None), (2, "b", 5), (3, None, 6)], "k long, v string, n long")
    new = spark.createDataFrame([(2, None, 7), (4, "d", 8)], "k long, v string, n long")
    assert rows(merge.upsert(target, new, ["k"])) == [(1, "a", None), (2, None, 7), (3, None, 6), (4, "d", 8)]
    assert rows(merge.insert_only(target, new, ["k"])) == [(1, "a", None), (2, "b", 5), (3, None, 6), (4, "d", 8)]
    assert rows(merge.update_only(target, new, ["k"], ["v"])) == [(1, "a", None), (2, None, 5), (3, None, 6)]
    assert rows(merge.update_only(target, new, ["k"], ["v"], prefer_new=True)) == [(1, "a", None), (2, "b", 5), (3, None, 6)]
    assert rows(merge.delete_keys(target, new, ["k"])) == [(1, "a", None), (3, None, 6)]
    assert rows(merge.replace_keys(target, new.withColumn("k", F.lit(2).cast("long")), ["k"])) == [(1, "a", None), (2, None, 7), (2, "d", 8), (3, None, 6)]
    got = merge.merge(target, new, ["k"], matched={"n": F.col("new.n")}, inserted={"v": F.lit("NEW")})
    assert rows(got) == [(1, "a", None), (2, "b", 7), (3, None, 6), (4, "NEW", 8)]
    assert rows(merge.changed(target, target.where("k < 3").withColumn("n", F.when(F.col("k") == 1, None).otherwise(0)), ["k"], ["v", "n"]).select("k")) == [(2,), (3,)]


def test_reprocess_with_empty_target(spark):
    src = spark.createDataFrame([(1, T(2024, 1, 1)), (2, T(2024, 2, 1))], "k long, ts timestamp")
    assert incremental.reprocess(src, src.limit(0), "ts", ["k"], 7).count() == 2
    assert rows(incremental.since_last(src, src, "ts", "ts", 7).select("k")) == [(2,)]


def test_ranking(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 5), ("a", 3, None), ("b", 4, 1)], "g string, id long, v long")
    assert rows(ranking.first_by(df, ["g"], [F.col("v").desc_nulls_last(), F.col("id")])) == [("a", 1, 5), ("b", 4, 1)]
    assert rows(ranking.top_by(df, ["g"], [F.col("v").desc_nulls_last(), F.col("id")], 2).select("id")) == [(1,), (2,), (4,)]
    assert rows(ranking.sum_before(df, ["g"], [F.col("id")], "v", "s").select("id", "s")) == [(1, 0), (2, 5), (3, 10), (4, 0)]
    assert rows(ranking.next_or(df, ["g"], [F.col("id")], "id", F.lit(99), "n").select("id", "n")) == [(1, 2), (2, 3), (3, 99), (4, 99)]
    assert rows(ranking.best_value(df, ["g"], F.col("v"), "id", "best")) == [("a", 1), ("b", 4)]


def test_flatten(spark):
    df = spark.createDataFrame([(1, ("n", (5,)), [1, 2]), (2, None, []), (3, ("m", None), None)], "id long, a struct<name:string,b:struct<c:int>>, list array<int>")
    assert flatten.flatten_structs(df).columns == ["id", "a.name", "a.b.c", "list"]
    assert rows(flatten.explode_rows(df, "list", "x", ["id"], position="at")) == [(1, 0, 1), (1, 1, 2)]
    assert rows(flatten.explode_rows(df, "list", "x", ["id"], outer=True)) == [(1, 1), (1, 2), (2, None), (3, None)]
    values = spark.createDataFrame([(1, "p", 1, 0.5, 1), (1, "p", 1, 0.7, 2), (1, "p", 9, 1.0, 3), (1, "q", 2, 2.0, 4)], "event long, who string, kpi long, value double, ord long")
    names = spark.createDataFrame([(1, "GOALS"), (2, "SHOTS")], "id long, name string")
    got = flatten.attach_named_values(values, names, "event", ["who"], "kpi", "value", "ord", "kpi_").first()["entries"]
    assert [tuple(e) for e in got] == [("p", '{"GOALS":0.7,"kpi_9":1.0}'), ("q", '{"SHOTS":2.0}')]
    maps = spark.createDataFrame([([{"w": []}, {"w": [3, 4]}, {"s": [9]}],), ([],), (None,)], "m array<map<string,array<long>>>")
    assert [r[0] for r in maps.select(flatten.first_mapping("m", "w")).collect()] == [3, None, None]
    assert flatten.only_known_columns(df.withColumnRenamed("id", "ID"), df.drop("list")).columns == ["id", "a"]


def test_identity(spark):
    ext = spark.createDataFrame([("1", "Müller", "2000-01-01"), ("2", "O'Brien", None), ("3", "New", None), ("4", "Twin", None), ("5", "muller", "2000-01-01")], "source_id string, name string, birth_date string")
    own = spark.createDataFrame([(10, "muller", "2000-01-01"), (11, "obrien", None), (12, "twin", None), (13, "Twin", None), (14, "muller", None)], "canonical_id long, name string, birth_date string")
    over = spark.createDataFrame([("5", 99)], "source_id string, canonical_id long")
    got = identity.classified(ext, own, over)
    assert rows(got.select("source_id", "outcome", "canonical_id", "candidates")) == [("1", "LINK", 10, None), ("2", "LINK", 11, None), ("3", "MINT", None, None), ("4", "AMBIGUOUS", None, [12, 13]), ("5", "OVERRIDE", 99, None)]
    queue_ = spark.createDataFrame([("A", "4", 12, "PENDING")], "source_system string, source_id string, candidate_id long, status string")
    assert rows(identity.queued_candidates(got.where("outcome = 'AMBIGUOUS'"), queue_, "A").select("candidate_id")) == [(12,), (13,)]
    many = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k"))
    ids = identity.minted(many, spark.createDataFrame([(50,)], "id long"), "k")
    assert rows(ids) == [(k, 51 + k) for k in range(1000)]
    said = many.select(F.lpad(F.col("k").cast("string"), 4, "0").alias("k"))  # ids are text in the identity tables
    assert rows(identity.minted(said, spark.createDataFrame([], "id long"), "k")) == [(f"{k:04}", k + 1) for k in range(1000)]
    new = identity.new_externals(spark.createDataFrame([(1, 5), (1, 6), (2, None)], "id long, it long"), spark.createDataFrame([("2",)], "source_id string"), "id", [F.col("it").desc_nulls_last()])
    assert rows(new) == [(1, 6)]


def test_merged_players(spark):
    players = spark.createDataFrame([(1, True), (2, True), (3, False)], "canonical_id long, is_active boolean")
    ids = spark.createDataFrame([("A", "x", 2), ("A", "y", 1)], "source_system string, source_id string, canonical_id long")
    p, i, o = identity.merged_players(players, ids, ids.limit(0), 1, 2)
    assert rows(p) == [(1, True), (2, False), (3, False)] and rows(i) == [("A", "x", 1), ("A", "y", 1)] and rows(o) == [("A", "x", 1)]
    for pair in ((1, 1), (1, 9), (3, 1)):
        with pytest.raises(ValueError):
            identity.merged_players(players, ids, ids.limit(0), *pair)


QUEUE = "match_id long, scheduled_at timestamp_ntz, status string, attempt_count int, next_attempt_at timestamp_ntz, claimed_by string, claimed_at timestamp_ntz, event_count long, last_error string, completed_at timestamp_ntz"


def test_queue(spark):
    now = F.expr("timestamp_ntz '2024-01-02 00:00:00'")
    entry = lambda k, status, at=None, n=0, nxt=None, by=None, since=None: (k, at, status, n, nxt, by, since, None, None, None)
    q = spark.createDataFrame([entry(1, "PENDING", T(2024, 1, 1)), entry(2, "PENDING"), entry(3, "FAILED", T(2023, 1, 1), 1, T(2024, 1, 3)), entry(4, "RUNNING", T(2023, 1, 1), 1, None, "w0", T(2024, 1, 1, 1)), entry(5, "FAILED", T(2022, 1, 1), 5), entry(6, "SUCCESS")], QUEUE)
    c = queue.claimed(q, now, "w1", 2, 5)
    assert rows(c.where("claimed_by = 'w1'").select("match_id", "attempt_count")) == [(2, 1), (4, 2)]
    res = spark.createDataFrame([(2, "SUCCESS", 10, None), (4, "FAILED", None, "e" * 5000)], "match_id long, outcome string, event_count long, error string")
    f = queue.finished(c, res, now)
    assert rows(f.where("match_id in (2, 4)").select("match_id", "status", "event_count", F.length("last_error"), "next_attempt_at")) == [(2, "SUCCESS", 10, None, None), (4, "FAILED", None, 4000, T(2024, 1, 2, 12))]
    assert rows(queue.released(c, "w1").where("match_id = 2").select("status", "attempt_count")) == [("PENDING", 0)]
    counts = queue.counts(q, now, 5).withColumn("stage", queue.stage_status()).first()
    assert (counts["pending"], counts["running"], counts["deferred"], counts["exhausted"], counts["loaded"], counts["stage"]) == (2, 1, 1, 1, 1, "in_progress")
    assert queue.grouped_by_budget([40, 40, 40, 100, 10], 90) == [[0, 1], [2], [3], [4]]


@pytest.fixture
def no_broadcasts(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_queue_results_are_dealt_by_the_bytes_of_their_errors(spark, no_broadcasts, monkeypatch):
    monkeypatch.setattr(queue, "TASK_BYTES", 200_000, raising=False)
    q = spark.range(1_000).selectExpr("id as match_id", *[f"cast(null as {kind}) as {name}" for name, kind in (c.rsplit(" ", 1) for c in QUEUE.split(", ")[1:])])
    res = spark.range(0, 1_000, 2).select(F.col("id").alias("match_id"), F.when(F.col("id") % 4 == 0, "FAILED").otherwise("SUCCESS").alias("outcome"), F.lit(7).cast("long").alias("event_count"), F.repeat(F.lit("e"), 5_000).alias("error"))
    out = queue.finished(q, res, F.expr("timestamp_ntz '2024-01-02 00:00:00'"))
    held = [sum(len(r["last_error"] or "") for r in part) for part in out.rdd.glom().collect()]
    assert sum(held) == 250 * 4_000 and max(held) < 500_000


def test_rows_without_a_key_are_dealt_out(spark, no_broadcasts, tmp_path):
    spark.range(50).selectExpr("cast(id as int) as k", "id as v").write.parquet(str(tmp_path / "known"))
    left = spark.range(4_000).selectExpr("id", "case when id % 10 = 0 then id % 60 end as k")
    out = merge.looked_up(left, spark.read.parquet(str(tmp_path / "known")), "k", "id")
    assert rows(out.select("id", "k", "v")) == rows(left.join(spark.read.parquet(str(tmp_path / "known")), "k", "left").select("id", "k", "v"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert max(len(part) for part in out.rdd.glom().collect()) < 2_000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_discovery(spark):
    edges = spark.createDataFrame([("t33", "f1"), ("t99", "f1"), ("t99", "f2"), ("t100", "f2"), ("t7", "f9"), (None, "f1")], "a string, b string")
    got = discovery.reachable(edges, spark.createDataFrame([("t33",), ("t33",)], "node string"))
    assert rows(got) == [("f1", 1), ("f2", 3), ("t100", 4), ("t33", 0), ("t99", 2)]


def test_quality(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "c"), (None, "a")], "k long, v string")
    assert rows(quality.not_unique(df, ["k"])) == [(1, 2)]
    assert quality.not_null(df, ["k", "v"]).count() == 2
    assert rows(quality.orphans(df, "k", spark.createDataFrame([(1,)], "id long"), "id")) == [(2, "c")]
    assert rows(quality.not_accepted(df, "v", ["a"])) == [(2, "c")]
    ts = spark.createDataFrame([(T(2024, 1, 1),)], "ts timestamp")
    status = lambda now: quality.freshness(ts, "ts", F.lit(now), 24, 72).first()["status"]
    assert [status(T(2024, 1, d)) for d in (1, 3, 9)] == ["pass", "warn", "error"]


def test_text_and_scalars(spark):
    df = spark.createDataFrame([("Müller ", "2024-01-02T19:00:00+02:00", "1.5", "23/24"), ("O'Brien  Van  Dyk", "x", "7", "2021"), (None, None, None, "?")], "n string, ts string, i string, s string")
    assert [r[0] for r in df.select(text.normalize_name(F.col("n"))).collect()] == ["muller", "obrienvandyk", ""]
    assert [r[0] for r in df.select(text.normalize_text(F.col("n"))).collect()] == ["muller ", "o'brien  van  dyk", ""]
    assert [tuple(r) for r in df.select(text.first_name(F.col("n")), text.other_names(F.col("n"))).collect()] == [("Müller", None), ("O'Brien", "Van Dyk"), (None, None)]
    got = df.select(scalars.timestamp_or_null("ts"), scalars.utc_or_null("ts"), scalars.integer_or_null("i"), scalars.season_year(F.col("s"))).collect()
    assert tuple(got[0]) == (T(2024, 1, 2, 19), T(2024, 1, 2, 17), None, 2023) and tuple(got[1]) == (None, None, 7, 2021) and tuple(got[2]) == (None,) * 4
    assert scalars.cleaned_columns(df.select(F.col("n").alias(" a.b (c) "))).columns == ["A_B_C"]


def test_stages(spark, tmp_path):
    from fieldspark.operators import stages

    data = [(1, "95/96", 1, 5, 2), (2, "95/96", None, 1, 1), (3, "1990", 1, 7, 7), (4, "95/96", 1, 5, 0), (5, "1994", 9, 2, 2), (1, "95/96", 1, 1, 1)]
    its = spark.createDataFrame(data, "iteration_id long, season string, country_id long, matches long, todo long")
    got = stages.cells(its, {"new": ["95/96"], "old": ["1994"]}, {"g": [1], "h": [9, 1]}).orderBy("block_place", "group_place").collect()
    assert [tuple(r) for r in got] == [(0, "new", 0, "g", [1, 4], 11, 3), (0, "new", 2, stages.OTHER, [2], 1, 1), (1, "old", 1, "h", [5], 2, 2)]
    assert stages.cells(its.limit(0), {"new": ["95/96"]}, {"g": [1]}).count() == 0
    (tmp_path / "no.json").write_text('{"name": "x"}')
    with pytest.raises(ValueError):
        stages.read_plan(spark, str(tmp_path / "no.json"))
    with pytest.raises(ValueError):
        stages.selected(its.withColumn("block", F.lit("a")), ["a", "b"])


def test_exact_quantiles(spark):
    values = [(k % 3, float(v)) for k, v in enumerate([5, 1, 9, 9, 2, 7, 7, 7, 3, 4, 8, 1, 6])] + [(None, 3.0), (0, None)]
    got = ranking.exact_quantiles(spark.createDataFrame(values, "k int, v double"), ["k"], "v", {"median": 0.5, "p90": 0.9, "most": 1.0}).collect()
    import numpy as np

    for r in got:
        own = [v for k, v in values if k == r["k"] and v is not None]
        assert (r["median"], r["most"]) == (np.median(own), max(own)) and abs(r["p90"] - np.quantile(own, 0.9)) < 1e-9
    assert len(got) == 3


def test_guarded_updates(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, None, 3)], "k long, g string, v long")
    new = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "k long, v long")
    guard = spark.createDataFrame([("a",), (None,)], "g string")
    assert rows(merge.update_guarded(old, new, ["k"], ["v"], guard, ["g"])) == [(1, "a", 1), (2, "b", 20), (3, None, 30)]
    assert rows(merge.update_if(old, new, ["k"], ["v"], F.col("old.v") >= 2)) == [(1, "a", 1), (2, "b", 20), (3, None, 30)]
    assert rows(merge.not_done(old, new.where("k < 3"), ["k"], F.col("g") == "b")) == [(2, "b", 2), (3, None, 3)]


def test_paging_and_logins():
    from fieldspark.sources import rest

    seen = []

    def call(token, key, page):
        seen.append(token)
        if token == 1:
            raise rest.Unauthorized
        return [key], page < 1

    tokens = iter((1, 2, 3))
    fetch = rest.with_login(lambda: next(tokens), call)
    assert fetch("a", 0) == (["a"], True) and fetch("a", 1) == (["a"], False) and seen == [1, 2, 2]
    get = rest.by_offset(lambda key, offset, limit: (list(range(offset, min(7, offset + limit))), 7), 3)
    assert [get("k", p) for p in range(4)] == [([0, 1, 2], True), ([3, 4, 5], True), ([6], False), ([], False)]


def test_schema_names():
    from fieldspark.plans.registry import schema_name

    assert [schema_name(*x) for x in ((None, "dev", "D"), (" CORE ", "prod", "D"), ("CORE", "dev", "D"))] == ["D", "CORE", "CORE_D"]
