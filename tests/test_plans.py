"""Registry, ledger, sinks, sources, streams and the football models."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from fieldspark.operators import spells
from fieldspark.plans.models import football
from fieldspark.plans.registry import LEDGER, TABLE, FailedTest, Plan, recorded
from fieldspark.sources import rest, sinks, tables
from fieldspark.streaming import upserts

T = datetime.datetime


def fetch(key, page):
    """Two pages of two objects for each key; the first request is refused."""
    if not hasattr(fetch, "seen"):
        fetch.seen = True
        raise rest.TooManyRequests("0")
    return [{"key": key, "n": 2 * page}, {"key": key, "n": 2 * page + 1}], page == 0


def test_rest_source(spark):
    spark.dataSource.register(rest.PagedSource)
    df = spark.read.format("paged_json").option("fetch", "tests.test_plans:fetch").option("keys", "a,b").load()
    assert sorted((r["key"], json.loads(r["payload"])["n"]) for r in df.collect()) == [(k, n) for k in "ab" for n in range(4)]
    assert rest.seconds_of("3") == 3.0 and rest.seconds_of("soon") is None and rest.seconds_of("Thu, 01 Jan 1970 00:01:00 GMT", now=50.0) == 10.0
    pace = rest.Pace(floor=0.1)
    assert [round(pace.refused(), 2), round(pace.refused(), 3)] == [0.65, 1.475] and all(pace.answered() >= 0.1 for _ in range(40)) and pace.wait == 0.1


def _login():
    _login.n = getattr(_login, "n", 0) + 1
    return f"token {_login.n}"


def _guarded(token, key, page):
    if token == "token 1":
        raise rest.Unauthorized
    if key == "b":
        raise rest.Unauthorized
    return [token], False


def test_login_again_once():
    fetch = rest.with_login(_login, _guarded)
    assert fetch("a", 0) == (["token 2"], False) and fetch("a", 1) == (["token 2"], False)
    with pytest.raises(rest.Unauthorized):
        fetch("b", 0)


def test_archive_pages(tmp_path):
    from fieldspark.sources import archive

    for k, n in enumerate((700, 0, 900, 400)):
        (tmp_path / f"part-{k}.json").write_text("".join(json.dumps({"n": 1000 * k + i}) + "\n" for i in range(n)))
    key, got, page, more = f"file://{tmp_path}", [], 0, True
    while more:
        objects, more = archive.rows_of_folder(key, page)
        assert len(objects) == (1000 if more else 0) or page == 1
        got += objects
        page += 1
    by_file = [x for p in range(4) for x in archive.page_of_folder(key, p)[0]]
    assert got == by_file and len(got) == 2000 and not archive.page_of_folder(key, 3)[1]
    (tmp_path / "empty").mkdir()
    assert archive.page_of_folder(f"{key}/empty", 0) == ([], False) == archive.rows_of_folder(f"{key}/empty", 0)


def _shuffled(plan):
    """The names of the columns of each exchange in a physical plan."""
    own = [{plan.output().apply(i).name() for i in range(plan.output().size())}] if "ShuffleExchange" in plan.getClass().getSimpleName() else []
    return own + [x for i in range(plan.children().size()) for x in _shuffled(plan.children().apply(i))]


def test_ids_of_bucketed_rows_without_a_shuffle(spark, tmp_path):
    from fieldspark.plans import models
    from fieldspark.sources import buckets

    raw = spark.range(4_000).select(F.when(F.col("id") % 50 != 0, F.col("id") % 40).alias("source_player_id"), F.when(F.col("id") % 30 != 0, F.floor(F.col("id") / 400)).alias("source_fixture_id"), F.lit(101).cast("long").alias("iteration_id"), (F.col("id") % 7).alias("kpi_id"), F.col("id").cast("double").alias("kpi_value"))
    ids = lambda canonical, n: spark.range(n).select(F.lit("A").alias("source_system"), F.col("id").cast("string").alias("source_id"), (F.col("id") + 1_000).alias(canonical)).unionByName(spark.createDataFrame([("MANUAL", "1", 5)], f"source_system string, source_id string, {canonical} long"))
    players, fixtures = ids("player_id", 30), ids("fixture_id", 9)
    season = spark.createDataFrame([(101, 1)], "season_id long, competition_id long")
    want = sorted(map(str, models.fixture_kpis(raw, players, fixtures, season).collect()))
    keyed = models.with_pair(raw, "source_player_id", "source_fixture_id")
    fact = buckets.write_bucketed(keyed, "kpis_in_buckets", str(tmp_path / "b"), list(models.PAIR), 8)
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        moved = lambda df: [x for x in _shuffled(df._jdf.queryExecution().executedPlan()) if any(c == "kpi_value" for c in x)]
        twice = models.resolved(models.resolved(raw, players, "source_player_id", "player_id"), fixtures, "source_fixture_id", "fixture_id")
        once = models.resolved_pairs(fact, players, fixtures)
        assert len(moved(twice)) == 2 and not moved(once)
        assert sorted(map(str, once.select(twice.columns).collect())) == sorted(map(str, twice.collect()))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    got = models.fixture_kpis(fact, players, fixtures, season)
    columns = models.fixture_kpis(raw, players, fixtures, season).columns
    assert len(want) > 2_000 and sorted(map(str, got.select(columns).collect())) == want and fact.count() == 4_000
    empty = buckets.write_bucketed(keyed.limit(0), "no_kpis_in_buckets", str(tmp_path / "e"), list(models.PAIR), 8)
    assert models.resolved_pairs(empty, players, fixtures).count() == 0
    spark.sql("drop table kpis_in_buckets")
    spark.sql("drop table no_kpis_in_buckets")


def test_registry(spark, tmp_path):
    spark.createDataFrame([(1, 2), (1, 3)], "k long, v long").write.parquet(str(tmp_path / "src.parquet"))
    plan = Plan(tables.Sources(str(tmp_path)), str(tmp_path / "out"))
    plan.model("b", "a", kept=TABLE)(lambda a: a.groupBy("k").count())
    plan.model("a", "src")(lambda s: s.where("v > 0"))
    assert plan.order() == ["a", "b"] and plan.order(["a"]) == ["a"]
    assert plan.build(spark)["b"].collect()[0]["count"] == 2
    plan.model("c", "a", grain=("k",))(lambda a: a)
    with pytest.raises(FailedTest):
        plan.build(spark, ["c"])


def test_ledger(spark, tmp_path):
    path = str(tmp_path / "runs")
    assert recorded(spark, path, "p", lambda run: None) == 1
    with pytest.raises(RuntimeError):
        recorded(spark, path, "p", lambda run: (_ for _ in ()).throw(RuntimeError("x" * 2000)))
    got = spark.read.schema(LEDGER).parquet(path).orderBy("run_id").collect()
    assert [(r["run_id"], r["status"], len(r["notes"] or "")) for r in got] == [(1, "SUCCESS", 0), (2, "FAILED", 1000)]


def test_sinks(spark, tmp_path):
    p = str(tmp_path / "t")
    one = spark.createDataFrame([(1, "a"), (2, "b")], "k long, g string")
    assert sinks.write_parts([one, one.withColumn("k", F.col("k") + 2)], p) == 2 and spark.read.parquet(p).count() == 4
    sinks.swap(spark.read.parquet(p).where("k < 4"), p)
    assert spark.read.parquet(p).count() == 3
    q = str(tmp_path / "q")
    sinks.replace_partitions(one, q, ["g"])
    sinks.replace_partitions(spark.createDataFrame([(9, "a")], "k long, g string"), q, ["g"])
    assert sorted(r["k"] for r in spark.read.parquet(q).collect()) == [2, 9]
    sinks.staged_json(spark.createDataFrame([(1, '{"a": 1}'), (2, "no")], "k long, j string"), str(tmp_path / "j"), ["j"], ["k"])
    assert [r[0] for r in spark.read.parquet(str(tmp_path / "j")).orderBy("k").selectExpr("variant_get(j, '$.a', 'int')").collect()] == [1, None]
    (tmp_path / "files").mkdir()
    for f, n in (("small", 3), ("large", 50)):
        (tmp_path / "files" / f"{f}.bin").write_bytes(b"x" * n)
    assert sorted((r["length"], r["content"] is None) for r in tables.read_payloads(spark, str(tmp_path / "files"), 10, "*.bin").collect()) == [(3, False), (50, True)]


def test_streams(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    schema = "k long, v long, op string"
    write = lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
    run = lambda f, to: upserts.start(spark.readStream.schema(schema).parquet(src), f, str(tmp_path / f"{to}-log")).awaitTermination()
    newest, changes = upserts.into_table(out, ["k"], [F.col("v").desc()]), upserts.changes_into(f"{out}2", "k")
    write([(1, 1, "put"), (1, 2, "put"), (2, 5, "put")])
    run(newest, "a"), run(changes, "b")
    write([(1, 3, "put"), (2, 0, "delete")])
    run(newest, "a"), run(changes, "b")
    assert sorted(tuple(r)[:2] for r in spark.read.parquet(out).collect()) == [(1, 3), (2, 0)]
    assert sorted(tuple(r) for r in spark.read.parquet(f"{out}2").collect()) == [(1, 3)]
    cursor = spark.createDataFrame([("f", T(2024, 1, 2))], "feed string, at timestamp")
    rows = spark.createDataFrame([(1, T(2024, 1, 1)), (2, T(2024, 1, 1, 23, 50))], "k long, ts timestamp")
    assert [r["k"] for r in upserts.since_cursor(rows, "ts", cursor.select("at")).collect()] == [2]
    assert upserts.since_cursor(rows, "ts", cursor.select("at").limit(0), now=F.lit(T(2024, 1, 3))).count() == 2
    assert upserts.advanced(cursor, "f", F.lit(T(2024, 2, 1)), failed=1).first()["at"] == T(2024, 1, 2) and upserts.advanced(cursor, "f", F.lit(T(2024, 2, 1)), failed=0).first()["at"] == T(2024, 2, 1)


def test_football(spark, tmp_path):
    root = str(tmp_path / "raw")

    def put(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"{root}/{name}.parquet")

    put("iterations", [(100, "23/24", "V2", "2024-01-01T00:00:00Z", 1, "Cup", "c", 5, "MALE"), (101, "22/23", "V2", None, 1, "Old", "c", 5, "MALE"), (102, "x", "V2", None, 2, "W", "c", 5, "FEMALE")], "id long, season string, dataVersion string, lastChangeTimestamp string, `competition.id` long, `competition.name` string, `competition.type` string, `competition.countryId` long, `competition.gender` string")
    put("squads", [(10, "Ten", 1, "t", "MALE", None, 100), (10, "Older", 1, "t", "MALE", None, 99), (20, "Twenty", 1, "t", "MALE", None, None)], "id long, name string, countryId long, type string, gender string, imageUrl string, iterationId long")
    put("players", [(7, "A", "B", "AB", "2000-01-01", "L", "MALE", 10.0, 100), (7, "A", "B", "AB", "bad", "L", "MALE", float("nan"), 99)], "id long, firstname string, lastname string, commonname string, birthdate string, leg string, gender string, currentSquadId double, iterationId long")
    put("player_identities", [(1, "A", "7", 1000, True, 100, T(2024, 1, 1)), (2, "MANUAL", "m7", 1000, True, 1, T(2024, 1, 1))], "identity_id long, source_system string, source_id string, player_id long, is_primary boolean, confidence int, updated_at timestamp")
    put("player_overrides", [("A", "8", 2000)], "source_system string, source_id string, player_id long")
    put("fixture_identities", [(1, "A", "1", 5000, True, 100, T(2024, 1, 1)), (2, "MANUAL", "3", 5001, True, 1, T(2024, 1, 1))], "identity_id long, source_system string, source_id string, fixture_id long, is_primary boolean, confidence int, updated_at timestamp")
    put("matches", [(1, 100, 10, 20, "2024-02-01T15:00:00Z", True, 4, "MD4")], "id long, iterationId long, homeSquadId long, awaySquadId long, scheduledDate string, available boolean, `matchDay.index` int, `matchDay.name` string")
    put("canonical_fixtures", [(5000, datetime.date(2024, 2, 1)), (5001, datetime.date(2024, 3, 1))], "fixture_id long, fixture_date date")
    put("app_fixtures", [(3, "Home", "Away", None)], "id long, home_name string, away_name string, scheduled_at timestamp_ntz")
    put("canonical_players", [(1000, "A B", None, None), (2000, "C", None, False)], "player_id long, display_name string, birth_date date, is_active boolean")
    put("app_players", [("m7", "A B", None), ("m9", "Local", None)], "id string, name string, birth_date date")
    put("events", [(1, 100, 1, 1, 1, 0.0, 7, "CB"), (1, 100, 2, 2, 1, 2700.0, 7, "RB"), (1, 100, 3, 3, 2, 12700.0, None, None)], "matchId long, iterationId long, id long, index long, periodId long, gameTimeInSec double, playerId long, position string")
    put("match_info", [(1, 100, 10, [(7, "CB", "LEFT")], [], 20, [], [])], f"match_id long, iteration_id long, home_squad_id long, home_starting {spells.STARTS}, home_changes {spells.CHANGES}, away_squad_id long, away_starting {spells.STARTS}, away_changes {spells.CHANGES}")
    put("player_kpis", [(7, 1, 100, "2024-02-01T15:00:00Z", 10, "squadHome", p, 3, 1.5, 2700.0, 0.5) for p in ("CB", "RB")], "playerId long, matchId long, iterationId long, scheduledDate string, squadId long, side string, position string, kpiId long, value double, playDuration double, matchShare double")
    plan = football(tables.Sources(root), str(tmp_path / "out"))
    wanted = ["competitions", "player_context", "player_season_kpis", "player_season_participation", "player_fixture_participation", "app_matches_view", "app_players_view"]
    built = plan.build(spark, wanted)
    get = lambda n, *c: [tuple(r) for r in built[n].select(*c).orderBy(*c).collect()]
    assert get("competitions", "competition_id", "competition_name") == [(1, "Cup")]
    assert get("player_context", "player_id", "squad_name", "season_name", "competition_name") == [(1000, "Ten", "23/24", "Cup")]
    assert get("player_season_kpis", "player_id", "season_total", "season_average", "matches_played", "total_play_duration_seconds") == [(1000, 3.0, 1.5, 1, 5400.0)]
    assert get("player_fixture_participation", "player_id", "fixture_id", "dominant_position", "play_duration", "started") == [(1000, 5000, "CB", 5400.0, True)]
    assert get("player_season_participation", "player_id", "appearances", "starts") == [(1000, 1, 1)]
    assert get("app_matches_view", "FIXTURE_ID", "FIXTURE_NAME", "DATA_SOURCE") == [(5000, "Ten vs Twenty", "external"), (5001, "Home vs Away", "internal")]
    assert sorted(map(str, get("app_players_view", "player_id", "display_name", "position_code", "data_source"))) == sorted(map(str, [(1000, "A B", "RB", "external"), (None, "Local", None, "internal")]))
    assert len(plan.models) >= 50
