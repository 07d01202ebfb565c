"""The football models: typed staging views, canonical dimensions, bridges and facts, and views of fixed columns.

``football(sources, target)`` registers them over the sources named in ``SOURCES``. Provider ids are numbers in the
sources and text in the identity tables; canonical ids are this library's own.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldspark.functions.scalars import at_path, date_or_null, id_of_float, json_or_null, timestamp_or_null, versus
from fieldspark.operators import bridge, merge, quality, ranking, spells
from fieldspark.plans.registry import INCREMENTAL, TABLE, Plan
from fieldspark.sources.tables import Sources

#: Where canonical rows come from.
PROVIDER, MANUAL = "A", "MANUAL"
PASSED_THROUGH = ("agent_profiles", "password_resets", "list_flags", "list_items", "lists", "recommendations", "position_attributes", "note_history", "attribute_scores", "report_views", "reports", "shared_links", "status_history", "users")


def typed(df: DataFrame, columns: dict[str, str | Column]) -> DataFrame:
    """Rename and cast: {new name: old name, or an expression}; dots in an old name are part of it."""
    return df.select(*[(F.col(f"`{c}`") if isinstance(c, str) else c).alias(n) for n, c in columns.items()])


# staging: source column -> typed column

STAGING: dict[str, tuple[str, dict]] = {
    "stg_countries": ("countries", {"country_id": "id", "country_name": "name", "fifa_code": "fifaCode"}),
    "stg_coaches": ("coaches", {"coach_id": "id", "coach_name": "name", "iteration_id": "iterationId"}),
    "stg_stadiums": ("stadiums", {"stadium_id": "id", "stadium_name": "name", "length": "length", "width": "width"}),
    "stg_squads": ("squads", {"squad_id": "id", "squad_name": "name", "country_id": "countryId", "squad_type": "type", "gender": "gender", "image_url": "imageUrl", "iteration_id": "iterationId"}),
    "stg_players": ("players", {"source_player_id": "id", "first_name": "firstname", "last_name": "lastname", "common_name": "commonname", "birth_date": lambda: date_or_null("birthdate"), "strong_foot": "leg", "gender": "gender", "current_squad_id": lambda: id_of_float(F.col("currentSquadId")), "iteration_id": "iterationId"}),
    "stg_iterations": ("iterations", {"iteration_id": "id", "season": "season", "data_version": "dataVersion", "last_change_at": lambda: timestamp_or_null("lastChangeTimestamp"), "competition_id": "competition.id", "competition_name": "competition.name", "competition_type": "competition.type", "competition_country_id": "competition.countryId", "competition_gender": "competition.gender"}),
    "stg_matches": ("matches", {"source_fixture_id": "id", "iteration_id": "iterationId", "home_squad_id": "homeSquadId", "away_squad_id": "awaySquadId", "scheduled_at": lambda: timestamp_or_null("scheduledDate"), "is_available": "available", "matchday_index": "matchDay.index", "matchday_name": "matchDay.name"}),
    "stg_player_kpis": ("player_kpis", {"source_player_id": "playerId", "source_fixture_id": "matchId", "iteration_id": "iterationId", "scheduled_at": lambda: timestamp_or_null("scheduledDate"), "squad_id": "squadId", "squad_side": "side", "position_code": "position", "kpi_id": "kpiId", "kpi_value": "value", "play_duration_seconds": "playDuration", "match_share": "matchShare"}),
    "stg_squad_kpis": ("squad_kpis", {"squad_id": "squadId", "source_fixture_id": "matchId", "iteration_id": "iterationId", "kpi_id": "kpiId", "kpi_value": "value"}),
    "stg_iteration_player_kpis": ("iteration_player_kpis", {"source_player_id": "playerId", "iteration_id": "iterationId", "squad_id": "squadId", "position_code": "position", "kpi_id": "kpiId", "kpi_value": "value"}),
    "stg_iteration_player_scores": ("iteration_player_scores", {"source_player_id": "playerId", "iteration_id": "iterationId", "squad_id": "squadId", "score_id": "scoreId", "score_value": "value"}),
    "stg_iteration_squad_kpis": ("iteration_squad_kpis", {"squad_id": "squadId", "iteration_id": "iterationId", "kpi_id": "kpiId", "kpi_value": "value"}),
    "stg_iteration_squad_scores": ("iteration_squad_scores", {"squad_id": "squadId", "iteration_id": "iterationId", "score_id": "scoreId", "score_value": "value"}),
    "stg_match_index": ("match_index", {"source_fixture_id": "id", "iteration_id": "iterationId", "season": "season", "competition_name": "competitionName"}),
    "stg_match_info_text": ("match_info_text", {"source_fixture_id": "id", "home": lambda: json_or_null("homeJson"), "away": lambda: json_or_null("awayJson")}),
    "stg_events": ("events", {"match_id": "matchId", "iteration_id": "iterationId", "event_id": "id", "event_index": "index", "period_id": "periodId", "clock": "gameTimeInSec", "source_player_id": "playerId", "player_position": "position"}),
    "stg_match_info": ("match_info", {c: c for c in ("match_id", "iteration_id", *(f"{s}_{c}" for s in ("home", "away") for c in ("squad_id", "starting", "changes")))}),
}
#: Fixed value: the category that staging leaves out unless asked for; the column that has it, by model.
MALE = "MALE"
CATEGORY = {"stg_players": "gender", "stg_squads": "gender", "stg_iterations": "competition_gender"}
SOURCES = sorted({source for source, _ in STAGING.values()} | {"fixture_versions", "player_identities", "player_overrides", "fixture_identities", "canonical_players", "canonical_fixtures", "app_players", "app_fixtures", "player_notes", "player_information", "player_stage_history", *PASSED_THROUGH})


def resolved(df: DataFrame, ids: DataFrame, source: str, canonical: str) -> DataFrame:
    """``df`` with the canonical id of its numeric provider id; rows without one go."""
    own = ids.where(F.col("source_system") == PROVIDER).select(F.col("source_id").alias("__id"), canonical)
    return df.join(own, F.col(source).cast("string") == F.col("__id")).drop("__id")


#: Provider ids as text, in rows that are bucketed on both.
PAIR = ("player_key", "fixture_key")


def with_pair(df: DataFrame, player: str, fixture: str) -> DataFrame:
    """``df`` with ``PAIR``, the text of its numeric ids, to be written in buckets of both."""
    return df.withColumns({PAIR[0]: F.col(player).cast("string"), PAIR[1]: F.col(fixture).cast("string")})


def resolved_pairs(df: DataFrame, players: DataFrame, fixtures: DataFrame) -> DataFrame:
    """``df`` with the canonical ids of its ``PAIR``, as ``resolved`` gives for each; the pair itself goes.

    Pairs are resolved, of which there are as many fewer as a player has rows in a match, and joined to the rows once. If
    ``df`` is bucketed on the pair no row of it is shuffled: its pairs are made distinct, and met again, in their buckets.
    """
    pairs = df.select(*PAIR).where(F.col(PAIR[0]).isNotNull() & F.col(PAIR[1]).isNotNull()).distinct()
    known = resolved(resolved(pairs, players, PAIR[0], "player_id"), fixtures, PAIR[1], "fixture_id")
    return df.join(known, list(PAIR)).drop(*PAIR)


def primary_of(identities: DataFrame, system: str, canonical: str, name: str) -> DataFrame:
    """(canonical id, source id) of the primary identity in one system."""
    rows = identities.where(F.col("source_system") == system)
    order = [ranking.primary_first(F.col("is_primary")), F.col("confidence").desc_nulls_last(), F.col("identity_id").asc()]
    return ranking.first_by(rows, [canonical], order).select(canonical, F.col("source_id").alias(name))


def competitions(iterations: DataFrame) -> DataFrame:
    newest = ranking.first_by(iterations, ["competition_id"], [F.col("last_change_at").desc_nulls_last(), F.col("season").desc_nulls_first()])
    return newest.select("competition_id", "competition_name", "competition_type", "competition_country_id", "competition_gender")


def seasons(iterations: DataFrame) -> DataFrame:
    return iterations.select(F.col("iteration_id").alias("season_id"), "competition_id", F.col("season").alias("season_name"), "data_version", "last_change_at", "competition_name", "competition_type", "competition_country_id", "competition_gender")


def squads(stg: DataFrame) -> DataFrame:
    return ranking.first_by(stg, ["squad_id"], [F.coalesce("iteration_id", F.lit(0)).desc(), F.col("squad_name").asc_nulls_last()]).drop("iteration_id")


def player_context(players: DataFrame, ids: DataFrame, season: DataFrame, competition: DataFrame, squad: DataFrame) -> DataFrame:
    """Each player's squad and season in the newest iteration that has one."""
    rows = resolved(players.where("iteration_id is not null"), ids, "source_player_id", "player_id")
    newest = ranking.first_by(rows, ["player_id"], [F.col("iteration_id").desc(), F.col("source_player_id").asc()]).select("player_id", "current_squad_id", F.col("iteration_id").alias("season_id"))
    out = newest.join(season.select("season_id", "season_name", "competition_id"), "season_id", "left").join(competition.select("competition_id", "competition_name", "competition_type"), "competition_id", "left")
    return out.join(squad.select(F.col("squad_id").alias("current_squad_id"), "squad_name"), "current_squad_id", "left").withColumnRenamed("current_squad_id", "squad_id")


def recent_position(events: DataFrame, ids: DataFrame) -> DataFrame:
    """Each player's position in the last event that has one, as an aggregate that is combined before its shuffle."""
    rows = resolved(events.where("player_position is not null"), ids, "source_player_id", "player_id")
    last = F.max_by("player_position", F.struct("iteration_id", "match_id", "event_index"))
    return rows.groupBy("player_id").agg(last.alias("position_code"))


def fixture_details(fixtures: DataFrame, identities: DataFrame, matches: DataFrame, app: DataFrame, season: DataFrame, squad: DataFrame) -> DataFrame:
    """Fixtures with both squads, season and schedule; manual names go before those of the dimensions."""
    side = lambda s: squad.select(F.col("squad_id").alias(f"{s}_squad_id"), F.col("squad_name").alias(f"{s}_known"))
    manual = app.select(F.col("id").cast("string").alias("manual_id"), F.col("home_name").alias("home_manual"), F.col("away_name").alias("away_manual"), F.col("scheduled_at").alias("manual_at"))
    own = matches.select(F.col("source_fixture_id").cast("string").alias("external_id"), "iteration_id", "home_squad_id", "away_squad_id", "scheduled_at", "matchday_index", "matchday_name")
    out = fixtures.join(primary_of(identities, PROVIDER, "fixture_id", "external_id"), "fixture_id", "left").join(primary_of(identities, MANUAL, "fixture_id", "manual_id"), "fixture_id", "left")
    of_season = season.select(F.col("season_id").alias("iteration_id"), "season_name", "competition_id", "competition_name", "competition_type")
    # most fixtures have but one of the two ids, and manual ones no season or squads
    for known, key in ((own, "external_id"), (manual, "manual_id"), (of_season, "iteration_id"), (side("home"), "home_squad_id"), (side("away"), "away_squad_id")):
        out = merge.looked_up(out, known, key, "fixture_id")
    home, away = F.coalesce("home_manual", "home_known"), F.coalesce("away_manual", "away_known")
    return out.select(
        "fixture_id", "external_id", "manual_id", F.coalesce("scheduled_at", "manual_at", F.col("fixture_date").cast("timestamp_ntz")).alias("scheduled_at"), "home_squad_id", "away_squad_id",
        home.alias("home_squad_name"), away.alias("away_squad_name"), versus(home, away).alias("fixture_name"), F.col("iteration_id").alias("season_id"), "season_name", "competition_id", "competition_name", "competition_type", "matchday_index", "matchday_name",
        F.when(F.col("external_id").isNotNull(), "external").otherwise("internal").alias("data_source"),
    )


KPI_GRAIN = ("player_id", "fixture_id", "kpi_id", "squad_id", "position_code")


def fixture_kpis(kpis: DataFrame, players: DataFrame, fixtures: DataFrame, season: DataFrame) -> DataFrame:
    if set(PAIR) <= set(kpis.columns):
        rows = resolved_pairs(kpis, players, fixtures)
    else:
        rows = resolved(resolved(kpis, players, "source_player_id", "player_id"), fixtures, "source_fixture_id", "fixture_id")
    rows = rows.withColumnRenamed("iteration_id", "season_id").join(season.select("season_id", "competition_id"), "season_id", "left")
    return rows.withColumn("source_system", F.lit(PROVIDER))


def unknown_players(kpis: DataFrame, ids: DataFrame) -> DataFrame:
    """Provider players with KPI rows but without a canonical id, whose rows every fact would lack."""
    known = ids.where(F.col("source_system") == PROVIDER)
    return quality.orphans(kpis.select(F.col("source_player_id").cast("string").alias("source_player_id")).distinct(), "source_player_id", known, "source_id")


def season_kpis(kpis: DataFrame) -> DataFrame:
    return kpis.groupBy("player_id", "season_id", "competition_id", "kpi_id").agg(F.sum("kpi_value").alias("season_total"), F.avg("kpi_value").alias("season_average"), F.count_distinct("fixture_id").alias("matches_played"), F.sum("play_duration_seconds").alias("total_play_duration_seconds"))


SEASON_GRAIN = ("player_id", "season_id", "competition_id", "kpi_id")


def season_state(kpis: DataFrame) -> DataFrame:
    """What a season's values are made of, by ``SEASON_GRAIN``: sum, rows and seconds of each fixture, in a map that is as long
    as a player's season. Rows are shuffled by the grain once, which serves both groupings."""
    of_fixture = kpis.repartition(*SEASON_GRAIN).groupBy(*SEASON_GRAIN, "fixture_id").agg(F.struct(F.sum("kpi_value").alias("total"), F.count("kpi_value").alias("n"), F.sum("play_duration_seconds").alias("seconds")).alias("part"))
    return of_fixture.groupBy(*SEASON_GRAIN).agg(F.map_from_entries(F.collect_list(F.struct("fixture_id", "part"))).alias("fixtures"))


def season_state_changes(state: DataFrame, kpis: DataFrame) -> DataFrame:
    """The rows of ``state`` that change with ``kpis``, all rows of some fixtures: parts of those fixtures replace the ones there
    are, so a fixture that is calculated again counts once. To be upserted on ``SEASON_GRAIN``."""
    same = [F.col(f"s.{c}").eqNullSafe(F.col(f"n.{c}")) for c in SEASON_GRAIN]
    met = season_state(kpis).alias("n").join(state.alias("s"), reduce(lambda a, b: a & b, same), "left")
    new = F.col("n.fixtures")
    kept = F.map_filter("s.fixtures", lambda k, _: ~F.array_contains(F.map_keys(new), k))
    return met.select(*[f"n.{c}" for c in SEASON_GRAIN], F.when(F.col("s.fixtures").isNull(), new).otherwise(F.map_concat(kept, new)).alias("fixtures"))


def season_kpis_of(state: DataFrame) -> DataFrame:
    """``season_kpis`` from the parts that ``state`` holds."""
    parts = F.map_values("fixtures")
    add = lambda c: F.aggregate(F.transform(parts, lambda x: x[c]), F.lit(None).cast(dict(total="double", n="long", seconds="double")[c]), lambda a, x: F.coalesce(a + x, a, x))
    total, n = add("total"), add("n")
    return state.select(*SEASON_GRAIN, total.alias("season_total"), (total / F.nullif(n, F.lit(0))).alias("season_average"), F.size("fixtures").cast("long").alias("matches_played"), add("seconds").alias("total_play_duration_seconds"))


def iteration_player_fact(rows: DataFrame, ids: DataFrame, season: DataFrame) -> DataFrame:
    known = season.select(F.col("season_id").alias("iteration_id"), "competition_id", "season_name")
    return resolved(rows, ids, "source_player_id", "player_id").join(known, "iteration_id").withColumnRenamed("iteration_id", "season_id").withColumn("source_system", F.lit(PROVIDER))


def iteration_squad_fact(rows: DataFrame, season: DataFrame) -> DataFrame:
    known = season.select(F.col("season_id").alias("iteration_id"), "competition_id", "season_name")
    return rows.join(known, "iteration_id").withColumnRenamed("iteration_id", "season_id").withColumn("source_system", F.lit(PROVIDER))


def participation_positions(rows: DataFrame, players: DataFrame, fixtures: DataFrame, season: DataFrame) -> DataFrame:
    known = rows.where("play_duration > 0").withColumnRenamed("player_id", "source_player_id")
    known = resolved(resolved(known, players, "source_player_id", "player_id"), fixtures, "match_id", "fixture_id")
    return spells.by_position(known.withColumnRenamed("iteration_id", "season_id").join(season.select("season_id"), "season_id"))


def players_view(canonical: DataFrame, identities: DataFrame, context: DataFrame, position: DataFrame, app: DataFrame) -> DataFrame:
    """Active players with what is known of them, and behind them the application's own that no identity links."""
    manual = primary_of(identities, MANUAL, "player_id", "manual_id")
    active = canonical.where(F.coalesce("is_active", F.lit(True))).join(primary_of(identities, PROVIDER, "player_id", "external_id"), "player_id", "left").join(manual, "player_id", "left").join(context, "player_id", "left").join(position, "player_id", "left")
    columns = ["player_id", "display_name", "birth_date", "external_id", "manual_id", "squad_id", "squad_name", "season_name", "competition_name", "position_code"]
    base = active.select(*columns, F.when(F.col("external_id").isNotNull(), "external").otherwise("internal").alias("data_source"))
    tail = app.select(F.col("id").cast("string").alias("manual_id"), F.col("name").alias("display_name"), "birth_date").join(identities.where(F.col("source_system") == MANUAL).select(F.col("source_id").alias("manual_id")), "manual_id", "left_anti")
    return base.unionByName(tail.withColumn("data_source", F.lit("internal")), allowMissingColumns=True)


def with_canonical_player(df: DataFrame, ids: DataFrame) -> DataFrame:
    own = ids.where(F.col("source_system") == PROVIDER).select(F.col("source_id").alias("__id"), F.col("player_id").alias("canonical_player_id"))
    return df.join(own, F.col("player_id").cast("string") == F.col("__id"), "left").drop("__id")


def newest_versions(versions: DataFrame) -> DataFrame:
    """The newest version of each fixture in an append-only table, its payload parsed."""
    newest = ranking.first_by(versions, ["fixture_id"], [F.col("loaded_at").desc_nulls_last(), F.col("run_id").desc_nulls_last()])
    v = json_or_null("payload")
    return newest.withColumns({"home_team": at_path(v, "$.home.id", "string"), "away_team": at_path(v, "$.away.id", "string")})


def football(sources: Sources, target: str, include_all: bool = False) -> Plan:
    """All models; ``include_all`` keeps the category that staging leaves out otherwise."""
    plan = Plan(sources, target)

    def staged(name: str, columns: dict):
        def build(df: DataFrame) -> DataFrame:
            pair = {c: c for c in PAIR if c in df.columns}
            out = typed(df, {n: c() if callable(c) else c for n, c in columns.items()} | pair)
            return out if include_all or name not in CATEGORY else out.where(F.col(CATEGORY[name]) == MALE)

        return build

    for name, (source, columns) in STAGING.items():
        plan.model(name, source, tags=("staging",))(staged(name, columns))
    plan.model("stg_fixture_versions", "fixture_versions", grain=("fixture_id",), tags=("staging",))(newest_versions)
    plan.model("stg_participation", "stg_events", "stg_match_info", kept=TABLE, tags=("staging",))(lambda e, m: spells.participation(e.select("match_id", "period_id", "clock"), m))

    dim, fact, compat = ("dimension",), ("fact",), ("compat",)
    plan.model("competitions", "stg_iterations", kept=TABLE, grain=("competition_id",), tags=dim)(competitions)
    plan.model("seasons", "stg_iterations", kept=TABLE, grain=("season_id",), parents=(("competition_id", "competitions", "competition_id"),), tags=dim)(seasons)
    plan.model("dim_squads", "stg_squads", kept=TABLE, grain=("squad_id",), tags=dim)(squads)
    plan.model("player_ids", "player_identities", "player_overrides", kept=TABLE, grain=("source_system", "source_id"), required=("player_id",), tags=dim)(lambda i, o: bridge.resolutions(i, o, ["source_system", "source_id"], "player_id"))
    plan.model("fixture_ids", "fixture_identities", kept=TABLE, grain=("source_system", "source_id"), required=("fixture_id",), tags=dim)(lambda i: bridge.best_identities(i, ["source_system", "source_id"], "fixture_id").select("source_system", "source_id", "fixture_id"))
    plan.model("player_context", "stg_players", "player_ids", "seasons", "competitions", "dim_squads", kept=TABLE, grain=("player_id",), tags=dim)(player_context)
    plan.model("player_recent_position", "stg_events", "player_ids", kept=TABLE, grain=("player_id",), tags=dim)(recent_position)
    plan.model("fixture_details", "canonical_fixtures", "fixture_identities", "stg_matches", "app_fixtures", "seasons", "dim_squads", kept=TABLE, grain=("fixture_id",), tags=dim)(fixture_details)

    plan.model("player_fixture_kpis", "stg_player_kpis", "player_ids", "fixture_ids", "seasons", kept=INCREMENTAL, grain=KPI_GRAIN, cursor=("scheduled_at", 7), slices=lambda: F.date_format("scheduled_at", "yyyy-MM"), tags=fact)(fixture_kpis)
    plan.model("player_season_kpis", "player_fixture_kpis", kept=TABLE, grain=("player_id", "season_id", "competition_id", "kpi_id"), tags=fact)(season_kpis)
    for what in ("kpis", "scores"):
        plan.model(f"player_iteration_{what}", f"stg_iteration_player_{what}", "player_ids", "seasons", kept=TABLE, tags=fact)(iteration_player_fact)
        plan.model(f"squad_iteration_{what}", f"stg_iteration_squad_{what}", "seasons", kept=TABLE, tags=fact)(iteration_squad_fact)
    plan.model("source_participation", "stg_participation", "seasons", kept=TABLE, tags=fact)(lambda p, s: p.where("play_duration > 0").join(s.select(F.col("season_id").alias("iteration_id")), "iteration_id"))
    plan.model("player_position_participation", "stg_participation", "player_ids", "fixture_ids", "seasons", kept=TABLE, grain=("fixture_id", "squad_id", "player_id", "position"), rules=(("some time played", "play_duration > 0"), ("no more than the match", "play_duration <= match_duration")), tags=fact)(participation_positions)
    plan.model("player_fixture_participation", "player_position_participation", kept=TABLE, grain=("player_id", "fixture_id", "squad_id"), rules=(("some time played", "play_duration > 0"), ("no more than the match", "play_duration <= match_duration"), ("share", "match_share > 0 and match_share <= 1")), tags=fact)(spells.by_fixture)
    plan.model("player_season_participation", "player_position_participation", kept=TABLE, grain=("player_id", "season_id"), tags=fact)(spells.by_season)

    plan.model("players_base", "canonical_players", "player_identities", "player_context", "player_recent_position", "app_players", tags=compat)(players_view)
    plan.model("app_players_view", "players_base", tags=compat)(lambda p: p.select("player_id", "display_name", "birth_date", "squad_name", "position_code", "data_source"))
    plan.model("app_matches_view", "fixture_details", tags=compat)(lambda d: d.select(*[F.col(c).alias(c.upper()) for c in d.columns]))
    for name in ("player_notes", "player_information", "player_stage_history"):
        plan.model(f"app_{name}", name, "player_ids", tags=compat)(with_canonical_player)
    for name in PASSED_THROUGH:
        plan.model(f"app_{name}", name, tags=compat)(lambda df: df)

    plan.check("one season value a player and KPI", "player_season_kpis")(lambda k: quality.not_unique(k, ["player_id", "season_id", "kpi_id"]))
    plan.check("events have match info", "stg_events", "stg_match_info")(lambda e, m: quality.orphans(e.select("match_id"), "match_id", m, "match_id").distinct())
    plan.check("KPI players are known", "stg_player_kpis", "player_ids")(unknown_players)
    return plan
