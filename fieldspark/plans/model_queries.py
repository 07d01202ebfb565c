"""Queries of the football models as a whole: raw provider tables made from the driver's tables, the models built over them
as a plan, and what comes out beside its SQL. Customers are players, suppliers squads, nations iterations, orders matches."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldspark.plans.catalogue import query
from fieldspark.plans.models import football
from fieldspark.sources import sinks, tables

text = lambda c: F.col(c).cast("string")
null = lambda kind: F.lit(None).cast(kind)
every = lambda c, n: F.col(c) % n == 0


def _raw(t) -> dict[str, DataFrame]:
    """The provider's and the application's tables."""
    o, c = t.orders, t.customer
    key, who = F.col("o_orderkey"), F.col("c_custkey")
    return {
        "iterations": t.nation.select((F.col("n_nationkey") + 100).alias("id"), F.lit("23/24").alias("season"), F.lit("V2").alias("dataVersion"), F.concat(F.lit("2024-01-"), F.lpad((F.col("n_nationkey") + 1).cast("string"), 2, "0")).alias("lastChangeTimestamp"), F.col("n_regionkey").alias("competition.id"), F.col("n_name").alias("competition.name"), F.lit("cup").alias("competition.type"), F.col("n_nationkey").alias("competition.countryId"), F.when(every("n_nationkey", 5), "FEMALE").otherwise("MALE").alias("competition.gender")),
        "squads": t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("countryId"), F.lit("club").alias("type"), F.when(every("s_suppkey", 7), "FEMALE").otherwise("MALE").alias("gender"), null("string").alias("imageUrl"), (F.col("s_nationkey") + 100).alias("iterationId")),
        "matches": o.select(key.alias("id"), (F.col("o_custkey") % 25 + 100).alias("iterationId"), (F.col("o_custkey") % 40).alias("homeSquadId"), (F.col("o_custkey") * 7 % 40).alias("awaySquadId"), F.when(every("o_orderkey", 9), "bad").otherwise(text("o_orderdate")).alias("scheduledDate"), F.lit(True).alias("available"), (key % 38).cast("int").alias("matchDay.index"), F.lit("day").alias("matchDay.name")),
        "fixture_identities": o.select(key.alias("identity_id"), F.when(every("o_orderkey", 3), "MANUAL").otherwise("A").alias("source_system"), text("o_orderkey").alias("source_id"), (key + 5000000).alias("fixture_id"), F.lit(True).alias("is_primary"), F.lit(1).alias("confidence"), F.col("o_orderdate").alias("updated_at")),
        "canonical_fixtures": o.select((key + 5000000).alias("fixture_id"), F.to_date("o_orderdate").alias("fixture_date")),
        "app_fixtures": o.where(every("o_orderkey", 3)).select(key.alias("id"), F.lit("Home").alias("home_name"), F.col("o_orderpriority").alias("away_name"), null("timestamp_ntz").alias("scheduled_at")),
        "players": c.select(who.alias("id"), F.lit("f").alias("firstname"), F.lit("l").alias("lastname"), F.col("c_name").alias("commonname"), F.when(every("c_custkey", 9), "bad").otherwise("2000-01-02").alias("birthdate"), F.lit("L").alias("leg"), F.when(every("c_custkey", 6), "FEMALE").otherwise("MALE").alias("gender"), F.when(every("c_custkey", 8), F.lit(float("nan"))).otherwise((who % 40).cast("double")).alias("currentSquadId"), (F.col("c_nationkey") + 100).alias("iterationId")),
        "player_identities": c.where("c_custkey % 4 <> 0").select(who.alias("identity_id"), F.lit("A").alias("source_system"), text("c_custkey").alias("source_id"), (who + 1000).alias("player_id"), F.lit(True).alias("is_primary"), F.lit(1).alias("confidence"), null("timestamp_ntz").alias("updated_at"))
        .unionByName(c.where(every("c_custkey", 5)).select((who + 900000).alias("identity_id"), F.lit("MANUAL").alias("source_system"), F.concat(F.lit("m"), text("c_custkey")).alias("source_id"), (who + 1000).alias("player_id"), F.lit(True).alias("is_primary"), F.lit(1).alias("confidence"), null("timestamp_ntz").alias("updated_at"))),
        "player_overrides": c.where(every("c_custkey", 50)).select(F.lit("A").alias("source_system"), text("c_custkey").alias("source_id"), (who + 2000).alias("player_id")),
        "canonical_players": c.select((who + 1000).alias("player_id"), F.col("c_name").alias("display_name"), null("date").alias("birth_date"), (who % 11 != 0).alias("is_active")),
        "app_players": c.where("c_custkey % 10 in (0, 1)").select(F.concat(F.lit("m"), text("c_custkey")).alias("id"), F.col("c_name").alias("name"), null("date").alias("birth_date")),
        "events": t.events.select((F.col("event_id") % 50).alias("matchId"), F.lit(101).cast("long").alias("iterationId"), F.col("event_id").alias("id"), F.col("event_id").alias("index"), F.lit(1).cast("long").alias("periodId"), F.col("value").alias("gameTimeInSec"), F.col("user_id").alias("playerId"), F.when(F.col("event_type") != "error", F.col("event_type")).alias("position")),
        "player_kpis": t.lineitem.select(F.col("l_suppkey").alias("playerId"), F.col("l_orderkey").alias("matchId"), (F.col("l_orderkey") % 25 + 100).alias("iterationId"), text("l_shipdate").alias("scheduledDate"), F.col("l_suppkey").alias("squadId"), F.lit("squadHome").alias("side"), F.lit("CB").alias("position"), F.col("l_linenumber").cast("long").alias("kpiId"), F.col("l_quantity").cast("double").alias("value"), F.lit(60.0).alias("playDuration"), F.lit(0.5).alias("matchShare")),
        "player_notes": c.select(who.alias("player_id"), F.lit("note").alias("note")),
        "users": c.select(who.alias("id"), F.col("c_name").alias("name")),
        "iteration_player_scores": t.lineitem.select(F.col("l_suppkey").alias("playerId"), (F.col("l_orderkey") % 30 + 100).alias("iterationId"), F.col("l_suppkey").alias("squadId"), F.lit("CB").alias("position"), F.col("l_linenumber").cast("long").alias("scoreId"), F.col("l_quantity").cast("double").alias("value")),
    }


def _built(t, name: str, *sources: str, include_all: bool = False) -> DataFrame:
    """The model ``name`` after a build of what it needs, over the raw tables it needs."""
    base = f"{sinks.shared_dir(t.spark)}/football-{uuid.uuid4().hex}"
    raw = _raw(t)
    for s in sources:
        raw[s].write.parquet(f"{base}/raw/{s}.parquet")
    return football(tables.Sources(f"{base}/raw"), f"{base}/models", include_all).build(t.spark, [name])[name]


_SEASONS = "with seasons as (select n_nationkey + 100 as season_id, n_regionkey as competition_id, n_name as competition_name from nation where n_nationkey % 5 <> 0),\nsquads as (select s_suppkey as squad_id, s_name as squad_name from supplier where s_suppkey % 7 <> 0),\nids as (select c_custkey as source_id, case when c_custkey % 50 = 0 then c_custkey + 2000 else c_custkey + 1000 end as player_id from customer where c_custkey % 4 <> 0 or c_custkey % 50 = 0)\n"


@query("select n_regionkey as competition_id, n_name as competition_name, 'cup' as competition_type, n_nationkey as competition_country_id, 'MALE' as competition_gender from nation where n_nationkey % 5 <> 0 qualify row_number() over (partition by n_regionkey order by n_nationkey desc) = 1")
def model_competitions(t):
    return _built(t, "competitions", "iterations")


@query("select n_nationkey + 100 as season_id, n_regionkey as competition_id, case when n_nationkey % 5 = 0 then 'FEMALE' else 'MALE' end as competition_gender from nation")
def model_seasons_of_all(t):
    """With the category that staging leaves out otherwise."""
    return _built(t, "seasons", "iterations", include_all=True).select("season_id", "competition_id", "competition_gender")


@query(_SEASONS + """select o_orderkey + 5000000 as "FIXTURE_ID", case when o_orderkey % 3 <> 0 then o_orderkey::varchar end as "EXTERNAL_ID", case when o_orderkey % 3 = 0 then o_orderkey::varchar end as "MANUAL_ID",
case when o_orderkey % 3 <> 0 and o_orderkey % 9 <> 0 then o_orderdate else o_orderdate::date::timestamp end as "SCHEDULED_AT", case when o_orderkey % 3 = 0 then 'Home' else h.squad_name end as "HOME_SQUAD_NAME", case when o_orderkey % 3 = 0 then o_orderpriority else a.squad_name end as "AWAY_SQUAD_NAME",
case when o_orderkey % 3 = 0 then 'Home vs ' || o_orderpriority else h.squad_name || ' vs ' || a.squad_name end as "FIXTURE_NAME", s.competition_name as "COMPETITION_NAME", case when o_orderkey % 3 <> 0 then 'external' else 'internal' end as "DATA_SOURCE"
from orders left join squads h on h.squad_id = o_custkey % 40 and o_orderkey % 3 <> 0 left join squads a on a.squad_id = o_custkey * 7 % 40 and o_orderkey % 3 <> 0 left join seasons s on s.season_id = o_custkey % 25 + 100 and o_orderkey % 3 <> 0""")
def model_matches_view(t):
    built = _built(t, "app_matches_view", "iterations", "squads", "matches", "fixture_identities", "canonical_fixtures", "app_fixtures")
    return built.select("FIXTURE_ID", "EXTERNAL_ID", "MANUAL_ID", "SCHEDULED_AT", "HOME_SQUAD_NAME", "AWAY_SQUAD_NAME", "FIXTURE_NAME", "COMPETITION_NAME", "DATA_SOURCE")


@query(_SEASONS + """select i.player_id, c_nationkey + 100 as season_id, case when c_custkey % 8 <> 0 then c_custkey % 40 end as squad_id, q.squad_name, s.competition_id, k.competition_name from customer join ids i on i.source_id = c_custkey
left join seasons s on s.season_id = c_nationkey + 100 left join squads q on q.squad_id = case when c_custkey % 8 <> 0 then c_custkey % 40 end
left join (select competition_id, competition_name from seasons qualify row_number() over (partition by competition_id order by season_id desc) = 1) k on k.competition_id = s.competition_id where c_custkey % 6 <> 0""")
def model_player_context(t):
    return _built(t, "player_context", "players", "player_identities", "player_overrides", "iterations", "squads").select("player_id", "season_id", "squad_id", "squad_name", "competition_id", "competition_name")


@query("""with p as (select c_custkey + 1000 as player_id, c_name as display_name, case when c_custkey % 4 <> 0 then c_custkey::varchar end as external_id, case when c_custkey % 5 = 0 then 'm' || c_custkey end as manual_id from customer where c_custkey % 11 <> 0)
select player_id, display_name, external_id, manual_id, case when external_id is not null then 'external' else 'internal' end as data_source from p
union all select null, c_name, null, 'm' || c_custkey, 'internal' from customer where c_custkey % 10 = 1""")
def model_players_base(t):
    built = _built(t, "players_base", "players", "player_identities", "player_overrides", "iterations", "squads", "events", "canonical_players", "app_players")
    return built.select("player_id", "display_name", "external_id", "manual_id", "data_source")


@query(_SEASONS + """select player_id, l_orderkey % 25 + 100 as season_id, s.competition_id, l_linenumber::bigint as kpi_id, sum(l_quantity::decimal(18,2))::double as season_total, count(distinct l_orderkey) as matches_played, count(*) * 60.0::double as total_play_duration_seconds
from lineitem join ids on source_id = l_suppkey join orders on o_orderkey = l_orderkey and o_orderkey % 3 <> 0 left join seasons s on s.season_id = l_orderkey % 25 + 100 group by all""")
def model_season_kpis(t):
    """Over fixtures and seasons; the grain of the fixture fact isn't tested here, since line items repeat it."""
    base = f"{sinks.shared_dir(t.spark)}/football-{uuid.uuid4().hex}"
    raw = _raw(t)
    for s in ("player_kpis", "player_identities", "player_overrides", "fixture_identities", "iterations"):
        raw[s].write.parquet(f"{base}/raw/{s}.parquet")
    built = football(tables.Sources(f"{base}/raw"), f"{base}/models").build(t.spark, ["player_season_kpis"], test=False)["player_season_kpis"]
    return built.select("player_id", "season_id", "competition_id", "kpi_id", F.round("season_total", 2).alias("season_total"), "matches_played", "total_play_duration_seconds")


@query(_SEASONS + "select player_id, l_orderkey % 30 + 100 as season_id, s.competition_id, l_linenumber::bigint as score_id, l_quantity::double as score_value, 'A' as source_system from lineitem join ids on source_id = l_suppkey join seasons s on s.season_id = l_orderkey % 30 + 100")
def model_player_scores(t):
    return _built(t, "player_iteration_scores", "iteration_player_scores", "player_identities", "player_overrides", "iterations").select("player_id", "season_id", "competition_id", "score_id", "score_value", "source_system")


@query("select c_custkey as player_id, 'note' as note, case when c_custkey % 50 = 0 then c_custkey + 2000 when c_custkey % 4 <> 0 then c_custkey + 1000 end as canonical_player_id from customer")
def model_player_notes(t):
    return _built(t, "app_player_notes", "player_notes", "player_identities", "player_overrides")


@query("select c_custkey as id, c_name as name from customer")
def model_users_view(t):
    return _built(t, "app_users", "users")


@query("select i.player_id, e.event_type as position_code from events e join (select c_custkey as source_id, case when c_custkey % 50 = 0 then c_custkey + 2000 else c_custkey + 1000 end as player_id from customer where c_custkey % 4 <> 0 or c_custkey % 50 = 0) i on i.source_id = e.user_id where event_type <> 'error' qualify row_number() over (partition by player_id order by event_id % 50 desc, event_id desc) = 1")
def model_recent_position(t):
    return _built(t, "player_recent_position", "events", "player_identities", "player_overrides").select("player_id", "position_code")
