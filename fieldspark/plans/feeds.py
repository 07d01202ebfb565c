"""Queries of the feeds, queues, identities, models and write modes over the driver's tables, and their SQL. Payloads are
made from the tables as JSON text, and read by the functions that read the providers'."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldspark.functions import scalars
from fieldspark.operators import bridge, discovery, flatten, identity, merge, quality, queue, ranking, stages
from fieldspark.plans import models, registry
from fieldspark.plans.catalogue import _MERGE, _NOW, _QUEUE, _changes, _now, _queue, _target, query
from fieldspark.sources import payloads, rest, sinks, tables
from fieldspark.streaming import upserts

J = F.to_json
none = lambda kind: F.lit(None).cast(kind)


def _lists(df: DataFrame, keys: list[str], item, name: str = "payload") -> DataFrame:
    """Items of each key as one JSON array, in the order of their fields."""
    return df.groupBy(*keys).agg(J(F.sort_array(F.collect_list(item))).alias(name))


# payloads


@query("""select user_id as match_id, event_id, event_id % 100 as event_index, event_id % 7 as sequence_index, 1::bigint as period_id, hour(ts)::varchar as game_time, (hour(ts) * 60 + minute(ts))::double as clock, user_id % 20 as squad_id, user_id % 2 as current_attacking_squad_id,
case when event_id % 3 <> 0 then user_id end as player_id, case when event_id % 3 <> 0 then 'CB' end as player_position, upper(event_type) as action_type, event_type as action, value as pressure, event_id % 11 as opponents, case when event_type = 'purchase' then 'CORNER' end as inferred_set_piece,
case when event_type = 'click' then event_id end as pass_receiver, case when event_type = 'purchase' then event_id % 5 end as set_piece_id, event_id % 13 as opponent_x, 77::bigint as ingestion_run_id from events""")
def event_flatten(t):
    e = t.events
    when = lambda kind, *fields: F.when(F.col("event_type") == kind, F.struct(*fields))
    event = F.struct(
        F.col("event_id").alias("id"), (F.col("event_id") % 100).alias("index"), (F.col("event_id") % 7).alias("sequenceIndex"), F.lit(1).alias("periodId"), F.struct(F.hour("ts").cast("string").alias("gameTime"), (F.hour("ts") * 60 + F.minute("ts")).cast("double").alias("gameTimeInSec")).alias("gameTime"),
        (F.col("user_id") % 20).alias("squadId"), (F.col("user_id") % 2).alias("currentAttackingSquadId"), F.when(F.col("event_id") % 3 != 0, F.struct(F.col("user_id").alias("id"), F.lit("CB").alias("position"))).alias("player"), F.upper("event_type").alias("actionType"), F.col("event_type").alias("action"),
        F.col("value").alias("pressure"), (F.col("event_id") % 11).alias("opponents"), F.when(F.col("event_type") == "purchase", "CORNER").alias("inferredSetPiece"), when("click", F.col("event_id").alias("receiver")).alias("pass"), when("purchase", (F.col("event_id") % 5).alias("id")).alias("setPiece"),
        F.struct((F.col("event_id") % 13).alias("x")).alias("opponent"),
    )
    rows = payloads.event_rows(e.select(F.col("user_id").alias("match_id"), J(event).alias("payload")), run_id=77)
    at = lambda v, path: F.try_variant_get(v, path, "bigint")
    return rows.select(
        "match_id", "event_id", "event_index", "sequence_index", "period_id", "game_time", "clock", "squad_id", "current_attacking_squad_id", "player_id", "player_position", "action_type", "action", "pressure", "opponents", "inferred_set_piece",
        at("pass_detail", "$.receiver").alias("pass_receiver"), at("set_piece_detail", "$.id").alias("set_piece_id"), at("opponent_detail", "$.x").alias("opponent_x"), "ingestion_run_id",
    )


@query("""select l_orderkey as iteration_id, l_suppkey as player_id, l_linenumber::bigint as player_score_id, l_quantity::double as value, l_returnflag as position from lineitem where l_linestatus = 'O'""")
def player_scores(t):
    scores = F.when(F.col("l_linestatus") == "O", F.array(F.struct(F.col("l_linenumber").alias("playerScoreId"), F.col("l_quantity").cast("double").alias("value"))))
    raw = _lists(t.lineitem, ["l_orderkey"], F.struct(F.col("l_suppkey").alias("playerId"), F.col("l_returnflag").alias("position"), scores.alias("playerScores")))
    return payloads.player_score_rows(raw.withColumnRenamed("l_orderkey", "iteration_id")).select("iteration_id", "player_id", "player_score_id", "value", "position")


@query("select o_custkey as iteration_id, o_orderkey as squad_id, 1::bigint as squad_score_id, o_totalprice::double as value from orders union all select o_custkey, o_orderkey, 2, 0.5 from orders where o_orderstatus = 'F'")
def squad_scores(t):
    score = lambda n, v: F.struct(F.lit(n).alias("squadScoreId"), v.cast("double").alias("value"))
    one, two = score(1, F.col("o_totalprice")), score(2, F.lit(0.5))
    scores = F.when(F.col("o_orderstatus") == "F", F.array(one, two)).otherwise(F.array(one))
    raw = _lists(t.orders, ["o_custkey"], F.struct(F.col("o_orderkey").alias("squadId"), scores.alias("squadScores")))
    return payloads.squad_score_rows(raw.withColumnRenamed("o_custkey", "iteration_id"))


_SIDES = "with c as (select c_custkey as id, c_nationkey as match_id, c_mktsegment as position from customer), k as (select o_custkey as id, o_orderkey as kpi, o_totalprice::double as v from orders)\n"


def _kpi_payload(t):
    kpi = F.struct(F.col("o_orderkey").alias("kpiId"), F.col("o_totalprice").cast("double").alias("value"))
    players = t.customer.join(t.orders.groupBy("o_custkey").agg(F.collect_list(kpi).alias("kpis")), F.col("o_custkey") == F.col("c_custkey"), "left")
    one = F.struct(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("position"), "kpis")
    home = players.groupBy(F.col("c_nationkey").alias("match_id")).agg(F.collect_list(F.when(F.pmod("c_custkey", F.lit(2)) == 0, one)).alias("h"), F.collect_list(F.when(F.pmod("c_custkey", F.lit(2)) == 1, one)).alias("a"))
    side = lambda n, c: F.struct(F.lit(n).alias("id"), F.col(c).alias("players"), F.array(F.struct(F.size(c).alias("kpiId"), F.lit(1.5).alias("value"))).alias("kpis"))
    return home.select("match_id", J(F.struct(side(10, "h").alias("squadHome"), side(20, "a").alias("squadAway"))).alias("payload"))


@query(_SIDES + "select match_id, case when c.id % 2 = 0 then 'squadHome' else 'squadAway' end as side, case when c.id % 2 = 0 then 10 else 20 end::bigint as squad_id, c.id as player_id, position, kpi as kpi_id, v as value from c left join k using (id)")
def player_kpis_outer(t):
    return payloads.player_kpi_rows(_kpi_payload(t)).select("match_id", "side", "squad_id", "player_id", "position", "kpi_id", "value")


@query(_SIDES + "select match_id, 'squadHome' as side, 10::bigint as squad_id, count_if(id % 2 = 0)::bigint as kpi_id, 1.5::double as value from c group by 1 union all select match_id, 'squadAway', 20, count_if(id % 2 = 1), 1.5 from c group by 1")
def squad_kpis_inner(t):
    return payloads.squad_kpi_rows(_kpi_payload(t))


@query("select o_custkey as match_id, o_orderkey as set_piece_id, o_orderpriority as category, l_linenumber::bigint as sub_phase_id, l_quantity::double as weight, l_returnflag = 'R' as first_touch_won from orders join lineitem on l_orderkey = o_orderkey")
def set_piece_phases(t):
    sub = F.struct(F.col("l_linenumber").alias("id"), (F.col("l_returnflag") == "R").alias("firstTouchWon"), F.create_map(F.lit("weight"), F.col("l_quantity").cast("double")).alias("aggregates"))
    phases = t.lineitem.groupBy("l_orderkey").agg(F.collect_list(sub).alias("setPieceSubPhase"))
    pieces = t.orders.join(phases, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    item = F.struct(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("matchId"), F.col("o_orderpriority").alias("setPieceCategory"), "setPieceSubPhase")
    rows = payloads.set_piece_rows(pieces.groupBy("o_custkey").agg(J(F.collect_list(item)).alias("payload")))
    return rows.select(F.col("matchId").alias("match_id"), "set_piece_id", F.col("setPieceCategory").alias("category"), "sub_phase_id", F.try_element_at("aggregates", F.lit("weight")).alias("weight"), F.col("firstTouchWon").alias("first_touch_won"))


@query("""select c_custkey as match_id, case when c_custkey % 4 = 0 then 5 else c_nationkey end::bigint as iteration_id, c_custkey % 10 as home_squad_id, coalesce(n, 0)::int as home_starters, 0 as away_starters, coalesce(n, 0)::int as home_changes
from customer left join (select o_custkey, count(*) as n from orders group by 1) on o_custkey = c_custkey""")
def match_lineups(t):
    start = F.struct(F.col("o_orderkey").alias("playerId"), F.lit("CB").alias("position"), F.lit("LEFT").alias("positionSide"))
    change = F.struct(F.col("o_orderkey").alias("playerId"), F.struct(F.lit(60.0).alias("gameTimeInSec")).alias("gameTime"), F.lit("LB").alias("toPosition"))
    lists = t.orders.groupBy("o_custkey").agg(F.collect_list(start).alias("startingPositions"), F.collect_list(change).alias("substitutions"))
    rows = t.customer.join(lists, F.col("o_custkey") == F.col("c_custkey"), "left")
    payload = F.struct(F.when(F.col("c_custkey") % 4 == 0, 5).alias("iterationId"), F.struct((F.col("c_custkey") % 10).alias("id"), "startingPositions", "substitutions").alias("squadHome"), F.struct(F.lit(1).alias("id")).alias("squadAway"))
    info = payloads.match_info_rows(rows.select(F.col("c_custkey").alias("match_id"), F.col("c_nationkey").cast("long").alias("iteration_id"), J(payload).alias("payload")))
    return info.select("match_id", "iteration_id", "home_squad_id", F.size("home_starting").alias("home_starters"), F.size("away_starting").alias("away_starters"), F.size("home_changes").alias("home_changes"))


@query("select o_custkey as iteration_id, o_orderdate::date as rating_date, o_orderkey as squad_id, o_totalprice::double as rating, o_orderpriority as more from orders")
def ratings(t):
    rating = F.create_map(F.lit("squadId"), F.col("o_orderkey").cast("string"), F.lit("value"), F.col("o_totalprice").cast("double").cast("string"), F.lit("rank"), F.col("o_orderpriority"))
    dates = t.orders.groupBy("o_custkey", F.to_date("o_orderdate").cast("string").alias("date")).agg(F.collect_list(rating).alias("squadRatings"))
    raw = dates.groupBy(F.col("o_custkey").alias("iteration_id")).agg(J(F.collect_list(F.struct("date", "squadRatings"))).alias("payload"))
    return payloads.rating_rows(raw).select("iteration_id", "rating_date", "squad_id", "rating", F.try_element_at("more", F.lit("rank")).alias("more"))


@query("select o_custkey as match_id, o_orderkey as home_squad_id, o_orderdate as scheduled_at from orders qualify row_number() over (partition by o_custkey order by o_orderkey) = 1")
def match_index(t):
    item = F.struct(F.col("o_custkey").alias("id"), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("scheduledDate"), F.col("o_orderkey").alias("homeSquadId"))
    raw = t.orders.select("o_orderkey", J(F.array(item)).alias("payload"))
    return payloads.match_index_rows(raw, "o_orderkey").select("match_id", "home_squad_id", "scheduled_at")


@query("select o_custkey as match_id, o_orderkey as home_squad_id from (select *, row_number() over (partition by o_custkey order by o_orderkey) as rn from orders) where rn = 1 order by o_orderkey limit 20")
def match_index_capped(t):
    item = F.struct(F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("homeSquadId"))
    return payloads.match_index_rows(t.orders.select("o_orderkey", J(F.array(item)).alias("payload")), "o_orderkey", most=20).select("match_id", "home_squad_id")


@query("select c_custkey::varchar as fixture_id, o_orderkey::varchar as asset_id, o_orderstatus as asset_subtype, o_custkey as size from customer left join orders on o_custkey = c_custkey")
def fixture_assets(t):
    asset = F.struct(F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderstatus").alias("subType"), F.col("o_custkey").alias("size"))
    lists = t.orders.groupBy("o_custkey").agg(F.collect_list(asset).alias("assets"))
    raw = t.customer.join(lists, F.col("o_custkey") == F.col("c_custkey"), "left").select(J(F.struct(F.col("c_custkey").cast("string").alias("fixtureId"), "assets")).alias("payload"))
    return payloads.asset_rows(raw).select("fixture_id", "asset_id", "asset_subtype", "size")


# consumer queries


@query("select user_id as match_id, event_id, user_id % 50 as player_id, value from events where event_type = 'purchase'")
def own_shot_value(t):
    """What a shot is worth to its own player, from the array of all players' values."""
    kpi = lambda p, v: F.struct(p.alias("playerId"), v.alias("SHOT_XG"))
    e = t.events.where("event_type = 'purchase'").select(F.col("user_id").alias("match_id"), "event_id", (F.col("user_id") % 50).alias("player_id"), F.parse_json(J(F.array(kpi(F.col("user_id") % 50, F.col("value")), kpi(F.lit(-1), F.lit(9.0))))).alias("event_kpis"))
    return payloads.own_values(e, "SHOT_XG")


@query("select user_id as match_id, count(*) as shots, sum(value::decimal(18,2))::double as total from events where event_type = 'purchase' group by all")
def shots_per_match(t):
    own = own_shot_value(t)
    return own.groupBy("match_id").agg(F.count(F.lit(1)).alias("shots"), F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total"))


@query("select c_nationkey % 5 as competition, c_nationkey as edition, count(distinct o_orderkey) as matches from customer join orders on o_custkey = c_custkey group by all order by competition, edition")
def available_editions(t):
    rows = t.customer.join(t.orders, F.col("o_custkey") == F.col("c_custkey")).select((F.col("c_nationkey") % 5).alias("competition"), F.col("c_nationkey").alias("edition"), "o_orderkey")
    return stages.editions(rows, ["competition", "edition"], "o_orderkey").orderBy("competition", "edition")


@query("select l_orderkey, min(l_linestatus) as any_status, count(distinct l_suppkey) as suppliers from lineitem group by all having count(distinct l_linestatus) = 1")
def any_value_of_one(t):
    return t.lineitem.groupBy("l_orderkey").agg(F.any_value("l_linestatus").alias("any_status"), F.count_distinct("l_suppkey").alias("suppliers"), F.count_distinct("l_linestatus").alias("n")).where("n = 1").drop("n")


@query("select event_id, ts from events where event_type = 'click' order by ts desc, event_id desc limit 1")
def latest_payload(t):
    return t.events.where("event_type = 'click'").orderBy(F.desc("ts"), F.desc("event_id")).limit(1).select("event_id", "ts")


@query("select o_custkey, o_orderkey from orders order by o_custkey, o_orderkey limit 15")
def first_in_order(t):
    return t.orders.orderBy("o_custkey", "o_orderkey").limit(15).select("o_custkey", "o_orderkey")


# plans of a backfill

_BLOCKS = {"new": ["95/96", "96/97"], "old": ["1994", "1993", "1992"]}
_GROUPS = {"first": [1, 3, 5], "second": [2, 4, 6, 8], "third": [10, 12]}
_ITERATIONS = "with i as (select o_orderkey as iteration_id, case when year(o_orderdate) >= 1995 then right(year(o_orderdate)::varchar, 2) || '/' || right((year(o_orderdate) + 1)::varchar, 2) else year(o_orderdate)::varchar end as season, nullif(c_nationkey, 0) as country_id, o_custkey as matches, o_orderkey % 9 as todo from orders left join customer on c_custkey = o_custkey)\n"


def _iterations(t):
    y = F.year("o_orderdate")
    season = F.when(y >= 1995, F.concat(F.right(y.cast("string"), F.lit(2)), F.lit("/"), F.right((y + 1).cast("string"), F.lit(2)))).otherwise(y.cast("string"))
    o = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left")
    return o.select(F.col("o_orderkey").alias("iteration_id"), season.alias("season"), F.nullif("c_nationkey", F.lit(0)).cast("long").alias("country_id"), F.col("o_custkey").alias("matches"), (F.col("o_orderkey") % 9).alias("todo"))


@query(_ITERATIONS + """, b(season, block_place, block) as (values ('95/96', 0, 'new'), ('96/97', 0, 'new'), ('1994', 1, 'old'), ('1993', 1, 'old'), ('1992', 1, 'old')),
g(country_id, p, g) as (values (1, 0, 'first'), (3, 0, 'first'), (5, 0, 'first'), (2, 1, 'second'), (4, 1, 'second'), (6, 1, 'second'), (8, 1, 'second'), (10, 2, 'third'), (12, 2, 'third'))
select block_place, block, coalesce(p, 3) as group_place, coalesce(g, 'Other (unmapped country)') as "group", string_agg(iteration_id::varchar, ',' order by iteration_id) as ids, sum(matches)::bigint as matches, sum(todo)::bigint as todo
from i join b using (season) left join g using (country_id) group by all""")
def backfill_cells(t):
    return stages.cells(_iterations(t), _BLOCKS, _GROUPS).withColumn("ids", F.array_join("iteration_ids", ",")).drop("iteration_ids")


@query(_ITERATIONS + """select iteration_id, coalesce(country_id, case when iteration_id % 2 = 0 then 99 end)::bigint as country_id from i""")
def filled_countries(t):
    newer = t.orders.where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("id"), F.lit(99).cast("long").alias("country_id"))
    return stages.with_countries(_iterations(t), newer).select("iteration_id", "country_id")


@query(_ITERATIONS + """, k as (select distinct season, case when season like '%/%' then 2000 + left(season, 2)::int else season::int end as key from i) select season from k order by key desc, season desc limit 3""")
def newest_three_seasons(t):
    return stages.newest_seasons(_iterations(t), "season", 3)


@query(_ITERATIONS + "select season, iteration_id, case when season like '%/%' then 2000 + left(season, 2)::int else season::int end::int as begins from i where season in ('96/97', '1994')")
def season_rules(t):
    return _iterations(t).where(F.col("season").isin("96/97", "1994")).select("season", "iteration_id", scalars.season_year(F.col("season")).alias("begins"))


@query(_QUEUE + "select stage, count_if(status = 'PENDING')::bigint as pending, count_if(status = 'SUCCESS')::bigint as loaded, max(completed_at) as last_completed from q group by all having max(completed_at) > timestamp '1995-01-01 00:00:00'")
def stages_completed_since(t):
    counts = _queue(t).groupBy("stage").agg(F.count_if(F.col("status") == queue.PENDING).alias("pending"), F.count_if(F.col("status") == queue.SUCCESS).alias("loaded"), F.max("completed_at").alias("completed_at"))
    return stages.completed_since(counts, F.expr("timestamp_ntz '1995-01-01 00:00:00'")).withColumnRenamed("completed_at", "last_completed")


@query("select o_orderstatus, ceil(count(*) / 7.0)::bigint as share from orders group by all")
def worker_share(t):
    return t.orders.groupBy("o_orderstatus").agg(stages.share_of(F.count(F.lit(1)), 7).alias("share"))


@query("""select o_orderstatus as block, (row_number() over (partition by o_orderstatus order by o_orderpriority) - 1)::int as stage_place, o_orderpriority as "group",
array_to_string(list_sort(list(distinct o_custkey % 25 + 100)), ',') as ids, count(*) as matches, count(*) filter (o_orderkey % 3 = 0) as todo from orders where o_orderstatus in ('F', 'O') group by o_orderstatus, o_orderpriority""")
def plan_file(t):
    """A plan made of the orders, a block a status and a stage a priority, written as a JSON file, read again, and limited to two
    blocks."""
    path = f"{sinks.shared_dir(t.spark)}/plan-{uuid.uuid4().hex}"
    ids = F.array_sort(F.collect_set(F.col("o_custkey") % 25 + 100)).alias("iteration_ids")
    stage = t.orders.groupBy("o_orderstatus", F.col("o_orderpriority").alias("group")).agg(ids, F.count(F.lit(1)).alias("matches"), F.count_if(F.col("o_orderkey") % 3 == 0).alias("todo"))
    block = stage.groupBy(F.col("o_orderstatus").alias("label")).agg(F.array(F.lit("95/96")).alias("seasons"), F.array_sort(F.collect_list(F.struct("group", "iteration_ids", "matches", "todo"))).alias("stages"))
    block.agg(F.lit("p").alias("name"), F.array_sort(F.collect_list(F.struct("label", "seasons", "stages"))).alias("blocks")).coalesce(1).write.json(path)
    return stages.selected(stages.read_plan(t.spark, path), ["F", "O"]).select("block", "stage_place", "group", F.array_join("iteration_ids", ",").alias("ids"), "matches", "todo")


@query("""with recursive e as (select distinct c_nationkey as a, 1000 + o_orderkey % 50 as b from customer join orders on o_custkey = c_custkey where o_totalprice > 480000), u as (select a, b from e union select b, a from e),
r(node) as (select 1 union select u.b from r join u on u.a = r.node) select node::bigint as node from r""")
def bfs_fixpoint(t):
    edges = t.customer.join(t.orders.where("o_totalprice > 480000"), F.col("o_custkey") == F.col("c_custkey")).select(F.col("c_nationkey").cast("long").alias("a"), (1000 + F.col("o_orderkey") % 50).cast("long").alias("b")).distinct()
    return discovery.reachable(edges, t.spark.createDataFrame([(1,)], "node long")).select("node")


@query("select o_orderkey, o_custkey from orders where o_custkey not in (select c_custkey from customer where c_acctbal > 0) or o_orderstatus = 'P'")
def skip_done(t):
    done = t.customer.where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    return merge.not_done(t.orders.select("o_orderkey", "o_custkey", "o_orderstatus"), done, ["o_custkey"], F.col("o_orderstatus") == "P").drop("o_orderstatus")


# merges and queue


@query("""with old as (select l_orderkey, l_linenumber, l_quantity::double as q from lineitem), new as (select l_orderkey, l_linenumber, q + 1 as q from old where l_orderkey % 5 = 0 union all select l_orderkey + 10000000, l_linenumber, q from old where l_orderkey % 5 = 0)
select * from old where not exists (select 1 from new where new.l_orderkey = old.l_orderkey and new.l_linenumber = old.l_linenumber) union all select * from new""")
def upsert_composite(t):
    old = t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("double").alias("q"))
    part = old.where("l_orderkey % 5 = 0")
    return merge.upsert(old, part.withColumn("q", F.col("q") + 1).unionByName(part.withColumn("l_orderkey", F.col("l_orderkey") + 10000000)), ["l_orderkey", "l_linenumber"])


@query(_MERGE + "select o_orderkey, old.o_custkey, case when new.o_orderkey is not null and old.o_custkey not in (select c_custkey from customer where c_acctbal > 5000) then new.o_totalprice else old.o_totalprice end as o_totalprice, old.o_orderstatus from old left join new using (o_orderkey)")
def update_not_exists(t):
    guard = t.customer.where("c_acctbal > 5000").select(F.col("c_custkey").alias("o_custkey"))
    return merge.update_guarded(_target(t), _changes(t), ["o_orderkey"], ["o_totalprice"], guard, ["o_custkey"])


@query(_MERGE + "select o_orderkey, old.o_custkey, case when new.o_orderkey is not null and old.o_orderstatus = 'O' and new.o_totalprice > 100000 then new.o_totalprice else old.o_totalprice end as o_totalprice, old.o_orderstatus from old left join new using (o_orderkey)")
def update_conditional(t):
    return merge.update_if(_target(t), _changes(t), ["o_orderkey"], ["o_totalprice"], (F.col("old.o_orderstatus") == "O") & (F.col("new.o_totalprice") > 100000))


@query("""with newest as (select o_custkey, o_orderpriority from orders qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1)
select c_custkey, coalesce(o_orderpriority, c_name) as c_name from customer left join newest on o_custkey = c_custkey""")
def names_from_newest(t):
    newest = ranking.first_by(t.orders, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")]).select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderpriority").alias("c_name"))
    return merge.update_only(t.customer.select("c_custkey", "c_name"), newest, ["c_custkey"], ["c_name"], prefer_new=True)


_RESULTS = "r as (select o_orderkey as match_id, case when o_orderkey % 3 = 0 then 'FAILED' when o_orderkey % 3 = 1 then 'SUCCESS' else 'NO_EVENT_DATA' end as outcome, o_custkey as event_count, repeat('e', 5000) as error from orders where o_orderkey % 4 = 1)"


def _results(t):
    n = F.col("o_orderkey") % 3
    return t.orders.where("o_orderkey % 4 = 1").select(F.col("o_orderkey").alias("match_id"), F.when(n == 0, queue.FAILED).when(n == 1, queue.SUCCESS).otherwise(queue.NO_DATA).alias("outcome"), F.col("o_custkey").alias("event_count"), F.repeat(F.lit("e"), 5000).alias("error"))


@query(_QUEUE + f""", {_RESULTS} select match_id, coalesce(outcome, status) as status, r.event_count, case when outcome = 'FAILED' then 4000 end::int as error_chars,
case when outcome = 'FAILED' then {_NOW} + interval 12 hour when outcome is null then next_attempt_at end as next_attempt_at, case when outcome in ('SUCCESS', 'NO_EVENT_DATA') then {_NOW} else completed_at end as completed_at from q left join r using (match_id)""")
def queue_finished(t):
    return queue.finished(_queue(t), _results(t), _now()).select("match_id", "status", "event_count", F.length("last_error").alias("error_chars"), "next_attempt_at", "completed_at")


def _running(t):
    run = F.col("match_id") % 6 == 0
    began = _now() - F.make_dt_interval(F.lit(0), (F.col("match_id") % 24).cast("int"))
    return _queue(t).withColumns({"status": F.when(run, queue.RUNNING).otherwise(F.col("status")), "claimed_by": F.when(run, F.when(F.col("match_id") % 4 == 0, "w1").otherwise("w2")), "claimed_at": F.when(run, began)})


@query(_QUEUE + "select match_id, case when match_id % 6 = 0 and match_id % 4 = 0 then 'PENDING' when match_id % 6 = 0 then 'RUNNING' else status end as status, case when match_id % 6 = 0 and match_id % 4 = 0 then greatest(attempt_count - 1, 0) else attempt_count end::int as attempt_count, case when match_id % 6 = 0 and match_id % 4 <> 0 then 'w2' end as claimed_by from q")
def queue_released(t):
    return queue.released(_running(t), "w1").select("match_id", "status", "attempt_count", "claimed_by")


@query(_QUEUE + "select match_id, case when match_id % 6 = 0 then case when match_id % 24 > 12 then 'PENDING' else 'RUNNING' end else status end as status from q")
def queue_lease_expired(t):
    return queue.released_stale(_running(t), _now()).select("match_id", "status")


@query(_QUEUE + f"select match_id, case when match_id % 2 = 0 then case when scheduled_at >= {_NOW} - interval 3000 day then 'PENDING' else 'NO_EVENT_DATA' end else status end as status from q")
def queue_retried_empty(t):
    return queue.retried_empty(_queue(t).withColumn("status", F.when(F.col("match_id") % 2 == 0, queue.NO_DATA).otherwise(F.col("status"))), _now(), 3000).select("match_id", "status")


@query("select event_type, count(*) as n from events where ts >= (select max(ts) from events where event_id % 2 = 0) - interval 15 minute group by all")
def since_cursor(t):
    cursor = t.events.where("event_id % 2 = 0").select("ts")
    return upserts.since_cursor(t.events, "ts", cursor).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query(f"select event_type as feed, case when event_type = (select min(event_type) from events) then {_NOW} else max(ts) end as at from events group by event_type union all select 'none of these', timestamp '1998-01-01 00:00:00'")
def cursors(t):
    """Cursors at each feed's newest event: the first advances with a run, the last's run fails and it stays; a feed that has
    no events is seeded."""
    newest = t.events.groupBy(F.col("event_type").alias("feed")).agg(F.max("ts").cast("timestamp_ntz").alias("at"))
    first, last = newest.agg(F.min("feed"), F.max("feed")).first()
    moved = upserts.advanced(upserts.advanced(newest, first, _now(), failed=0), last, _now(), failed=2)
    return upserts.seeded(moved, [first, "none of these"], F.expr("timestamp_ntz '1998-01-01 00:00:00'"))


@query("select o_orderkey, o_custkey, o_totalprice from orders where o_custkey % 10 not in (1, 2) union all select o_orderkey, o_custkey, o_totalprice + 1 from orders where o_custkey % 10 = 2 and o_orderkey % 2 = 0")
def change_feed(t):
    """A feed of changes: groups that are deleted, and groups whose rows are all replaced."""
    path = f"{sinks.shared_dir(t.spark)}/changes-{uuid.uuid4().hex}"
    o = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    o.write.parquet(path)
    gone = o.where("o_custkey % 10 = 1").withColumn("op", F.lit("delete"))
    new = o.where("o_custkey % 10 = 2 and o_orderkey % 2 = 0").withColumn("o_totalprice", F.col("o_totalprice") + 1).withColumn("op", F.lit("put"))
    left = o.where("o_custkey % 10 = 2").select("o_custkey").distinct().join(new.select("o_custkey").distinct(), "o_custkey", "left_anti")
    whole = gone.unionByName(new).unionByName(left.select(F.lit(0).cast("long").alias("o_orderkey"), "o_custkey", none("double").alias("o_totalprice"), F.lit("delete").alias("op")))
    upserts.changes_into(path, "o_orderkey", group="o_custkey")(whole, 0)
    return t.spark.read.parquet(path)


@query("select l_orderkey, l_linenumber from lineitem where l_orderkey not in (select o_orderkey from orders where o_orderstatus = 'F') or l_linenumber > 5")
def scoped_delete(t):
    """Rows go where a catalogue has their key, of some lines only."""
    lines = t.lineitem.select("l_orderkey", "l_linenumber")
    scope = t.orders.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    return merge.delete_keys(lines, lines.where("l_linenumber <= 5").join(scope, "l_orderkey", "left_semi"), ["l_orderkey", "l_linenumber"])


# identities and models

_IDENTITIES = "with i as (select o_orderkey as identity_id, case when o_orderkey % 4 = 0 then 'MANUAL' else 'A' end as source_system, o_orderkey::varchar as source_id, o_custkey as canonical, o_orderpriority = '1-URGENT' as is_primary, case when o_orderkey % 3 > 0 then floor(o_totalprice / 100000) end as confidence, o_orderdate as updated_at from orders)\n"


def _ids(t, canonical="canonical"):
    n = F.col("o_orderkey")
    return t.orders.select(n.alias("identity_id"), F.when(n % 4 == 0, models.MANUAL).otherwise(models.PROVIDER).alias("source_system"), n.cast("string").alias("source_id"), F.col("o_custkey").alias(canonical), (F.col("o_orderpriority") == "1-URGENT").alias("is_primary"), F.when(n % 3 > 0, F.floor(F.col("o_totalprice") / 100000)).alias("confidence"), F.col("o_orderdate").alias("updated_at"))


_PRIMARY = "order by case when is_primary then 0 else 1 end, confidence desc nulls last, identity_id"


@query(_IDENTITIES + f"select canonical, max(case when source_system = 'A' then source_id end) as external_id, max(case when source_system = 'MANUAL' then source_id end) as manual_id from (select * from i qualify row_number() over (partition by source_system, canonical {_PRIMARY}) = 1) group by all")
def primary_of_systems(t):
    ids = _ids(t)
    return models.primary_of(ids, models.PROVIDER, "canonical", "external_id").join(models.primary_of(ids, models.MANUAL, "canonical", "manual_id"), "canonical", "full")


@query(_IDENTITIES + "select source_system, source_id, canonical as fixture_id from i qualify row_number() over (partition by source_system, source_id order by case when is_primary then 0 else 1 end, confidence desc nulls last, updated_at desc nulls last, canonical) = 1")
def fixture_resolutions(t):
    return bridge.best_identities(_ids(t, "fixture_id"), ["source_system", "source_id"], "fixture_id").select("source_system", "source_id", "fixture_id")


@query(_IDENTITIES + f""", f as (select *, first_value(source_id) over (partition by canonical {_PRIMARY}) as current from i where source_system = 'A')
select l_orderkey, l_linenumber, coalesce(current, l_orderkey::varchar) as player from lineitem left join f on f.source_id = l_orderkey::varchar and f.current <> f.source_id""")
def stale_ids_remapped(t):
    order = [ranking.primary_first(F.col("is_primary")), F.col("confidence").desc_nulls_last(), F.asc("identity_id")]
    stale = identity.stale_ids(_ids(t).where("source_system = 'A'"), "canonical", order)
    return identity.remapped(t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_orderkey").cast("string").alias("player")), stale, "player")


@query("""with m as (select o_orderkey as id, nullif(o_custkey % 40, 0) as home_squad_id, nullif(o_custkey % 37, 0) as away_squad_id, case when o_orderkey % 9 = 0 then 'bad' else o_orderdate::varchar end as scheduled from orders),
s as (select s_suppkey as squad_id, case when s_nationkey % 3 = 0 then 'FEMALE' else 'MALE' end as gender from supplier where s_suppkey < 50)
select id, home_squad_id, away_squad_id, try_cast(scheduled as timestamp) as scheduled_at from m join s h on h.squad_id = home_squad_id join s a on a.squad_id = away_squad_id
where h.gender = 'MALE' and a.gender = 'MALE' and try_cast(scheduled as timestamp) is not null and id::varchar not in (select l_orderkey::varchar from lineitem where l_linenumber = 6)""")
def mintable_fixtures(t):
    squads = t.supplier.where("s_suppkey < 50").select(F.col("s_suppkey").alias("squad_id"), F.when(F.col("s_nationkey") % 3 == 0, "FEMALE").otherwise("MALE").alias("gender"))
    return identity.mintable_fixtures(_fixtures(t), squads, _linked(t), "A")


def _fixtures(t):
    key = lambda n: F.nullif(F.col("o_custkey") % n, F.lit(0))
    return t.orders.select(F.col("o_orderkey").alias("id"), key(40).alias("home_squad_id"), key(37).alias("away_squad_id"), F.when(F.col("o_orderkey") % 9 == 0, "bad").otherwise(F.col("o_orderdate").cast("string")).alias("scheduled"))


def _linked(t):
    return t.lineitem.where("l_linenumber = 6").select(F.lit("A").alias("source_system"), F.col("l_orderkey").cast("string").alias("source_id"))


@query("select count_if(o_custkey % 40 = 0 or o_custkey % 37 = 0)::bigint as missing_squad, count_if(o_orderkey % 9 = 0)::bigint as bad_date from orders where o_orderkey not in (select l_orderkey from lineitem where l_linenumber = 6)")
def skipped_fixtures(t):
    return identity.skipped_fixtures(_fixtures(t), _linked(t), "A")


@query("select o_orderkey, o_custkey % 40 as home, (o_custkey * 7) % 40 as away from orders where o_custkey % 40 in (select s_suppkey from supplier where s_acctbal > 0) and (o_custkey * 7) % 40 in (select s_suppkey from supplier where s_acctbal > 0)")
def both_roles(t):
    wanted = t.supplier.where("s_acctbal > 0")
    o = t.orders.select("o_orderkey", (F.col("o_custkey") % 40).alias("home"), ((F.col("o_custkey") * 7) % 40).alias("away"))
    return o.join(wanted.select(F.col("s_suppkey").alias("home")), "home", "left_semi").join(wanted.select(F.col("s_suppkey").alias("away")), "away", "left_semi").select("o_orderkey", "home", "away")


@query("""select c_custkey as canonical_id, case when c_custkey = 2 then false else true end as is_active, case when c_custkey % 5 = 2 and c_custkey = 2 then 1 else c_custkey end as points_to, (select count(*) from customer where c_custkey = 2) as overrides from customer""")
def merged_player(t):
    players = t.customer.select(F.col("c_custkey").alias("canonical_id"), F.lit(True).alias("is_active"))
    ids = t.customer.select(F.lit("A").alias("source_system"), F.col("c_custkey").cast("string").alias("source_id"), F.col("c_custkey").alias("canonical_id"))
    gone, pointed, given = identity.merged_players(players, ids, ids.limit(0), 1, 2)
    n = given.agg(F.count(F.lit(1)).alias("overrides"))
    return gone.join(pointed.select(F.col("source_id").cast("long").alias("canonical_id"), F.col("canonical_id").alias("points_to")), "canonical_id").join(F.broadcast(n))


@query("select c_custkey % 90 as player, c_custkey, c_acctbal from customer where c_custkey::varchar not in (select o_custkey::varchar from orders where o_custkey % 3 = 0) qualify row_number() over (partition by c_custkey % 90 order by c_acctbal desc nulls last, c_custkey) = 1")
def new_external_players(t):
    rows = t.customer.select((F.col("c_custkey") % 90).alias("player"), "c_custkey", "c_acctbal")
    linked = t.orders.where("o_custkey % 3 = 0").select(F.col("o_custkey").cast("string").alias("source_id"))
    new = merge.missing(rows.withColumn("source_id", F.col("c_custkey").cast("string")), linked, ["source_id"])
    return ranking.first_by(new, ["player"], [F.col("c_acctbal").desc_nulls_last(), F.asc("c_custkey")]).select("player", "c_custkey", "c_acctbal")


@query("select o_custkey % 50 as competition_id, o_orderpriority as competition_name from orders qualify row_number() over (partition by o_custkey % 50 order by o_orderdate desc nulls last, o_orderkey::varchar desc) = 1")
def competitions(t):
    rows = t.orders.select((F.col("o_custkey") % 50).alias("competition_id"), F.col("o_orderpriority").alias("competition_name"), none("string").alias("competition_type"), none("long").alias("competition_country_id"), none("string").alias("competition_gender"), F.col("o_orderdate").alias("last_change_at"), F.col("o_orderkey").cast("string").alias("season"))
    return models.competitions(rows).select("competition_id", "competition_name")


@query("select c_nationkey as squad_id, c_name as squad_name from customer qualify row_number() over (partition by c_nationkey order by coalesce(nullif(c_custkey % 100, 0), 0) desc, c_name) = 1")
def squads(t):
    return models.squads(t.customer.select(F.col("c_nationkey").alias("squad_id"), F.col("c_name").alias("squad_name"), F.nullif(F.col("c_custkey") % 100, F.lit(0)).alias("iteration_id")))


_PLAYER_IDS = "with ids as (select c_custkey::varchar as source_id, c_custkey + 1000 as player_id from customer where c_custkey % 3 <> 0)\n"


def _player_ids(t):
    return t.customer.where("c_custkey % 3 <> 0").select(F.lit(models.PROVIDER).alias("source_system"), F.col("c_custkey").cast("string").alias("source_id"), (F.col("c_custkey") + 1000).alias("player_id"))


@query(_PLAYER_IDS + "select player_id, o_orderkey as iteration_id from ids join orders on o_custkey::varchar = source_id where o_orderkey % 7 <> 0 qualify row_number() over (partition by player_id order by o_orderkey desc) = 1")
def newest_context(t):
    rows = t.orders.select(F.col("o_custkey").alias("source_player_id"), F.nullif(F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderkey")), F.lit(0)).alias("iteration_id"))
    rows = models.resolved(rows.where("iteration_id is not null"), _player_ids(t), "source_player_id", "player_id")
    return ranking.first_by(rows, ["player_id"], [F.desc("iteration_id")]).select("player_id", "iteration_id")


@query(_PLAYER_IDS + "select player_id, event_type as position_code from ids join events on user_id::varchar = source_id where event_type <> 'error' qualify row_number() over (partition by player_id order by event_id % 3 desc, event_id % 50 desc, event_id desc) = 1")
def recent_position(t):
    e = t.events.select(F.col("user_id").alias("source_player_id"), F.when(F.col("event_type") != "error", F.col("event_type")).alias("player_position"), (F.col("event_id") % 3).alias("iteration_id"), (F.col("event_id") % 50).alias("match_id"), F.col("event_id").alias("event_index"))
    return models.recent_position(e, _player_ids(t))


@query("select user_id as fixture_id, event_id as run_id, ts as loaded_at, event_id::varchar as home_team from events qualify row_number() over (partition by user_id order by ts desc nulls last, event_id desc) = 1")
def newest_versions(t):
    v = t.events.select(F.col("user_id").alias("fixture_id"), F.col("ts").alias("loaded_at"), F.col("event_id").alias("run_id"), J(F.struct(F.struct(F.col("event_id").alias("id")).alias("home"))).alias("payload"))
    return models.newest_versions(v).select("fixture_id", "run_id", "loaded_at", "home_team")


@query("select event_id as asset, user_id from events where event_type = 'click' and value < 50 qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1 order by ts desc, event_id desc limit 10")
def assets_to_stage(t):
    rows = t.events.where("event_type = 'click' and value < 50")  # the kind wanted, and not staged, before they are ranked
    return ranking.first_by(rows, ["user_id"], [F.desc("ts"), F.desc("event_id")]).orderBy(F.desc("ts"), F.desc("event_id")).limit(10).select(F.col("event_id").alias("asset"), "user_id")


@query("select o_custkey as legacy_id, o_orderkey as fixture_id from orders qualify row_number() over (partition by o_custkey order by case when o_orderkey % 3 <> 0 and o_orderkey % 5 <> 0 then 0 else 1 end, o_orderkey) = 1")
def legacy_fixture(t):
    both = F.nullif(F.col("o_orderkey") % 3, F.lit(0)).isNotNull() & F.nullif(F.col("o_orderkey") % 5, F.lit(0)).isNotNull()
    return ranking.first_by(t.orders, ["o_custkey"], [ranking.primary_first(both), F.asc("o_orderkey")]).select(F.col("o_custkey").alias("legacy_id"), F.col("o_orderkey").alias("fixture_id"))


@query("select l_suppkey as player_id, l_orderkey % 9 as season_id, l_orderkey % 3 as competition_id, l_linenumber as kpi_id, sum(l_quantity::decimal(18,2))::double as season_total, count(distinct l_orderkey) as matches_played from lineitem group by all")
def season_kpis(t):
    k = t.lineitem.select(F.col("l_suppkey").alias("player_id"), (F.col("l_orderkey") % 9).alias("season_id"), (F.col("l_orderkey") % 3).alias("competition_id"), F.col("l_linenumber").alias("kpi_id"), F.col("l_quantity").cast("decimal(18,2)").alias("kpi_value"), F.col("l_orderkey").alias("fixture_id"), F.lit(1.0).alias("play_duration_seconds"))
    return models.season_kpis(k).select("player_id", "season_id", "competition_id", "kpi_id", F.col("season_total").cast("double").alias("season_total"), "matches_played")


@query("""with a as (select l_orderkey % 50 as m, l_suppkey % 10 as s, l_linenumber as p, l_returnflag as f, count(*) as n from lineitem group by all), b as (select l_orderkey % 50 as m, l_suppkey % 10 as s, l_linenumber as p, l_returnflag as f, count(*) as n from lineitem where l_quantity > 3 and l_linestatus <> 'X' group by all)
select coalesce(a.m, b.m) as m, coalesce(a.s, b.s) as s, coalesce(a.p, b.p) as p, coalesce(a.f, b.f) as f, a.n as left_n, b.n as right_n from a full join b on a.m = b.m and a.s = b.s and a.p = b.p and a.f = b.f where a.n is distinct from b.n""")
def reconciled_on_four_keys(t):
    keys = [(F.col("l_orderkey") % 50).alias("m"), (F.col("l_suppkey") % 10).alias("s"), F.col("l_linenumber").alias("p"), F.col("l_returnflag").alias("f")]
    count = lambda df: df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return quality.reconciled(count(t.lineitem), count(t.lineitem.where("l_quantity > 3")), ["m", "s", "p", "f"], ["n"])


@query("select 'null key' as test, o_orderkey as id from orders where nullif(o_custkey % 11, 0) is null union all select 'price', o_orderkey from orders where not (o_totalprice > 1000) union all select 'status', o_orderkey from orders where o_orderstatus not in ('O', 'F')")
def failing_rows(t):
    o = t.orders.select("*", F.nullif(F.col("o_custkey") % 11, F.lit(0)).alias("k"))
    found = {"null key": quality.not_null(o, ["k"]), "price": quality.failing(o, F.col("o_totalprice") > 1000), "status": quality.not_accepted(o, "o_orderstatus", ["O", "F"])}
    return flatten.stacked([rows.select(F.lit(name).alias("test"), F.col("o_orderkey").alias("id")) for name, rows in found.items()])


@query("select c_nationkey as season, count(*) as customers, n_name as name from customer join nation on n_nationkey = c_nationkey group by all")
def built_models(t):
    """A small graph of models, built and tested: a view over a source, a table over the view, and a view over the table."""
    plan = registry.Plan(tables.Sources(t.root), f"{sinks.shared_dir(t.spark)}/models-{uuid.uuid4().hex}")
    plan.model("fact", "people", "nation", kept=registry.TABLE, grain=("season",), required=("customers",))(lambda p, n: p.groupBy("season").agg(F.count(F.lit(1)).alias("customers")).join(n.select(F.col("n_nationkey").alias("season"), F.col("n_name").alias("name")), "season"))
    plan.model("people", "customer")(lambda c: models.typed(c, {"id": "c_custkey", "season": "c_nationkey"}))
    plan.model("view", "fact", parents=(("season", "fact", "season"),))(lambda f: f.select("season", "customers", "name"))
    return plan.build(t.spark)["view"]


# functions, sources and sinks


@query("""select event_id, ts - interval 2 hour as utc, coalesce(event_type in ('click'), false) as truthy, left(event_type, 3) as cut, case when event_id % 2 = 0 then user_id end as mapped, null::timestamp as bad from events""")
def scalar_rules(t):
    e = t.events.select("event_id", F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+02:00")).alias("text"), "event_type", "user_id", F.lit("2024-13-45").alias("no"))
    ids = F.array(F.create_map(F.lit("other"), F.array(F.lit(1).cast("long"))), F.create_map(F.lit("mine"), F.when(F.col("event_id") % 2 == 0, F.array("user_id")).otherwise(F.array().cast("array<bigint>"))))
    e = e.withColumn("mappings", ids)
    return e.select("event_id", scalars.utc_or_null("text").alias("utc"), scalars.is_truthy(F.when(F.col("event_type") == "click", " Yes ").otherwise(F.col("event_type"))).alias("truthy"), scalars.truncated(F.col("event_type"), 3).alias("cut"), flatten.first_mapping("mappings", "mine").alias("mapped"), scalars.utc_or_null("no").alias("bad"))


@query("select o_orderkey as \"ORDER_KEY\", o_totalprice as \"TOTAL_PRICE_EUR\" from orders")
def cleaned_names(t):
    return scalars.cleaned_columns(t.orders.select(F.col("o_orderkey").alias("order key"), F.col("o_totalprice").alias("_total.price (eur)")))


@query("select s_suppkey as id, s_name as name, s_acctbal as balance, null::bigint as region from supplier union all select n_nationkey, n_name, null, n_regionkey from nation")
def stacked_frames(t):
    a = t.supplier.select(F.col("s_suppkey").cast("long").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    b = t.nation.select(F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("name"), F.col("n_regionkey").cast("long").alias("region"))
    return flatten.stacked([a, b])


@query("select o_orderkey, o_totalprice from orders")
def known_columns(t):
    o = t.orders.select("o_orderkey", "o_totalprice", F.lit(1).alias("unknown"))
    return flatten.only_known_columns(o, sinks.empty_like(t.orders.select("o_orderkey", "o_totalprice", "o_custkey")))


@query("select o_orderkey, o_custkey, o_totalprice from orders")
def parts_written(t):
    """A table written in parts: the first replaces what was there, the next is appended, each sorted."""
    path = f"{sinks.shared_dir(t.spark)}/parts-{uuid.uuid4().hex}"
    o = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    sinks.overwrite(o, path)
    sinks.write_parts([o.where(f"o_orderkey % 3 = {k}").sortWithinPartitions("o_custkey", "o_orderkey") for k in range(3)], path)
    return t.spark.read.parquet(path)


@query("select o_orderkey, o_orderstatus, case when o_orderstatus = 'F' then 0.0 else o_totalprice end as o_totalprice from orders union all select o_orderkey, o_orderstatus, 1.0 from orders where false")
def partitions_replaced(t):
    path = f"{sinks.shared_dir(t.spark)}/partitions-{uuid.uuid4().hex}"
    o = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    sinks.replace_partitions(o, path, ["o_orderstatus"])
    sinks.replace_partitions(o.where("o_orderstatus = 'F'").withColumn("o_totalprice", F.lit(0.0)), path, ["o_orderstatus"])
    return t.spark.read.parquet(path).select("o_orderkey", "o_orderstatus", "o_totalprice")


@query("select event_id, (props->>'$.k')::bigint as k from events")
def staged_variants(t):
    """JSON text staged as variants, in the order of the event."""
    path = f"{sinks.shared_dir(t.spark)}/staged-{uuid.uuid4().hex}"
    sinks.staged_json(t.events.select("event_id", "props"), path, ["props"], ["event_id"])
    return t.spark.read.parquet(path).select("event_id", F.try_variant_get("props", "$.k", "bigint").alias("k"))


@query("select c_custkey, c_name from customer union all select s_suppkey, s_name from supplier")
def csv_and_json_files(t):
    base = f"{sinks.shared_dir(t.spark)}/files-{uuid.uuid4().hex}"
    sinks.write_csv(t.customer.select("c_custkey", "c_name"), f"{base}/csv")
    sinks.write_jsonl(t.supplier.select(F.col("s_suppkey").alias("c_custkey"), F.col("s_name").alias("c_name")), f"{base}/json")
    schema = "c_custkey bigint, c_name string"
    return tables.read_csv(t.spark, f"{base}/csv", schema).unionByName(tables.read_json(t.spark, f"{base}/json", schema))


@query("select c_custkey as id, name, c_custkey + 1000000 as reserved from customer left join (values (0, 'a'), (1, 'b'), (2, null)) v(id, name) on id = c_custkey % 4")
def inline_rows(t):
    """Names given inline for three of four groups of customers, who get ids of a block that is reserved for them."""
    names = tables.inline(t.spark, [(0, "a"), (1, "b"), (2, None)], "k long, name string")
    n = t.customer.agg(F.coalesce(F.max("c_custkey") + 1, F.lit(0))).first()[0]
    block = tables.id_block(t.spark, 1_000_000, n, "reserved")
    return t.customer.join(names, F.col("k") == F.col("c_custkey") % 4, "left").join(block, F.col("reserved") == F.col("c_custkey") + 1_000_000).select(F.col("c_custkey").alias("id"), "name", "reserved")


@query("select c_mktsegment as segment, c_custkey as id, c_name as name from customer")
def paged_service(t):
    """Customers as answers of a service with offset and limit, asked for by segment."""
    base = f"{sinks.shared_dir(t.spark)}/answers-{uuid.uuid4().hex}"
    rows = t.customer.select(F.col("c_mktsegment").alias("segment"), F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.hex("c_mktsegment").alias("key"))
    rows.write.partitionBy("key").json(base)
    t.spark.dataSource.register(rest.PagedSource)
    keys = [f"{sinks.uri(base)}/key={r[0]}" for r in rows.select("key").distinct().collect()]
    pages = t.spark.read.format("paged_json").option("fetch", "fieldspark.sources.archive:rows_of_folder").option("keys", ",".join(keys)).load()
    return pages.select(F.from_json("payload", "segment string, id long, name string").alias("x")).select("x.*")
