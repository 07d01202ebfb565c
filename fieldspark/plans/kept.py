"""Queries of what is kept between runs: versioned tables, incremental models and their tests, feeds with cursors."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from fieldspark.operators import merge, shapes, spells
from fieldspark.plans import models, registry
from fieldspark.plans.catalogue import _MERGE, _changes, _target, query
from fieldspark.plans.model_queries import _SEASONS, _raw
from fieldspark.plans.models import KPI_GRAIN, football
from fieldspark.sources import buckets, payloads, ranges, rest, sinks, tables
from fieldspark.sources.versions import VersionedTable
from fieldspark.streaming import feeds as feeds_of
from fieldspark.streaming import upserts


@query(_MERGE + """, changed as (select * from old where o_orderkey not in (select o_orderkey from new) union all select * from new)
select 1 as state, o_orderstatus, count(*) as n, sum(o_totalprice::decimal(18,2))::double as total from old group by all
union all select 2, o_orderstatus, count(*), sum(o_totalprice::decimal(18,2))::double from changed group by all
union all select 3, o_orderstatus, count(*), sum(o_totalprice::decimal(18,2))::double from changed where o_custkey % 10 <> 1 group by all""")
def table_states(t):
    """A table in slices by customer: loaded, upserted, and some customers deleted; each of its states read again."""
    table = VersionedTable(t.spark, f"{sinks.shared_dir(t.spark)}/states-{uuid.uuid4().hex}", F.col("o_custkey") % 16)
    table.replace(_target(t))
    table.upsert(_changes(t), ["o_orderkey"])
    gone = t.customer.where("c_custkey % 10 = 1").select(F.col("c_custkey").alias("o_custkey"))
    table.publish(table.staged_upsert(_target(t).limit(0), ["o_orderkey"], gone, ["o_custkey"]), 2)
    total = lambda n: table.read(n).groupBy("o_orderstatus").agg(F.lit(n).alias("state"), F.count(F.lit(1)).alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"))
    return total(1).unionByName(total(2)).unionByName(total(3))


_DAY = "2001-06-01"


def _one_a_grain(kpis):
    """The newest date and the largest value of each KPI, which line items repeat. Dates are compared as times: for texts Spark
    sorts all rows on both sides of the shuffle."""
    newest = F.max(F.col("scheduledDate").cast("timestamp_ntz")).cast("string")
    return kpis.groupBy(*[c for c in kpis.columns if c not in ("value", "scheduledDate")]).agg(newest.alias("scheduledDate"), F.max("value").alias("value"))


@query(_SEASONS + f""", k as (select l_suppkey, l_orderkey, l_linenumber, max(l_shipdate) as d, max(l_quantity)::double as q from lineitem group by all)
select player_id, l_orderkey + 5000000 as fixture_id, l_linenumber::bigint as kpi_id, l_suppkey as squad_id, 'CB' as position_code, l_orderkey % 25 + 100 as season_id, s.competition_id, d::timestamp as scheduled_at,
case when d::timestamp < timestamp '{_DAY}' and d::timestamp >= timestamp '{_DAY}' - interval 5 day then q + 1 else q end as kpi_value, case when d::timestamp >= timestamp '{_DAY}' - interval 5 day then 'late' end as note
from k join ids on source_id = l_suppkey join orders on o_orderkey = l_orderkey and o_orderkey % 3 <> 0 left join seasons s on s.season_id = l_orderkey % 25 + 100""")
def model_incremental_kpis(t):
    """The fact of KPIs built over what was there on one day, then again over all of it, after the provider had calculated the
    last five days anew and the model had got a column: only what is new is read and merged, and all of it is there."""
    raw, base = _raw(t), f"{sinks.shared_dir(t.spark)}/football-{uuid.uuid4().hex}"
    for s in ("player_identities", "player_overrides", "fixture_identities", "iterations"):
        raw[s].write.parquet(f"{base}/raw/{s}.parquet")
    kpis = raw["player_kpis"]
    one = sinks.written(_one_a_grain(kpis), "kpis")
    day = F.lit(_DAY).cast("timestamp_ntz")
    at = F.col("scheduledDate").cast("timestamp_ntz")
    late = (at < day) & (at >= day - F.make_dt_interval(F.lit(5)))
    plan = football(tables.Sources(f"{base}/raw"), f"{base}/models")
    del plan.checks["KPI players are known"]  # some aren't, and their rows stay away
    one.where(at < day).write.parquet(f"{base}/raw/player_kpis.parquet")
    plan.build(t.spark, ["player_fixture_kpis"])
    one.withColumn("value", F.when(late, F.col("value") + 1).otherwise(F.col("value"))).write.mode("overwrite").parquet(f"{base}/raw/player_kpis.parquet")
    fact = plan.models["player_fixture_kpis"]
    noted = lambda *inputs: fact.build(*inputs).withColumn("note", F.when(F.col("scheduled_at") >= day - F.make_dt_interval(F.lit(5)), "late"))
    plan.model(fact.name, *fact.inputs, kept=fact.kept, grain=fact.grain, cursor=fact.cursor, slices=fact.slices)(noted)
    return plan.build(t.spark, ["player_fixture_kpis"])["player_fixture_kpis"].select(*KPI_GRAIN, "season_id", "competition_id", "scheduled_at", "kpi_value", "note")


@query(_SEASONS + """select player_id, l_orderkey + 5000000 as fixture_id, l_linenumber::bigint as kpi_id, l_suppkey as squad_id, l_orderkey % 25 + 100 as season_id, s.competition_id, max(l_quantity)::double as kpi_value
from lineitem join ids on source_id = l_suppkey join orders on o_orderkey = l_orderkey and o_orderkey % 3 <> 0 left join seasons s on s.season_id = l_orderkey % 25 + 100 group by all""")
def model_bucketed_kpis(t):
    """The fact of KPIs over a source in buckets of both provider ids: pairs of ids are resolved, and no KPI row is shuffled for
    it."""
    raw, base = _raw(t), f"{sinks.shared_dir(t.spark)}/football-{uuid.uuid4().hex}"
    for s in ("player_identities", "player_overrides", "fixture_identities", "iterations"):
        raw[s].write.parquet(f"{base}/raw/{s}.parquet")
    kpis = raw["player_kpis"]
    one = _one_a_grain(kpis)
    name = f"player_kpis_{uuid.uuid4().hex}"
    buckets.write_bucketed(models.with_pair(one, "playerId", "matchId"), name, f"{base}/player_kpis", list(models.PAIR), buckets.enough(kpis.count()))
    plan = football(tables.Sources(f"{base}/raw").add(tables.Source("player_kpis", "", table=name)), f"{base}/models")
    del plan.checks["KPI players are known"]  # some aren't, and their rows stay away
    return plan.build(t.spark, ["player_fixture_kpis"])["player_fixture_kpis"].select("player_id", "fixture_id", "kpi_id", "squad_id", "season_id", "competition_id", "kpi_value")


@query("""with known as (select c_custkey from customer where c_custkey % 4 <> 0 or c_custkey % 50 = 0)
select 'KPI players are known' as "check", count(distinct l_suppkey) as failures from lineitem where l_suppkey not in (select c_custkey from known)
union all select 'events have match info', count(distinct event_id % 50) from events where event_id % 50 >= 45 union all select 'one season value a player and KPI', 0""")
def model_checks(t):
    """The checks over several models, on tables that break two of them."""
    raw, base = _raw(t), f"{sinks.shared_dir(t.spark)}/football-{uuid.uuid4().hex}"
    side = lambda s: [F.lit(1).cast("long").alias(f"{s}_squad_id"), F.lit(None).cast(spells.STARTS).alias(f"{s}_starting"), F.lit(None).cast(spells.CHANGES).alias(f"{s}_changes")]
    raw["match_info"] = t.events.select((F.col("event_id") % 50).alias("match_id")).where("match_id < 45").distinct().select("match_id", F.lit(101).cast("long").alias("iteration_id"), *side("home"), *side("away"))
    for s in ("player_kpis", "player_identities", "player_overrides", "fixture_identities", "iterations", "events", "match_info"):
        raw[s].write.parquet(f"{base}/raw/{s}.parquet")
    plan = football(tables.Sources(f"{base}/raw"), f"{base}/models")
    built = plan.build(t.spark, ["player_season_kpis", "stg_events", "stg_match_info", "player_ids", "stg_player_kpis"], test=False)
    return plan.failures(built)


@query("""with newest as (select * from events qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1)
select user_id as id, case when event_type = 'error' then 'DELETED' else 'SUCCESS' end as status, case when event_type <> 'error' then value end as value, case when event_type <> 'error' then (event_id % 4) else 0 end::bigint as n_events from newest""")
def feed_applied(t):
    """Events as a feed of changes to matches, asked for in three runs of a stream with a time cursor, each of which takes its
    batch over into three tables: match info, the matches' events (replaced together), and the status of each match."""
    base = f"{sinks.shared_dir(t.spark)}/feed-{uuid.uuid4().hex}"
    payload = F.to_json(F.struct(F.col("value").alias("v"), (F.col("event_id") % 4).alias("n"), F.lpad(F.col("event_id").cast("string"), 20, "0").alias("place")))
    op = F.when(F.col("event_type") == "error", feeds_of.DELETE).otherwise("update")
    changes = t.events.select(F.col("user_id").alias("id"), op.alias("op"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("at"), payload.alias("payload"), F.to_date("ts").alias("day"))
    changes.hint("rebalance", "day").write.partitionBy("day").json(f"{base}/source")
    info, events, status = (VersionedTable(t.spark, f"{base}/{n}", F.pmod("id", F.lit(8))) for n in ("info", "events", "status"))
    said = F.from_json("payload", "v double, n long")
    rows = {
        info: lambda c: c.select("id", "at", said["v"].alias("value")),
        events: lambda c: c.select("id", F.explode(F.when(said["n"] > 0, F.sequence(F.lit(1).cast("long"), said["n"]))).alias("index")),
        status: lambda c: c.select("id", F.when(F.col("op") == feeds_of.DELETE, "DELETED").otherwise("SUCCESS").alias("status")),
    }
    empty = t.spark.createDataFrame([], feeds_of.FEED)
    for table, f in rows.items():
        table.replace(f(empty))
    t.spark.dataSource.register(feeds_of.ChangeFeed)
    run = feeds_of.applied_to([feeds_of.Dependent(info, rows[info], ["id"]), feeds_of.Dependent(events, rows[events], ["id", "index"]), feeds_of.Dependent(status, rows[status], ["id"], marks=True)], "matches")
    for now in ("2024-01-10T12:00:00", "2024-01-20T12:00:00", "2024-03-01T00:00:00"):
        options = {"fetch": "fieldspark.streaming.feeds:from_folder", "folder": f"{sinks.uri(base)}/source", "now": now, "bootstrapDays": "4000", "partHours": "2400"}
        upserts.start(t.spark.readStream.format("change_feed").options(**options).load(), run, f"{base}/cursor").awaitTermination()
    counted = events.read().groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    return status.read().join(info.read().select("id", "value"), "id", "left").join(counted, "id", "left").select("id", "status", "value", F.coalesce("n", F.lit(0)).alias("n_events"))


@query("select user_id as fixture_id, ts as loaded_at, event_id as run_id, value from events qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1")
def versions_kept(t):
    """The newest version of each fixture by a stream that keeps the newest as state, upserted into a table."""
    spark, base = t.spark, f"{sinks.shared_dir(t.spark)}/versions-{uuid.uuid4().hex}"
    rows = t.events.select(F.col("user_id").alias("fixture_id"), F.col("ts").cast("timestamp").alias("loaded_at"), F.col("event_id").alias("run_id"), "value")
    schema = rows.schema
    table = VersionedTable(spark, f"{base}/table")
    table.replace(rows.limit(0))
    before = {k: spark.conf.get(k, None) for k in feeds_of.ROCKS}
    for k, v in feeds_of.ROCKS.items():
        spark.conf.set(k, v)
    try:
        for part in ("event_id % 3 = 2", "event_id % 3 = 0", "event_id % 3 = 1"):
            rows.withColumn("event_id", F.col("run_id")).where(part).drop("event_id").write.mode("append").parquet(f"{base}/source")
            newest = feeds_of.newest_versions(spark.readStream.schema(schema).parquet(f"{base}/source"))
            upserts.start(newest, lambda batch, n: table.upsert(batch, ["fixture_id"]), f"{base}/state").awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    return table.read().select("fixture_id", F.col("loaded_at").cast("timestamp_ntz").alias("loaded_at"), "run_id", "value")


@query("""select path, type, n from (values ('k', 'BIGINT', (select count(*) from events)), ('who', 'MIXED', (select count(*) from events)), ('about.type', 'STRING', (select count(*) from events where event_id % 2 = 0)), ('about.`a.b`', 'BOOLEAN', (select count(*) from events where event_id % 2 = 0)), ('few', 'DOUBLE', (select count(*) from events where event_id % 5 = 0)), ('list', 'ARRAY', (select count(*) from events))) v(path, type, n)""")
def payload_shapes(t):
    """Which paths of which types payloads have that are made of the events: a value that is a number or a text, objects in
    half of them, a number with decimals in a fifth."""
    return shapes.shape(_payloads(t), "payload").select("path", "type", "n")


def _payloads(t):
    props = F.from_json("props", "k long")
    about = F.struct(F.col("event_type").alias("type"), (F.col("value") > 5).alias("a.b"))
    who = F.when(F.col("event_id") % 7 == 0, F.concat(F.lit('"'), F.col("user_id").cast("string"), F.lit('"'))).otherwise(F.col("user_id").cast("string"))
    text = F.to_json(F.struct(props["k"].alias("k"), F.when(F.col("event_id") % 2 == 0, about).alias("about"), F.when(F.col("event_id") % 5 == 0, F.col("event_id") + 0.5).alias("few"), F.array("user_id").alias("list")))
    return t.events.withColumn("said", text).select("event_id", F.concat(F.lit('{"who": '), who, F.lit(", "), F.expr("substring(said, 2)")).alias("payload"))


@query("""select * from (values ('few', 'added', 'DOUBLE', null), ('gone', 'lost', null, 'BIGINT'), ('k', 'retyped', 'BIGINT', 'STRING'), ('about.`a.b`', 'added', 'BOOLEAN', null), ('list', 'added', 'ARRAY', null)) v(path, change, type, was)""")
def payload_drift(t):
    known = t.spark.createDataFrame([("k", "STRING"), ("who", "MIXED"), ("about.type", "STRING"), ("gone", "BIGINT")], "path string, type string")
    return shapes.drift(shapes.shape(_payloads(t), "payload"), known)


@query("select event_id, (props->>'$.k')::bigint as k, case when event_id % 2 = 0 then event_type end as \"about.type\", case when event_id % 5 = 0 then event_id + 0.5::double end as few from events")
def payload_columns(t):
    """A table of payloads that gets the columns which a later batch has first: half of the rows are there before."""
    table = VersionedTable(t.spark, f"{sinks.shared_dir(t.spark)}/payloads-{uuid.uuid4().hex}")
    wide = lambda df: shapes.columns(df, "payload", [tuple(r) for r in shapes.shape(df, "payload").where("type not in ('ARRAY', 'MIXED')").select("path", "type").collect()]).drop("payload")
    p = _payloads(t)
    table.replace(wide(p.where("event_id % 2 = 1 and event_id % 5 <> 0")))
    table.upsert(wide(p.where("event_id % 2 = 0 or event_id % 5 = 0")), ["event_id"])
    return table.read().select("event_id", "k", "`about.type`", "few")


@query("""with k as (select l_suppkey as player_id, l_orderkey % 5 as season_id, l_orderkey % 3 as competition_id, l_linenumber::bigint as kpi_id, l_orderkey as fixture_id, case when l_orderkey % 20 = 1 then 2 * l_quantity else l_quantity end::decimal(18,2) as v from lineitem)
select player_id, season_id, competition_id, kpi_id, sum(v)::double as season_total, count(distinct fixture_id) as matches_played, count(*) * 60.0::double as total_play_duration_seconds from k group by all""")
def season_states(t):
    """Season values kept as mergeable parts: three loads of new fixtures, the last with some calculated again."""
    kpis = t.lineitem.select(F.col("l_suppkey").alias("player_id"), (F.col("l_orderkey") % 5).alias("season_id"), (F.col("l_orderkey") % 3).alias("competition_id"), F.col("l_linenumber").cast("long").alias("kpi_id"), F.col("l_orderkey").alias("fixture_id"), F.col("l_quantity").cast("double").alias("kpi_value"), F.lit(60.0).alias("play_duration_seconds"))
    table = VersionedTable(t.spark, f"{sinks.shared_dir(t.spark)}/seasons-{uuid.uuid4().hex}", F.col("season_id"), by_keys=True)
    table.replace(models.season_state(kpis.where("fixture_id % 4 = 0")))
    again = kpis.where("fixture_id % 20 = 1").withColumn("kpi_value", F.col("kpi_value") * 2)
    for part in (kpis.where("fixture_id % 4 in (1, 2)"), kpis.where("fixture_id % 4 = 3").unionByName(again)):
        table.upsert(models.season_state_changes(table.read(), part), list(models.SEASON_GRAIN))
    out = models.season_kpis_of(table.read())
    return out.select(*models.SEASON_GRAIN, F.round("season_total", 2).alias("season_total"), "matches_played", "total_play_duration_seconds")


@query("select l_orderkey as match_id, l_linenumber as event_index, l_quantity::double as q from lineitem")
def clustered_write(t):
    """Files in ranges of (match, event)."""
    path = f"{sinks.shared_dir(t.spark)}/clustered-{uuid.uuid4().hex}"
    sinks.write_clustered(t.lineitem.select(F.col("l_orderkey").alias("match_id"), F.col("l_linenumber").alias("event_index"), F.col("l_quantity").cast("double").alias("q")), path, ["match_id", "event_index"], 20_000)
    return t.spark.read.parquet(path)


@query("select event_id as frame, value from events")
def tracking_frames(t):
    """Frames of one large file of JSON lines, read in byte ranges."""
    base = f"{sinks.shared_dir(t.spark)}/tracking-{uuid.uuid4().hex}"
    t.events.select(F.col("event_id").alias("frame"), "value").coalesce(1).write.json(base)
    t.spark.dataSource.register(ranges.ByteRanges)
    lines = t.spark.read.format("byte_ranges").options(paths=sinks.uri(base), rangeBytes="65536", lines="true").load()
    return lines.select(F.from_json(F.decode("content", "utf-8"), "frame long, value double").alias("x")).select("x.*")


@query("select n_nationkey + 100 as id from nation where n_regionkey in (0, 2) and n_nationkey % 5 <> 0")
def iterations_in_scope(t):
    nested = _raw(t)["iterations"].select("id", "season", F.struct(F.col("`competition.id`").alias("id"), F.col("`competition.gender`").alias("gender")).alias("competition"))
    return payloads.in_scope(nested, ["23/24", "24/25"], [0, 2]).select("id")


@query("select o_orderkey as id from orders where o_orderkey % 4 <> 0 and o_orderkey % 9 <> 0 and o_orderdate <= timestamp '2000-01-01'")
def matches_loadable(t):
    """Available matches of the past; those without a readable date, or without a word on being available, are left out."""
    matches = _raw(t)["matches"].withColumn("available", F.when(F.col("id") % 8 != 0, F.col("id") % 4 != 0))
    return payloads.loadable(matches, F.lit("2000-01-01").cast("timestamp")).select("id")


@query("""select 'country' as what, n_nationkey as id, n_name as name, left(n_name, 3) as more from nation union all select 'coach', c_custkey, c_name, (c_nationkey + 100)::varchar from customer
union all select 'stadium', s_suppkey, s_name, (100 + s_suppkey % 10)::varchar from supplier""")
def model_small_catalogues(t):
    """Staging of countries, coaches and stadiums."""
    base = f"{sinks.shared_dir(t.spark)}/football-{uuid.uuid4().hex}"
    raw = {
        "countries": t.nation.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), F.substring("n_name", 1, 3).alias("fifaCode")),
        "coaches": t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), (F.col("c_nationkey") + 100).alias("iterationId")),
        "stadiums": t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), (100 + F.col("s_suppkey") % 10).alias("length"), F.lit(60).alias("width")),
    }
    for name, df in raw.items():
        df.write.parquet(f"{base}/raw/{name}.parquet")
    built = football(tables.Sources(f"{base}/raw"), f"{base}/models").build(t.spark, ["stg_countries", "stg_coaches", "stg_stadiums"])
    row = lambda what, model, key, name, more: built[model].select(F.lit(what).alias("what"), F.col(key).alias("id"), F.col(name).alias("name"), F.col(more).cast("string").alias("more"))
    return row("country", "stg_countries", "country_id", "country_name", "fifa_code").unionByName(row("coach", "stg_coaches", "coach_id", "coach_name", "iteration_id")).unionByName(row("stadium", "stg_stadiums", "stadium_id", "stadium_name", "length"))


@query("""select event_type as feed, case event_type when 'click' then timestamp '2024-03-01' when 'error' then max(ts) filter (where event_id % 2 = 0) else timestamp '2024-01-01' end as at from events group by event_type""")
def cursor_table(t):
    """Cursors of two feeds, at their newest event; one advances to its run's start, the other's run has failures and it stays;
    all other feeds are seeded."""
    old = t.events.where("event_type = 'error' and event_id % 2 = 0 or event_type = 'click'").groupBy(F.col("event_type").alias("feed")).agg(F.max("ts").alias("at"))
    moved = upserts.advanced(upserts.advanced(old, "click", F.expr("timestamp_ntz '2024-03-01 00:00:00'"), failed=0), "error", F.expr("timestamp_ntz '2024-03-01 00:00:00'"), failed=3)
    feeds = t.events.select(F.col("event_type").alias("feed"), F.expr("timestamp_ntz '2024-01-01 00:00:00'").alias("at")).distinct()
    return merge.insert_only(moved, feeds, ["feed"])


@query("select c_nationkey as season, count(*) as customers from customer group by all")
def model_in_its_schema(t):
    """A model's table in the schema of its own name, which only production has without the default behind it."""
    base = f"{sinks.shared_dir(t.spark)}/schemas-{uuid.uuid4().hex}"
    target = f"{base}/{registry.schema_name('core', 'dev', 'base')}"
    plan = registry.Plan(tables.Sources(t.root), target)
    plan.model("seasons", "customer", kept=registry.TABLE, grain=("season",))(lambda c: c.groupBy(F.col("c_nationkey").alias("season")).agg(F.count(F.lit(1)).alias("customers")))
    plan.build(t.spark)
    return VersionedTable(t.spark, f"{base}/core_base/seasons").read()


@query("select doc_id, lang, length(text) as n from documents")
def paged_documents(t):
    """The documents as pages of a service for each language, read page after page."""
    base = f"{sinks.shared_dir(t.spark)}/pages-{uuid.uuid4().hex}"
    rows = t.documents.select("doc_id", "lang", F.length("text").alias("n"), F.coalesce("lang", F.lit("none")).alias("key"))
    rows.repartition(5, "doc_id").write.partitionBy("key").json(base)
    t.spark.dataSource.register(rest.PagedSource)
    keys = [f"{sinks.uri(base)}/key={r[0]}" for r in rows.select("key").distinct().collect()]
    pages = t.spark.read.format("paged_json").option("fetch", "fieldspark.sources.archive:page_of_folder").option("keys", ",".join(keys)).load()
    return pages.select(F.from_json("payload", "doc_id long, lang string, n int").alias("x")).select("x.*")
