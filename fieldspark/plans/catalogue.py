"""One query for each operator over the driver's tables, and its SQL. Each reads its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldspark.functions import scalars, text
from fieldspark.operators import bridge, discovery, flatten, identity, incremental, merge, quality, queue, ranking, spells
from fieldspark.sources.sinks import shared_dir, written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """The tables below a folder, by attribute."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}.parquet")


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = lambda spark, root: f(Tables(spark, root))
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def exact(c: str, scale: int = 2):
    """A double as a decimal, so that sums don't depend on their order."""
    return F.col(c).cast(f"decimal(18,{scale})")


# newest or best row per key


@query("select user_id, event_id, ts, event_type from events qualify row_number() over (partition by user_id order by ts desc nulls last, event_id desc) = 1")
def latest_event_per_user(t):
    return ranking.first_by(t.events, ["user_id"], [F.col("ts").desc_nulls_last(), F.desc("event_id")]).select("user_id", "event_id", "ts", "event_type")


@query("select o_custkey, o_orderkey, o_totalprice from orders qualify row_number() over (partition by o_custkey order by o_orderdate desc nulls last, o_orderkey desc) = 1")
def latest_order_per_customer(t):
    return ranking.first_by(t.orders, ["o_custkey"], [F.col("o_orderdate").desc_nulls_last(), F.desc("o_orderkey")]).select("o_custkey", "o_orderkey", "o_totalprice")


@query("""select s_nationkey, s_suppkey, s_acctbal from supplier
qualify row_number() over (partition by s_nationkey order by case when s_acctbal > 5000 then 0 else 1 end, s_acctbal desc nulls last, s_suppkey) = 1""")
def best_supplier_row(t):
    order = [ranking.primary_first(F.col("s_acctbal") > 5000), F.col("s_acctbal").desc_nulls_last(), F.asc("s_suppkey")]
    return ranking.first_by(t.supplier, ["s_nationkey"], order).select("s_nationkey", "s_suppkey", "s_acctbal")


@query("""select user_id, event_type as dominant_type from (select user_id, event_type, sum(value::decimal(18,2)) as total from events group by all)
qualify row_number() over (partition by user_id order by total desc, event_type) = 1""")
def dominant_event_type(t):
    totals = t.events.groupBy("user_id", "event_type").agg(F.sum(exact("value")).alias("total"))
    return ranking.best_value(totals, ["user_id"], F.col("total"), "event_type", "dominant_type")


@query("select p_brand, p_partkey, p_retailprice from part qualify row_number() over (partition by p_brand order by p_retailprice desc nulls last, p_partkey) <= 3")
def topn_parts_per_brand(t):
    return ranking.top_by(t.part, ["p_brand"], [F.col("p_retailprice").desc_nulls_last(), F.asc("p_partkey")], 3).select("p_brand", "p_partkey", "p_retailprice")


@query("""select user_id, min(event_id) as first_event, count(*) as n from events group by user_id order by n desc, user_id limit 10""")
def top_keys_sorted(t):
    return t.events.groupBy("user_id").agg(F.min("event_id").alias("first_event"), F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "user_id").limit(10)


# windows over an order


@query("""select day, day_total::double as day_total, coalesce(sum(day_total) over (order by day rows between unbounded preceding and 1 preceding), 0)::double as before
from (select date_trunc('day', ts)::date::varchar as day, sum(value::decimal(18,2)) as day_total from events group by 1)""")
def running_offset_by_day(t):
    days = t.events.groupBy(F.to_date("ts").cast("string").alias("day")).agg(F.sum(exact("value")).alias("day_total"))
    return ranking.sum_before(days.withColumn("all", F.lit(1)), ["all"], [F.col("day")], "day_total", "before").select("day", F.col("day_total").cast("double").alias("day_total"), F.col("before").cast("double").alias("before"))


_SPELLS = """with e as (select date_trunc('day', ts)::date::varchar as day, user_id, event_type, event_id, (hour(ts) * 3600 + minute(ts) * 60 + second(ts))::bigint as began from events),
d as (select *, row_number() over (partition by day, user_id, began order by event_id desc) as rn from e),
ends as (select day, max(began) as day_end from e group by day),
s as (select d.day, user_id, event_type, began, coalesce(lead(began) over (partition by d.day, user_id order by began), day_end) as ended, day_end from d join ends using (day) where rn = 1)
"""


def _event_spells(t):
    at = (F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")).cast("long")
    e = t.events.select(F.to_date("ts").cast("string").alias("day"), "user_id", "event_type", "event_id", at.alias("at"))
    one = ranking.first_by(e, ["day", "user_id", "at"], [F.desc("event_id")])
    ends = e.groupBy("day").agg(F.max("at").alias("day_end"))
    return ranking.next_or(one.join(ends, "day"), ["day", "user_id"], [F.col("at")], "at", F.col("day_end"), "until")


@query(_SPELLS + "select day, user_id, event_type, began, ended, ended - began as seconds from s where ended > began and upper(event_type) <> 'ERROR'")
def event_spells(t):
    s = _event_spells(t).where((F.col("until") > F.col("at")) & (F.upper(F.coalesce("event_type", F.lit("ERROR"))) != "ERROR"))
    return s.select("day", "user_id", "event_type", F.col("at").alias("began"), F.col("until").alias("ended"), (F.col("until") - F.col("at")).alias("seconds"))


@query(_SPELLS + "select day, user_id, event_type, min(began) as first_second, max(ended) as last_second, sum(ended - began)::bigint as seconds, sum(ended - began) / nullif(max(day_end), 0)::double as share from s where ended > began group by all")
def spell_minutes_by_type(t):
    s = _event_spells(t).where("until > at").groupBy("day", "user_id", "event_type")
    out = s.agg(F.min("at").alias("first_second"), F.max("until").alias("last_second"), F.sum(F.col("until") - F.col("at")).alias("seconds"), F.max("day_end").alias("day_end"))
    return out.select("day", "user_id", "event_type", "first_second", "last_second", "seconds", scalars.safe_ratio(F.col("seconds"), F.col("day_end").cast("double")).alias("share"))


@query("""select event_id, (floor(clock / 10000) + 1)::bigint as period_id, clock % 10000 as within
from (select event_id, (hour(ts) // 12) * 10000 + (hour(ts) % 12) * 60 + minute(ts) as clock from events)""")
def bucketed_clock(t):
    clock = F.floor(F.hour("ts") / 12) * spells.PERIOD + (F.hour("ts") % 12) * 60 + F.minute("ts")
    e = t.events.select("event_id", clock.cast("long").alias("clock"))
    return e.select("event_id", spells.clock_period(F.col("clock")).alias("period_id"), spells.clock_within(F.col("clock")).alias("within"))


# participation on events: a day is a match, twelve hours are a period, users of even id play at home


def _season(t):
    """Events and line-ups in the shapes of ``spells.participation``, made from the events table."""
    clock = F.floor(F.hour("ts") / 12) * spells.PERIOD + (F.hour("ts") % 12) * 3600 + F.minute("ts") * 60 + F.second("ts")
    e = t.events.select(F.datediff(F.to_date("ts"), F.lit("2024-01-01")).cast("long").alias("match_id"), "event_id", "user_id", "event_type", clock.cast("double").alias("clock"))
    events = e.select("match_id", spells.clock_period(F.col("clock")).alias("period_id"), "clock")
    sides = []
    for side, rest in (("home", 0), ("away", 1)):
        own = e.where(F.pmod("user_id", F.lit(2)) == rest)
        first = own.groupBy("match_id", "user_id").agg(F.min_by("event_type", F.struct("clock", "event_id")).alias("position"))
        starts = first.where(F.pmod("user_id", F.lit(4)) == rest).groupBy("match_id").agg(F.sort_array(F.collect_list(F.struct(F.col("user_id").alias("playerId"), "position", F.lit("CENTRE").alias("positionSide")))).alias("starting"))
        move = F.struct("clock", "event_id", F.struct(F.col("user_id").alias("playerId"), F.struct(F.col("clock").alias("gameTimeInSec")).alias("gameTime"), F.when(F.col("event_type") == "error", spells.OFF).otherwise(F.upper("event_type")).alias("toPosition"), F.when(F.pmod("event_id", F.lit(2)) == 0, "LEFT").otherwise("RIGHT").alias("positionSide")).alias("change"))
        changes = own.groupBy("match_id").agg(F.sort_array(F.collect_list(move)).getField("change").alias("changes"))
        both = starts.join(changes, "match_id", "full").select("match_id", F.lit(10 + 10 * rest).cast("long").alias(f"{side}_squad_id"), F.coalesce("starting", F.array().cast(spells.STARTS)).cast(spells.STARTS).alias(f"{side}_starting"), F.coalesce("changes", F.array().cast(spells.CHANGES)).cast(spells.CHANGES).alias(f"{side}_changes"))
        sides.append(both)
    matches = sides[0].join(sides[1], "match_id").withColumn("iteration_id", (F.col("match_id") / 10).cast("long"))
    return events, matches


_PARTICIPATION = """with e as (select date_diff('day', date '2024-01-01', ts::date)::bigint as match_id, event_id, user_id, event_type, ((hour(ts) // 12) * 10000 + (hour(ts) % 12) * 3600 + minute(ts) * 60 + second(ts))::double as clock from events),
len as (select match_id, (floor(clock / 10000) + 1)::bigint as period_id, greatest(max(clock - floor(clock / 10000) * 10000), 0) as l from e group by 1, 2),
per as (select match_id, period_id, coalesce(sum(l) over (partition by match_id order by period_id rows between unbounded preceding and 1 preceding), 0) as s, sum(l) over (partition by match_id) as dur from len),
both_sides as (select match_id from e group by 1 having bool_or(user_id % 2 = 0) and bool_or(user_id % 2 = 1)),
starters as (select match_id, user_id % 2 as rest, user_id as player_id, event_type as position from e where user_id % 4 = user_id % 2 qualify row_number() over (partition by match_id, user_id order by clock, event_id) = 1),
moves as (select e.match_id, user_id % 2 as rest, user_id as player_id, s + clock % 10000 as began, 1 as priority, row_number() over (partition by e.match_id, user_id % 2 order by clock, event_id) as place,
  case when event_type = 'error' then 'BANK' else upper(event_type) end as position, case when event_id % 2 = 0 then 'LEFT' else 'RIGHT' end as position_side
  from e join per on per.match_id = e.match_id and per.period_id = floor(clock / 10000) + 1),
states as (select * from (select match_id, rest, player_id, 0.0 as began, 0 as priority, -1 as place, position, 'CENTRE' as position_side from starters union all select * from moves)
  qualify row_number() over (partition by match_id, rest, player_id, began order by priority desc, place desc, position) = 1),
sp as (select st.*, dur, coalesce(lead(began) over (partition by st.match_id, rest, player_id order by began, priority, place), dur) as ended from states st join (select distinct match_id, dur from per) using (match_id)),
part as (select sp.match_id, sp.match_id // 10 as iteration_id, case when rest = 0 then 'HOME' else 'AWAY' end as side, 10 + 10 * rest as squad_id, player_id, position, position_side,
  exists (select 1 from starters x where x.match_id = sp.match_id and x.player_id = sp.player_id) as started, min(began) as first_second, max(ended) as last_second, sum(ended - began) as play_duration, max(dur) as match_duration
  from sp join both_sides using (match_id) where upper(coalesce(position, 'BANK')) <> 'BANK' and ended > began group by all)
"""


@query(_PARTICIPATION + "select match_id, iteration_id, side, squad_id::bigint as squad_id, player_id, position, position_side, started, first_second::double as first_second, last_second::double as last_second, play_duration::double as play_duration, match_duration::double as match_duration, play_duration / nullif(match_duration, 0) as match_share from part")
def participation_spells(t):
    return spells.participation(*_season(t))


def _positions(t):
    events, matches = _season(t)
    # as a plan of models would: participation is a table, computed once for all that is made of it
    p = written(spells.participation(events, written(matches, "matches")), "participation").withColumnsRenamed({"match_id": "fixture_id", "iteration_id": "season_id"})
    return written(spells.by_position(p.where("play_duration > 0")), "positions")


_POSITIONS = _PARTICIPATION + """, pos as (select match_id as fixture_id, iteration_id as season_id, squad_id::bigint as squad_id, player_id, position, bool_or(started) as started, min(first_second)::double as first_second, max(last_second)::double as last_second, sum(play_duration)::double as play_duration, max(match_duration)::double as match_duration from part group by all)
"""


@query(_POSITIONS + "select * from pos")
def participation_by_position(t):
    return _positions(t)


@query(_POSITIONS + """select player_id, fixture_id, squad_id, season_id, bool_or(started) as started, sum(play_duration) as play_duration, max(match_duration) as match_duration,
arg_min(position, struct_pack(d := -play_duration, p := position)) as dominant_position, sum(play_duration) / nullif(max(match_duration), 0) as match_share from pos group by all""")
def participation_by_fixture(t):
    return spells.by_fixture(_positions(t))


@query(_POSITIONS + """, f as (select player_id, season_id, fixture_id, max(started::int) as s, sum(play_duration) as d from pos group by all), m as (select player_id, season_id, position, sum(play_duration) as d from pos group by all)
select player_id, season_id, appearances, starts, play_duration, dominant_position
from (select player_id, season_id, count(*) as appearances, sum(s)::bigint as starts, sum(d) as play_duration from f group by all)
join (select player_id, season_id, arg_min(position, struct_pack(d := -d, p := position)) as dominant_position from m group by all) using (player_id, season_id)""")
def participation_by_season(t):
    return spells.by_season(_positions(t))


# aggregates


@query("""select l_suppkey, year(l_shipdate)::int as season, sum(l_extendedprice::decimal(18,2))::double as total, sum(l_extendedprice::decimal(18,2))::double / count(l_extendedprice) as average,
count(distinct l_orderkey) as orders, sum(l_quantity::decimal(18,2))::double as quantity from lineitem group by all""")
def season_rollup(t):
    price = exact("l_extendedprice")
    return t.lineitem.groupBy("l_suppkey", F.year("l_shipdate").alias("season")).agg(
        F.sum(price).cast("double").alias("total"), (F.sum(price).cast("double") / F.count("l_extendedprice")).alias("average"), F.count_distinct("l_orderkey").alias("orders"), F.sum(exact("l_quantity")).cast("double").alias("quantity")
    )


@query("""select o_custkey, count(*) as appearances, sum(started)::bigint as starts, sum(lines)::bigint as lines from (
select o_custkey, o_orderkey, count(*) as lines, max((l_linenumber = 1)::int) as started from orders join lineitem on l_orderkey = o_orderkey group by all) group by all""")
def two_level_appearances(t):
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("lines"), F.max((F.col("l_linenumber") == 1).cast("int")).alias("started"))
    return t.orders.join(lines, "o_orderkey").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("appearances"), F.sum("started").alias("starts"), F.sum("lines").alias("lines"))


@query("select l_orderkey, bool_or(l_returnflag = 'R') as any_returned, max(case when l_shipdate is not null then 1 else 0 end)::int as shipped from lineitem group by all")
def bool_or_agg(t):
    return t.lineitem.groupBy("l_orderkey").agg(F.bool_or(F.col("l_returnflag") == "R").alias("any_returned"), F.max(F.when(F.col("l_shipdate").isNotNull(), 1).otherwise(0)).alias("shipped"))


@query("select count_if(o_orderstatus = 'O')::bigint as open, count_if(o_orderstatus = 'F')::bigint as filled, count_if(o_orderstatus = 'P')::bigint as pending, count_if(o_totalprice > 250000)::bigint as large, count(*) as n from orders")
def conditional_counts(t):
    status = lambda s: F.count_if(F.col("o_orderstatus") == s)
    return t.orders.agg(status("O").alias("open"), status("F").alias("filled"), status("P").alias("pending"), F.count_if(F.col("o_totalprice") > 250000).alias("large"), F.count(F.lit(1)).alias("n"))


@query("""with d as (select p_brand, abs(l_extendedprice - l_quantity * p_retailprice)::decimal(18,2)::double as delta from lineitem join part on p_partkey = l_partkey)
select p_brand, round(median(delta), 4) as median, round(quantile_cont(delta, 0.95), 4) as p95, max(delta) as largest from d group by all""")
def delta_quantiles(t):
    d = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select("p_brand", F.abs(F.col("l_extendedprice") - F.col("l_quantity") * F.col("p_retailprice")).cast("decimal(18,2)").cast("double").alias("delta"))
    found = ranking.exact_quantiles(d, ["p_brand"], "delta", {"median": 0.5, "p95": 0.95, "largest": 1.0})
    return found.select("p_brand", F.round("median", 4).alias("median"), F.round("p95", 4).alias("p95"), "largest")


@query("select l_orderkey, l_linenumber, count(*) as n from lineitem group by all having count(*) > 1")
def duplicate_finder(t):
    return quality.not_unique(t.lineitem.select("l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"])


@query("select o_orderstatus as outcome, count(*) as n, max(o_orderdate) as newest from orders group by all")
def outcome_counts(t):
    return t.orders.groupBy(F.col("o_orderstatus").alias("outcome")).agg(F.count(F.lit(1)).alias("n"), F.max("o_orderdate").alias("newest"))


# joins


def _identities(t):
    return t.orders.select(F.lit("A").alias("source_system"), (F.col("o_custkey") % 700).cast("string").alias("source_id"), F.col("o_custkey").alias("canonical_id"), (F.col("o_orderpriority") == "1-URGENT").alias("is_primary"), F.when(F.col("o_totalprice") > 50000, F.floor(F.col("o_totalprice") / 100000)).alias("confidence"), F.col("o_orderdate").alias("updated_at"))


_BRIDGE = """with i as (select 'A' as source_system, (o_custkey % 700)::varchar as source_id, o_custkey as canonical_id, o_orderpriority = '1-URGENT' as is_primary, case when o_totalprice > 50000 then floor(o_totalprice / 100000) end as confidence, o_orderdate as updated_at from orders),
best as (select * from i qualify row_number() over (partition by source_system, source_id order by case when is_primary then 0 else 1 end, confidence desc nulls last, updated_at desc nulls last, canonical_id) = 1),
o as (select 'A' as source_system, c_custkey::varchar as source_id, c_custkey + 1000000 as canonical_id from customer where c_custkey % 7 = 0)
"""


@query(_BRIDGE + "select coalesce(o.source_system, best.source_system) as source_system, coalesce(o.source_id, best.source_id) as source_id, coalesce(o.canonical_id, best.canonical_id) as canonical_id, case when o.canonical_id is not null then 'OVERRIDE' else 'IDENTITY' end as resolution_source from o full join best on o.source_system = best.source_system and o.source_id = best.source_id where coalesce(o.canonical_id, best.canonical_id) is not null")
def override_bridge(t):
    overrides = t.customer.where("c_custkey % 7 = 0").select(F.lit("A").alias("source_system"), F.col("c_custkey").cast("string").alias("source_id"), (F.col("c_custkey") + 1000000).alias("canonical_id"))
    return bridge.resolutions(_identities(t), overrides, ["source_system", "source_id"])


@query(_BRIDGE + "select o.o_orderkey, best.canonical_id, s.s_name from orders o join best on best.source_id = (o.o_custkey % 700)::varchar and best.source_system = 'A' left join supplier s on s.s_suppkey = best.canonical_id")
def text_key_join(t):
    best = bridge.best_identities(_identities(t), ["source_system", "source_id"]).where("source_system = 'A'").select("source_id", "canonical_id")
    o = t.orders.select("o_orderkey", (F.col("o_custkey") % 700).cast("string").alias("source_id"))
    return o.join(best, "source_id").join(t.supplier, F.col("s_suppkey") == F.col("canonical_id"), "left").select("o_orderkey", "canonical_id", "s_name")


@query("""select o_orderkey, c_name || ' vs ' || h.n_name as fixture_name, h.n_name as home, a.n_name as away, r_name, case when s.s_suppkey is not null then 'external' else 'internal' end as data_source, coalesce(s.s_name, c_name) as manager
from orders left join customer on c_custkey = o_custkey left join nation h on h.n_nationkey = c_nationkey left join nation a on a.n_nationkey = (c_nationkey + 1) % 25 left join region on r_regionkey = h.n_regionkey left join supplier s on s.s_suppkey = o_custkey""")
def fixture_denormal(t):
    home, away = (t.nation.select(F.col("n_nationkey").alias(f"{s}_key"), F.col("n_name").alias(s), F.col("n_regionkey").alias(f"{s}_region")) for s in ("home", "away"))
    o = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left").join(home, F.col("home_key") == F.col("c_nationkey"), "left").join(away, F.col("away_key") == (F.col("c_nationkey") + 1) % 25, "left")
    o = o.join(t.region, F.col("r_regionkey") == F.col("home_region"), "left").join(t.supplier, F.col("s_suppkey") == F.col("o_custkey"), "left")
    return o.select("o_orderkey", scalars.versus(F.col("c_name"), F.col("home")).alias("fixture_name"), "home", "away", "r_name", F.when(F.col("s_suppkey").isNotNull(), "external").otherwise("internal").alias("data_source"), F.coalesce("s_name", "c_name").alias("manager"))


@query("select c_custkey, c_name from customer where not exists (select 1 from orders where o_custkey = c_custkey and o_totalprice > 400000)")
def anti_not_exists(t):
    return merge.missing(t.customer, t.orders.where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"]).select("c_custkey", "c_name")


@query("select doc_id, quality from labels where doc_id is not null and not exists (select 1 from documents d where d.doc_id = labels.doc_id and d.lang = 'en')")
def orphan_check(t):
    return quality.orphans(t.labels, "doc_id", t.documents.where("lang = 'en'"), "doc_id").select("doc_id", "quality")


@query("select o_orderkey, o_custkey from orders where o_custkey in (select c_custkey from customer where c_acctbal > 9000) and o_orderstatus in ('O', 'P')")
def semi_in(t):
    return t.orders.where(F.col("o_orderstatus").isin("O", "P")).join(t.customer.where("c_acctbal > 9000"), F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("o_orderkey", "o_custkey")


@query("select coalesce(a.n, b.n) as nationkey, coalesce(customers, 0) as customers, coalesce(suppliers, 0) as suppliers from (select c_nationkey as n, count(*) as customers from customer where c_acctbal > 9900 group by 1) a full join (select s_nationkey as n, count(*) as suppliers from supplier where s_acctbal > 9000 group by 1) b on a.n = b.n")
def full_outer_reconcile(t):
    a = t.customer.where("c_acctbal > 9900").groupBy(F.col("c_nationkey").alias("nationkey")).agg(F.count(F.lit(1)).alias("customers"))
    b = t.supplier.where("s_acctbal > 9000").groupBy(F.col("s_nationkey").alias("nationkey")).agg(F.count(F.lit(1)).alias("suppliers"))
    return a.join(b, "nationkey", "full").select("nationkey", F.coalesce("customers", F.lit(0)).alias("customers"), F.coalesce("suppliers", F.lit(0)).alias("suppliers"))


@query("with c as (select c_custkey, nullif(c_nationkey, 0) as k from customer), s as (select nullif(s_nationkey, 0) as k, count(*) as n from supplier group by 1) select c_custkey, n from c join s on c.k is not distinct from s.k")
def nullsafe_join(t):
    c = t.customer.select("c_custkey", F.nullif("c_nationkey", F.lit(0)).alias("k"))
    s = t.supplier.groupBy(F.nullif("s_nationkey", F.lit(0)).alias("k2")).agg(F.count(F.lit(1)).alias("n"))
    return c.join(s, F.col("k").eqNullSafe(F.col("k2"))).select("c_custkey", "n")


@query("select e.event_id, p.n as member from events e left join (select distinct user_id, 1 as n from events where event_type = 'purchase') p using (user_id)")
def membership_flag(t):
    buyers = t.events.where("event_type = 'purchase'").select("user_id", F.lit(1).alias("member")).distinct()
    return t.events.join(buyers, "user_id", "left").select("event_id", "member")


# set operations


@query("select o_orderkey as match_id, o_custkey as squad_id, 'HOME' as side from orders union all select o_orderkey, o_custkey + 1, 'AWAY' from orders")
def union_long_sides(t):
    o = t.orders.select("o_orderkey", "o_custkey", (F.col("o_custkey") + 1).alias("other"))
    return flatten.both_sides(o, {"HOME": {"match_id": "o_orderkey", "squad_id": "o_custkey"}, "AWAY": {"match_id": "o_orderkey", "squad_id": "other"}})


@query("select s_suppkey as id, s_name as name, s_acctbal as balance, 'base' as origin from supplier union all select c_custkey, null, null, 'tail' from customer where c_custkey not in (select s_suppkey from supplier)")
def snapshot_plus_tail(t):
    base = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"), F.lit("base").alias("origin"))
    tail = merge.missing(t.customer.select(F.col("c_custkey").alias("id")), base, ["id"])
    return base.unionByName(tail.select("id", F.lit(None).cast("string").alias("name"), F.lit(None).cast("double").alias("balance"), F.lit("tail").alias("origin")))


@query("select c_nationkey as nationkey from customer union select s_nationkey from supplier")
def union_distinct(t):
    return t.customer.select(F.col("c_nationkey").alias("nationkey")).union(t.supplier.select("s_nationkey")).distinct()


@query("select 'orders' as what, count(*) as n from orders union all select 'customers', count(*) from customer union all select 'orphans', count(*) from orders where o_custkey not in (select c_custkey from customer)")
def metric_rows(t):
    one = lambda what, df: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(what).alias("what"), "n")
    return one("orders", t.orders).unionByName(one("customers", t.customer)).unionByName(one("orphans", quality.orphans(t.orders, "o_custkey", t.customer, "c_custkey")))


# merges


def _changes(t):
    """A tenth of the orders with other values, and as many new ones."""
    old = t.orders.where("o_orderkey % 10 = 3")
    return old.withColumn("o_totalprice", F.col("o_totalprice") + 1).unionByName(old.withColumn("o_orderkey", F.col("o_orderkey") + 10000000)).select("o_orderkey", "o_custkey", "o_totalprice", F.lit("N").alias("o_orderstatus"))


def _target(t):
    return t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")


_MERGE = "with old as (select o_orderkey, o_custkey, o_totalprice, o_orderstatus from orders), part as (select * from old where o_orderkey % 10 = 3), new as (select o_orderkey, o_custkey, o_totalprice + 1 as o_totalprice, 'N' as o_orderstatus from part union all select o_orderkey + 10000000, o_custkey, o_totalprice, 'N' from part)\n"


@query(_MERGE + "select * from old where o_orderkey not in (select o_orderkey from new) union all select * from new")
def upsert_orders(t):
    return merge.upsert(_target(t), _changes(t), ["o_orderkey"])


@query(_MERGE + "select * from old union all select * from new where o_orderkey not in (select o_orderkey from old)")
def insert_only(t):
    return merge.insert_only(_target(t), _changes(t), ["o_orderkey"])


@query(_MERGE + "select o_orderkey, old.o_custkey, case when new.o_orderkey is not null then new.o_totalprice else old.o_totalprice end as o_totalprice, old.o_orderstatus from old left join new using (o_orderkey)")
def update_only(t):
    return merge.update_only(_target(t), _changes(t), ["o_orderkey"], ["o_totalprice"])


@query(_MERGE + "select * from old where o_custkey not in (select o_custkey from new) union all select * from new")
def replace_slice(t):
    return merge.replace_keys(_target(t), _changes(t), ["o_custkey"])


@query(_MERGE + "select * from old where o_orderkey not in (select o_orderkey from new)")
def delete_by_key(t):
    return merge.delete_keys(_target(t), _changes(t), ["o_orderkey"])


@query(_MERGE + "select coalesce(old.o_orderkey, new.o_orderkey) as o_orderkey, coalesce(old.o_custkey, new.o_custkey) as o_custkey, case when new.o_orderkey is null then old.o_totalprice when old.o_orderkey is null then new.o_totalprice when old.o_orderstatus = 'F' then new.o_totalprice else old.o_totalprice end as o_totalprice, case when old.o_orderkey is null then 'PENDING' else old.o_orderstatus end as o_orderstatus from old full join new on old.o_orderkey = new.o_orderkey")
def merge_keeping_status(t):
    price = F.when(F.col("old.o_orderstatus") == "F", F.col("new.o_totalprice")).otherwise(F.col("old.o_totalprice"))
    return merge.merge(_target(t), _changes(t), ["o_orderkey"], matched={"o_totalprice": price}, inserted={"o_orderstatus": F.lit("PENDING")})


@query("""with target as (select o_orderkey, o_orderdate, o_totalprice from orders where o_orderdate < timestamp '2001-06-01'), src as (select o_orderkey, o_orderdate, o_totalprice * 2 as o_totalprice from orders where o_orderdate >= (select coalesce(max(o_orderdate), timestamp '1900-01-01') from target) - interval 7 day)
select * from target where o_orderkey not in (select o_orderkey from src) union all select * from src""")
def incremental_lookback(t):
    target = t.orders.where("o_orderdate < timestamp_ntz '2001-06-01 00:00:00'").select("o_orderkey", "o_orderdate", "o_totalprice")
    source = t.orders.select("o_orderkey", "o_orderdate", "o_totalprice")
    return incremental.reprocess(source, target, "o_orderdate", ["o_orderkey"], 7, lambda df: df.withColumn("o_totalprice", F.col("o_totalprice") * 2))


@query("select n.o_orderkey, n.p, n.d from (select o_orderkey, case when o_orderkey % 5 = 0 then null else o_totalprice end as p, o_orderdate as d from orders) n left join (select o_orderkey, case when o_orderkey % 3 = 0 then null else o_totalprice end as p, o_orderdate as d from orders where o_orderkey % 11 <> 0) s using (o_orderkey) where s.o_orderkey is null or n.p is distinct from s.p or n.d is distinct from s.d")
def change_detect(t):
    version = lambda n: t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % n != 0, F.col("o_totalprice")).alias("p"), F.col("o_orderdate").alias("d"))
    return merge.changed(version(5), version(3).where("o_orderkey % 11 <> 0"), ["o_orderkey"], ["p", "d"])


# queue


def _queue(t):
    """Orders as queue entries at a fixed time."""
    status = F.when(F.col("o_orderstatus") == "F", queue.SUCCESS).when(F.col("o_orderstatus") == "O", queue.PENDING).otherwise(queue.FAILED)
    return t.orders.select(
        F.col("o_orderkey").alias("match_id"), F.col("o_orderdate").alias("scheduled_at"), status.alias("status"), (F.col("o_orderkey") % 5).cast("int").alias("attempt_count"),
        F.when(F.col("o_orderkey") % 4 == 0, F.col("o_orderdate") + F.make_dt_interval(F.lit(1000))).alias("next_attempt_at"), F.lit(None).cast("string").alias("claimed_by"), F.lit(None).cast("timestamp_ntz").alias("claimed_at"),
        F.lit(None).cast("long").alias("event_count"), F.lit(None).cast("string").alias("last_error"), F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate")).alias("completed_at"), F.col("o_orderpriority").alias("stage"),
    )


_NOW = "timestamp '2000-01-01 00:00:00'"
_QUEUE = "with q as (select o_orderkey as match_id, o_orderdate as scheduled_at, case o_orderstatus when 'F' then 'SUCCESS' when 'O' then 'PENDING' else 'FAILED' end as status, o_orderkey % 5 as attempt_count, case when o_orderkey % 4 = 0 then o_orderdate + interval 1000 day end as next_attempt_at, case when o_orderstatus = 'F' then o_orderdate end as completed_at, o_orderpriority as stage from orders)\n"


def _now():
    return F.expr("timestamp_ntz '2000-01-01 00:00:00'")


@query(_QUEUE + f"select match_id, scheduled_at from q where status in ('PENDING', 'FAILED') and (next_attempt_at is null or next_attempt_at <= {_NOW}) and attempt_count < 4 and match_id % 4 = 1 order by scheduled_at nulls first, match_id limit 25")
def claim_batch(t):
    return queue.next_batch(_queue(t), _now(), 25, 4, lane=(1, 4)).select("match_id", "scheduled_at")


@query(_QUEUE + f""", c as (select match_id from q where status in ('PENDING', 'FAILED') and (next_attempt_at is null or next_attempt_at <= {_NOW}) and attempt_count < 4 order by scheduled_at nulls first, match_id limit 100)
select q.match_id, case when c.match_id is not null then 'RUNNING' else status end as status, attempt_count::int + (c.match_id is not null)::int as attempt_count, case when c.match_id is not null then 'w1' end as claimed_by from q left join c using (match_id)""")
def claim_applied(t):
    return queue.claimed(_queue(t), _now(), "w1", 100, 4).select("match_id", "status", "attempt_count", "claimed_by")


@query(_QUEUE + f"""select stage, count_if(status = 'PENDING' and (next_attempt_at is null or next_attempt_at <= {_NOW}) and attempt_count < 4)::bigint as pending, 0::bigint as running, count_if(status = 'FAILED' and (next_attempt_at is null or next_attempt_at <= {_NOW}) and attempt_count < 4)::bigint as retryable,
count_if(status in ('PENDING', 'FAILED') and attempt_count < 4 and next_attempt_at > {_NOW})::bigint as deferred, count_if(status in ('PENDING', 'FAILED') and attempt_count >= 4)::bigint as exhausted, count_if(status = 'SUCCESS')::bigint as loaded, 0::bigint as no_data, max(completed_at) as last_completed, 'in_progress' as stage_status from q group by all""")
def queue_classify(t):
    return queue.counts(_queue(t), _now(), 4, ["stage"]).withColumn("stage_status", queue.stage_status())


@query("select o_orderkey, o_orderkey % 4 as lane from orders where o_orderkey % 4 = 1")
def mod_shard(t):
    lane = F.pmod("o_orderkey", F.lit(4))
    return t.orders.where(lane == 1).select("o_orderkey", lane.alias("lane"))


# nested data


@query("select event_id, (props->>'$.k')::bigint as k, json_valid(props) as valid from events")
def json_props(t):
    parsed = F.from_json("props", "k bigint")
    return t.events.select("event_id", parsed["k"].alias("k"), parsed.isNotNull().alias("valid"))


@query("select event_id, (props->>'$.k')::double as k, null::bigint as missing from events")
def variant_path(t):
    v = t.events.select("event_id", scalars.json_or_null("props").alias("v"))
    return v.select("event_id", scalars.at_path("v", "$.k", "double").alias("k"), scalars.at_path("v", "$.other.k", "bigint").alias("missing"))


@query("select label, i as place, round(sum(x::decimal(18,6))::double, 6) as total from (select label, unnest(embedding) as x, generate_subscripts(embedding, 1) - 1 as i from embeddings) group by all")
def explode_embeddings(t):
    rows = flatten.explode_rows(t.embeddings, "embedding", "x", keep=["label"], position="place")
    return rows.groupBy("label", F.col("place").cast("long").alias("place")).agg(F.round(F.sum(exact("x", 6)).cast("double"), 6).alias("total"))


@query("select vec_id, generate_subscripts(embedding, 1) - 1 as place, unnest(embedding) as x from embeddings")
def posexplode_order(t):
    return flatten.explode_rows(t.embeddings, "embedding", "x", keep=["vec_id"], position="place").select("vec_id", F.col("place").cast("long").alias("place"), "x")


@query("select d.doc_id, l.q from (select doc_id from documents) d left join (select doc_id, unnest(case when toxic = 1 then [quality, -1] else [quality] end) as q from labels) l using (doc_id)")
def explode_outer_left(t):
    lists = t.labels.select("doc_id", F.when(F.col("toxic") == 1, F.array("quality", F.lit(-1))).otherwise(F.array("quality")).alias("list"))
    return flatten.explode_rows(t.documents.select("doc_id").join(lists, "doc_id", "left"), "list", "q", keep=["doc_id"], outer=True)


@query("select user_id, (sum(value::decimal(18,2)) filter (where event_type = 'click'))::double as clicks, (sum(value::decimal(18,2)) filter (where event_type = 'purchase'))::double as purchases from events group by all")
def map_pivot(t):
    sums = t.events.groupBy("user_id", "event_type").agg(F.sum(exact("value")).cast("double").alias("s")).withColumn("place", F.lit(0))
    m = flatten.named_values(sums, ["user_id"], F.col("event_type"), "s", "place", "by_type")
    return m.select("user_id", F.try_element_at("by_type", F.lit("click")).alias("clicks"), F.try_element_at("by_type", F.lit("purchase")).alias("purchases"))


@query("select user_id, count(distinct event_type) as entries, min(event_type) as first_type, max(event_type) as last_type from events group by all")
def attached_lists(t):
    names = t.events.select(F.crc32(F.col("event_type").cast("binary")).alias("id"), F.col("event_type").alias("name")).distinct()
    values = t.events.select("user_id", "event_type", F.crc32(F.col("event_type").cast("binary")).alias("kpi_id"), "value", "event_id")
    lists = flatten.attach_named_values(values, names, "user_id", ["event_type"], "kpi_id", "value", "event_id", "kpi_")
    return lists.select("user_id", F.size("entries").cast("long").alias("entries"), F.element_at("entries", 1)["event_type"].alias("first_type"), F.element_at("entries", -1)["event_type"].alias("last_type"))


@query("select c_custkey, c_name, n_name from customer join nation on n_nationkey = c_nationkey")
def flattened_struct(t):
    nested = t.customer.join(t.nation, F.col("n_nationkey") == F.col("c_nationkey")).select("c_custkey", F.struct(F.col("c_name").alias("name"), F.struct(F.col("n_name").alias("name")).alias("nation")).alias("customer"))
    return flatten.flatten_structs(nested).select("c_custkey", F.col("`customer.name`").alias("c_name"), F.col("`customer.nation.name`").alias("n_name"))


# identity


_NAMES = """with x as (select s_suppkey::varchar as source_id, regexp_replace(lower(strip_accents(replace(s_name, 'Supplier', 'Cústomer'))), '[^a-z0-9]', '', 'g') as k, nullif(s_nationkey, 3) % 2 as b from supplier),
c as (select c_custkey as id, regexp_replace(lower(strip_accents(c_name)), '[^a-z0-9]', '', 'g') as k, nullif(c_nationkey, 3) % 2 as b from customer union all select c_custkey + 50000, regexp_replace(lower(strip_accents(c_name)), '[^a-z0-9]', '', 'g'), nullif(c_nationkey, 3) % 2 from customer where c_custkey % 3 = 0),
g as (select k, b, list(id order by id) as ids from c group by all), o as (select s_suppkey::varchar as source_id, s_suppkey + 900000 as given from supplier where s_suppkey % 17 = 0),
r as (select x.source_id, coalesce(len(ids), 0) as n, ids, given from x left join g on x.k = g.k and x.b is not distinct from g.b left join o using (source_id))
"""


def _classified(t):
    name, born = F.replace("s_name", F.lit("Supplier"), F.lit("Cústomer")), lambda c: F.nullif(c, F.lit(3)) % 2
    x = t.supplier.select(F.col("s_suppkey").cast("string").alias("source_id"), name.alias("name"), born("s_nationkey").alias("birth_date"))
    c = t.customer.select(F.col("c_custkey").alias("canonical_id"), F.col("c_name").alias("name"), born("c_nationkey").alias("birth_date"))
    c = c.unionByName(c.where("canonical_id % 3 = 0").withColumn("canonical_id", F.col("canonical_id") + 50000))
    overrides = t.supplier.where("s_suppkey % 17 = 0").select(F.col("s_suppkey").cast("string").alias("source_id"), (F.col("s_suppkey") + 900000).alias("canonical_id"))
    return identity.classified(x, c, overrides)


@query(_NAMES + "select source_id, case when given is not null then 'OVERRIDE' when n > 1 then 'AMBIGUOUS' when n = 1 then 'LINK' else 'MINT' end as outcome, coalesce(given, case when n = 1 then ids[1] end) as canonical_id, case when given is null and n > 1 then array_to_string(ids, ',') end as candidates from r")
def name_match_classify(t):
    return _classified(t).select("source_id", "outcome", "canonical_id", F.array_join("candidates", ",").alias("candidates"))


@query(_NAMES + "select 'S' as source_system, source_id, unnest(ids) as candidate_id, 'PENDING' as status from r where given is null and n > 1")
def candidate_queue(t):
    empty = t.spark.createDataFrame([], "source_system string, source_id string, candidate_id long, status string")
    return identity.queued_candidates(_classified(t).where("outcome = 'AMBIGUOUS'"), empty, "S")


@query("select o_orderkey, (select max(c_custkey) from customer) + row_number() over (order by o_orderkey) as canonical_id from orders where o_orderstatus = 'P'")
def minted_ids(t):
    return identity.minted(t.orders.where("o_orderstatus = 'P'").select("o_orderkey"), t.customer.select("c_custkey"), "o_orderkey")


@query("select p_partkey, lower(strip_accents(replace(p_name, 'r', 'ř'))) as plain, regexp_replace(lower(strip_accents(replace(p_name, 'r', 'ř'))), '[^a-z0-9]', '', 'g') as name, string_split(trim(p_name), ' ')[1] as first_name from part")
def normalize_text(t):
    name = F.replace("p_name", F.lit("r"), F.lit("ř"))
    return t.part.select("p_partkey", text.normalize_text(name).alias("plain"), text.normalize_name(name).alias("name"), text.first_name(F.col("p_name")).alias("first_name"))


# plans, discovery, scalars


@query("select r_name, (n_nationkey % 3)::int as season_block, string_agg(n_nationkey::varchar, ',' order by n_nationkey) as ids, count(*) as matches, sum(n_nationkey)::bigint as todo from nation left join region on r_regionkey = n_regionkey group by all")
def stage_plan(t):
    cells = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left").groupBy("r_name", (F.col("n_nationkey") % 3).alias("season_block"))
    return cells.agg(F.array_join(F.sort_array(F.collect_set("n_nationkey")), ",").alias("ids"), F.count(F.lit(1)).alias("matches"), F.sum("n_nationkey").alias("todo"))


@query("""with recursive e as (select distinct c_nationkey as a, 1000 + o_orderkey % 50 as b from customer join orders on o_custkey = c_custkey where o_totalprice > 480000), u as (select a, b from e union select b, a from e),
r(node, level) as (select 1, 0 union select u.b, r.level + 1 from r join u on u.a = r.node where r.level < 8)
select node::bigint as node, min(level)::int as level from r group by node""")
def bfs_discovery(t):
    edges = t.customer.join(t.orders.where("o_totalprice > 480000"), F.col("o_custkey") == F.col("c_custkey")).select(F.col("c_nationkey").cast("long").alias("a"), (1000 + F.col("o_orderkey") % 50).cast("long").alias("b")).distinct()
    return discovery.reachable(edges, t.spark.createDataFrame([(1,)], "node long"))


@query("select p_partkey, try_cast(p_name as timestamp) as ts, try_cast(p_size::varchar as bigint) as n, case when p_size > 40 then null else p_size / 1.0 end::bigint as id, try_cast(substr(p_name, 1, 3) as date) as born, p_type = 'ECONOMY' as flag from part")
def tolerant_parse(t):
    p = t.part.select("*", F.col("p_size").cast("string").alias("size_text"), F.substring("p_name", 1, 3).alias("short"), F.when(F.col("p_size") > 40, F.lit(float("nan"))).otherwise(F.col("p_size").cast("double")).alias("loose"))
    return p.select("p_partkey", scalars.timestamp_or_null("p_name").alias("ts"), scalars.integer_or_null("size_text").alias("n"), scalars.id_of_float(F.col("loose")).alias("id"), scalars.date_or_null("short").alias("born"), scalars.is_truthy(F.when(F.col("p_type") == "ECONOMY", " True ").otherwise("no")).alias("flag"))


@query("select p_partkey, p_brand, null::bigint as squad_id, null::varchar as note, 'A' as source_system, coalesce(p_size > 10, true) as is_active from part where coalesce(p_size <> 7, true)")
def typed_nulls(t):
    return t.part.where(F.coalesce(F.col("p_size") != 7, F.lit(True))).select("p_partkey", "p_brand", F.lit(None).cast("long").alias("squad_id"), F.lit(None).cast("string").alias("note"), F.lit("A").alias("source_system"), F.coalesce(F.col("p_size") > 10, F.lit(True)).alias("is_active"))


@query("select max(ts) as newest, 'pass' as status from events")
def source_freshness(t):
    return quality.freshness(t.events, "ts", F.expr("timestamp_ntz '2024-01-31 12:00:00'"), 24, 72)


@query("select coalesce(a.k, b.k) as k, a.n as left_n, b.n as right_n from (select o_custkey as k, count(*) as n from orders group by 1) a full join (select o_custkey as k, count(*) as n from orders where o_totalprice > 100000 group by 1) b on a.k = b.k where a.n is distinct from b.n")
def reconciliation(t):
    a = t.orders.groupBy(F.col("o_custkey").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    b = t.orders.where("o_totalprice > 100000").groupBy(F.col("o_custkey").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    return quality.reconciled(a, b, ["k"], ["n"])


@query("select date_trunc('day', ts)::date::varchar as day, event_type, count(*) as n, sum(value::decimal(18,2))::double as total from events group by all")
def stream_daily_counts(t):
    """The events as a file stream, counted by day in batches that are upserted into a table; the table is returned."""
    import uuid

    from fieldspark.operators.ranking import first_by
    from fieldspark.sources.sinks import exists, swap
    from fieldspark.streaming.upserts import file_stream, start

    spark = t.spark
    where = f"{shared_dir(spark)}/stream-{spark.sparkContext.applicationId}-{uuid.uuid4().hex}"

    def add(batch: DataFrame, n: int) -> None:
        days = batch.groupBy(F.to_date("ts").cast("string").alias("day"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(exact("value")).cast("double").alias("total")).withColumn("batch", F.lit(n))
        if exists(spark, f"{where}/table"):
            old = spark.read.parquet(f"{where}/table")
            if not old.where(F.col("batch") == n).isEmpty():
                return  # the batch was counted before it failed to commit
            days = first_by(days.unionByName(old), ["day", "event_type", "batch"], [F.desc("n")])
        swap(days, f"{where}/table")

    start(file_stream(spark, t.root, "events.parquet", t.events.schema), add, f"{where}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{where}/table").groupBy("day", "event_type").agg(F.sum("n").alias("n"), F.sum("total").cast("double").alias("total"))
