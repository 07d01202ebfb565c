"""Participation: from a bucketed match clock, starting line-ups and changes to spells in a position, and their minutes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fieldspark.operators.ranking import first_by, next_or, sum_before

#: Fixed value: a clock reads (period - 1) * PERIOD + seconds within the period.
PERIOD = 10_000
#: Fixed value: the position of players who are off the field.
OFF = "BANK"
#: Shapes of line-ups and changes.
STARTS = "array<struct<playerId:bigint,position:string,positionSide:string>>"
CHANGES = "array<struct<playerId:bigint,gameTime:struct<gameTimeInSec:double>,toPosition:string,positionSide:string>>"


def clock_period(clock):
    return (F.floor(clock / PERIOD) + 1).cast("long")


def clock_within(clock):
    return clock % PERIOD


def period_offsets(events: DataFrame) -> DataFrame:
    """(match_id, period_id, period_length, period_start, match_duration) from events (match_id, period_id, clock)."""
    reached = F.max(F.col("clock") - (F.col("period_id") - 1) * PERIOD)
    lengths = events.where("period_id is not null and clock is not null").groupBy("match_id", "period_id").agg(F.greatest(reached, F.lit(0.0)).alias("period_length"))
    starts = sum_before(lengths, ["match_id"], [F.col("period_id")], "period_length", "period_start")
    return starts.withColumn("match_duration", F.sum("period_length").over(Window.partitionBy("match_id")))


def participation(events: DataFrame, matches: DataFrame) -> DataFrame:
    """One row per (match, side, squad, player, position, position side) with seconds and share of the match.

    ``matches``: match_id, iteration_id and for home and away squad_id, starting (``STARTS``) and changes (``CHANGES``)
    as ``home_*`` and ``away_*``. A change in a period without events is dropped, and so is every player of a match
    without events; a spell in OFF, without a position or without length is dropped; each row of a player in the
    starting line-up is marked as started. Later array entries win at one time, and changes win over the line-up.
    """
    periods = period_offsets(events).groupBy("match_id").agg(F.map_from_entries(F.collect_list(F.struct("period_id", "period_start"))).alias("begins"), F.max("match_duration").alias("match_duration"))
    # from here on all is done match by match: one shuffle on the match serves the join, the windows and the sums
    known = matches.join(periods, "match_id")
    player = ["match_id", "squad_id", "player_id"]
    who = ["match_id", "iteration_id", "side", "squad_id"]
    side = lambda s: F.struct(F.lit(s.upper()).alias("side"), F.col(f"{s}_squad_id").alias("squad_id"), _states(F.col(f"{s}_starting"), F.col(f"{s}_changes")).alias("states"))
    sides = known.select("match_id", "iteration_id", "match_duration", F.explode(F.array(side("home"), side("away"))).alias("s")).select("match_id", "iteration_id", "match_duration", "s.*")
    states = sides.select(*who, "match_duration", F.explode("states").alias("s")).select(*who, "match_duration", "s.*").where("player_id is not null and at is not null")
    states = states.withColumn("started", F.max(F.col("priority") == 0).over(Window.partitionBy(*player)))
    states = first_by(states, [*player, "at"], [F.desc("priority"), F.desc("place"), F.col("position").asc_nulls_last()])
    spells = next_or(states, player, [F.col("at"), F.col("priority"), F.col("place")], "at", F.col("match_duration"), "until")
    spells = spells.where((F.upper(F.coalesce("position", F.lit(OFF))) != OFF) & (F.col("until") > F.col("at")))
    total = spells.groupBy(*who, "player_id", "position", "position_side").agg(
        F.max("started").alias("started"), F.min("at").alias("first_second"), F.max("until").alias("last_second"), F.sum(F.col("until") - F.col("at")).alias("play_duration"), F.max("match_duration").alias("match_duration")
    )
    return total.withColumn("match_share", F.col("play_duration") / F.nullif("match_duration", F.lit(0.0)))


def _states(starting, changes):
    """The positions that a side's players take, as an array: of the line-up at 0, then of the changes at their seconds into
    the match (null for a change without a clock, or in a period that has no events)."""
    state = lambda who, at, priority, place, position, side: F.struct(who.alias("player_id"), at.alias("at"), F.lit(priority).alias("priority"), place.alias("place"), position.alias("position"), side.alias("position_side"))
    first = F.transform(F.coalesce(starting, F.array().cast(STARTS)), lambda s: state(s["playerId"], F.lit(0.0), 0, F.lit(-1), s["position"], s["positionSide"]))

    def moved(c, k):
        clock = c["gameTime"]["gameTimeInSec"]
        return state(c["playerId"], F.try_element_at(F.col("begins"), clock_period(clock)) + clock_within(clock), 1, k, c["toPosition"], c["positionSide"])

    return F.concat(first, F.transform(F.coalesce(changes, F.array().cast(CHANGES)), moved))


def by_position(spells: DataFrame) -> DataFrame:
    """Position sides of one (fixture, squad, player, position) taken together."""
    return spells.groupBy("fixture_id", "season_id", "squad_id", "player_id", "position").agg(
        F.bool_or("started").alias("started"), F.min("first_second").alias("first_second"), F.max("last_second").alias("last_second"), F.sum("play_duration").alias("play_duration"), F.max("match_duration").alias("match_duration")
    )


def by_fixture(positions: DataFrame) -> DataFrame:
    """One row per (player, fixture, squad): totals and the position of most seconds, the least code on ties."""
    keys = ["player_id", "fixture_id", "squad_id"]
    return positions.groupBy(*keys, "season_id").agg(
        F.bool_or("started").alias("started"), F.sum("play_duration").alias("play_duration"), F.max("match_duration").alias("match_duration"),
        F.min_by("position", F.struct(-F.col("play_duration"), F.col("position"))).alias("dominant_position"),
    ).withColumn("match_share", F.col("play_duration") / F.nullif("match_duration", F.lit(0.0)))


def by_season(positions: DataFrame) -> DataFrame:
    """One row per (player, season): appearances, starts, seconds, and the position of most seconds over the season."""
    per_fixture = positions.groupBy("player_id", "season_id", "fixture_id").agg(F.max(F.col("started").cast("int")).alias("s"), F.sum("play_duration").alias("d"))
    totals = per_fixture.groupBy("player_id", "season_id").agg(F.count(F.lit(1)).alias("appearances"), F.sum("s").alias("starts"), F.sum("d").alias("play_duration"))
    per_position = positions.groupBy("player_id", "season_id", "position").agg(F.sum("play_duration").alias("d"))
    most = per_position.groupBy("player_id", "season_id").agg(F.min_by("position", F.struct(-F.col("d"), F.col("position"))).alias("dominant_position"))
    return totals.join(most, ["player_id", "season_id"])
