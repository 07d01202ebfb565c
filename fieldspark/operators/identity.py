"""Identity resolution: matching new external players to canonical ones, minting, candidates and merges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fieldspark.functions.text import normalize_name
from fieldspark.operators.merge import missing, upsert
from fieldspark.operators.ranking import first_by
from fieldspark.sources.sinks import written

# What becomes of a new external player.
MINT, LINK, AMBIGUOUS, OVERRIDE = "MINT", "LINK", "AMBIGUOUS", "OVERRIDE"


def new_externals(appearances: DataFrame, identities: DataFrame, source_id: str, order: list[Column]) -> DataFrame:
    """One row per external id that no identity has yet: the newest appearance."""
    rest = appearances.join(identities.select(F.col("source_id").alias("__linked")), F.col(source_id).cast("string") == F.col("__linked"), "left_anti")
    return first_by(rest, [source_id], order)


def classified(externals: DataFrame, canonical: DataFrame, overrides: DataFrame) -> DataFrame:
    """``externals`` (source_id, name, birth_date, ...) with ``outcome``, ``canonical_id`` and ``candidates``.

    An override wins; else canonical players (canonical_id, name, birth_date) of the same normalised name and birth date
    (null being equal to null) decide: none is MINT, one is LINK, more are AMBIGUOUS. Canonical players are grouped by
    key before the join, so a name that very many share costs one row a key on the joined side.
    """
    keyed = canonical.select(normalize_name(F.col("name")).alias("__key"), F.col("birth_date").alias("__born"), F.col("canonical_id").alias("__id"))
    known = keyed.where("__key <> ''").groupBy("__key", "__born").agg(F.sort_array(F.collect_set("__id")).alias("candidates"))
    mine = externals.withColumn("__own", normalize_name(F.col("name")))
    found = mine.join(known, (F.col("__own") == F.col("__key")) & F.col("birth_date").eqNullSafe(F.col("__born")), "left")
    given = overrides.select(F.col("source_id").alias("__source"), F.col("canonical_id").alias("__given"))
    found = found.join(given, F.col("source_id") == F.col("__source"), "left")
    n = F.coalesce(F.size("candidates"), F.lit(0))
    outcome = F.when(F.col("__given").isNotNull(), OVERRIDE).when(n > 1, AMBIGUOUS).when(n == 1, LINK).otherwise(MINT)
    return found.select(
        *externals.columns, outcome.alias("outcome"),
        F.when(F.col("__given").isNotNull(), F.col("__given")).when(n == 1, F.element_at("candidates", 1)).alias("canonical_id"),
        F.when(outcome == AMBIGUOUS, F.col("candidates")).alias("candidates"),
    )


def minted(rows: DataFrame, last_id: DataFrame, order: str, name: str = "canonical_id") -> DataFrame:
    """``rows`` with ids after the largest in ``last_id`` (one column), without gaps, in ascending ``order`` (unique, of any
    type that can be sorted).

    Rows are written in ranges of the order, numbered within them and moved by the sizes of the ranges before, so no task
    has all rows; the ranges become more with the rows.
    """
    ranged = rows.repartitionByRange(F.col(order)).withColumn("__part", F.spark_partition_id())
    dealt = written(ranged, "ranges")
    before = dealt.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))  # a row a range
    before = before.select("__part", F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    last = last_id.agg(F.coalesce(F.max(last_id.columns[0]), F.lit(0)).alias("__last"))
    placed = dealt.withColumn("__place", F.row_number().over(Window.partitionBy("__part").orderBy(order)))
    return placed.join(F.broadcast(before), "__part").join(F.broadcast(last)).select(*rows.columns, (F.col("__last") + F.col("__before") + F.col("__place")).cast("long").alias(name))


def _unlinked(matches: DataFrame, identities: DataFrame, system: str) -> DataFrame:
    known = identities.where(F.col("source_system") == system).select(F.col("source_id").alias("__linked")).distinct()
    return matches.join(known, F.col("id").cast("string") == F.col("__linked"), "left_anti")


def mintable_fixtures(matches: DataFrame, squads: DataFrame, identities: DataFrame, system: str, gender: str | None = "MALE") -> DataFrame:
    """(id, home_squad_id, away_squad_id, scheduled_at) of matches (id, home_squad_id, away_squad_id, scheduled text) that no
    identity has yet, with both squads known, both of ``gender`` unless that is None, and a readable date."""
    side = lambda s: squads.select(F.col("squad_id").alias(f"{s}_squad_id"), F.col("gender").alias(f"__{s}"))
    rows = _unlinked(matches, identities, system).join(side("home"), "home_squad_id").join(side("away"), "away_squad_id")
    if gender is not None:
        rows = rows.where((F.col("__home") == gender) & (F.col("__away") == gender))
    return rows.select("id", "home_squad_id", "away_squad_id", F.expr("try_cast(scheduled as timestamp_ntz)").alias("scheduled_at")).where("scheduled_at is not null")


def skipped_fixtures(matches: DataFrame, identities: DataFrame, system: str) -> DataFrame:
    """How many matches without identity lack a squad, and how many a readable date."""
    return _unlinked(matches, identities, system).agg(
        F.count_if(F.col("home_squad_id").isNull() | F.col("away_squad_id").isNull()).alias("missing_squad"), F.count_if(F.expr("try_cast(scheduled as timestamp_ntz)").isNull()).alias("bad_date")
    )


def stale_ids(identities: DataFrame, canonical: str, order: list[Column]) -> DataFrame:
    """(stale, current): each source id of a canonical one that isn't first in ``order``, and the one that is."""
    first = F.first_value("source_id").over(Window.partitionBy(canonical).orderBy(*order))
    return identities.select(F.col("source_id").alias("stale"), first.alias("current")).where("stale <> current").distinct()


def remapped(rows: DataFrame, stale: DataFrame, column: str) -> DataFrame:
    """``rows`` with stale ids replaced by the current ones."""
    new = stale.select(F.col("stale").alias(column), F.col("current").alias("__current"))
    return rows.join(new, column, "left").withColumn(column, F.coalesce("__current", column)).select(*rows.columns)


def queued_candidates(ambiguous: DataFrame, queue: DataFrame, system: str) -> DataFrame:
    """The queue with a PENDING row for each candidate that has none yet."""
    rows = ambiguous.select(F.lit(system).alias("source_system"), "source_id", F.explode("candidates").alias("candidate_id"), F.lit("PENDING").alias("status"))
    pending = queue.where("status = 'PENDING'")
    return queue.unionByName(missing(rows, pending, ["source_system", "source_id", "candidate_id"]), allowMissingColumns=True)


def merged_players(players: DataFrame, identities: DataFrame, overrides: DataFrame, winner: int, loser: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Players, identities and overrides after ``loser`` has been merged into ``winner``.

    Identities point to the winner, an override is added for each identity moved that has none, and the loser is marked
    inactive, never deleted. The two must differ and exist, the winner being active.
    """
    if winner == loser:
        raise ValueError("a player can't be merged into itself")
    found = {r["canonical_id"]: r["is_active"] for r in players.where(F.col("canonical_id").isin(winner, loser)).select("canonical_id", "is_active").collect()}
    if set(found) != {winner, loser} or found[winner] is False:
        raise ValueError("both players must exist, and the winner must be active")
    moved = identities.where(F.col("canonical_id") == loser)
    given = moved.select("source_system", "source_id", F.lit(winner).cast("long").alias("canonical_id"))
    gone = players.withColumn("is_active", F.when(F.col("canonical_id") == loser, False).otherwise(F.col("is_active")))
    pointed = identities.withColumn("canonical_id", F.when(F.col("canonical_id") == loser, F.lit(winner).cast("long")).otherwise(F.col("canonical_id")))
    return gone, pointed, overrides.unionByName(missing(given, overrides, ["source_system", "source_id"]), allowMissingColumns=True)


def linked(identities: DataFrame, outcomes: DataFrame, system: str) -> DataFrame:
    """The identities with those that the outcomes LINK or OVERRIDE, or that were minted, added."""
    new = outcomes.where("canonical_id is not null").select(F.lit(system).alias("source_system"), F.col("source_id"), "canonical_id")
    return upsert(identities, new, ["source_system", "source_id"])
