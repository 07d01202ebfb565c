"""Provider payloads (JSON text) to raw rows. Payload text is parsed once per function with the shape that is read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldspark.operators.ranking import first_by
from fieldspark.operators.spells import CHANGES, STARTS

# The fields of an event that become columns (column: field), and the objects that are kept as variants.
EVENT = (
    "id bigint, index bigint, sequenceIndex bigint, periodId bigint, gameTime struct<gameTime:string,gameTimeInSec:double>, squadId bigint, currentAttackingSquadId bigint, "
    "player struct<id:bigint,position:string,positionSide:string>, actionType string, action string, phase string, bodyPart string, bodyPartExtended string, previousPassHeight string, duration double, "
    "opponents bigint, pressure double, distanceToGoal double, distanceToOpponent double, result string, pressingPlayerId bigint, fouledPlayerId bigint, inferredSetPiece string"
)
EVENT_COLUMNS = {
    "event_id": "id", "event_index": "index", "sequence_index": "sequenceIndex", "period_id": "periodId", "game_time": "gameTime.gameTime", "clock": "gameTime.gameTimeInSec", "squad_id": "squadId",
    "current_attacking_squad_id": "currentAttackingSquadId", "player_id": "player.id", "player_position": "player.position", "player_position_side": "player.positionSide", "action_type": "actionType", "action": "action",
    "phase": "phase", "body_part": "bodyPart", "body_part_extended": "bodyPartExtended", "previous_pass_height": "previousPassHeight", "duration": "duration", "opponents": "opponents", "pressure": "pressure",
    "distance_to_goal": "distanceToGoal", "distance_to_opponent": "distanceToOpponent", "result": "result", "pressing_player_id": "pressingPlayerId", "fouled_player_id": "fouledPlayerId", "inferred_set_piece": "inferredSetPiece",
}
EVENT_DETAILS = {"start": "start", "end": "end", "duel": "duel", "shot": "shot", "pass": "pass", "dribble": "dribble", "set_piece": "setPiece", "pxt": "pxT", "formation": "formation", "opponent": "opponent"}


def event_rows(raw: DataFrame, payload: str = "payload", keep: tuple[str, ...] = ("match_id",), run_id: int | None = None) -> DataFrame:
    """One row per event: its scalar columns, each optional object as a variant (null where missing), the whole event as
    a variant and the run that loaded it. The payload is parsed once for the columns and once for the whole event."""
    shape = EVENT + "".join(f", `{name}` variant" for name in EVENT_DETAILS.values())
    one = raw.select(*keep, F.from_json(payload, shape).alias("e"), F.try_parse_json(payload).alias("raw_event"))
    columns = [F.col(f"e.{field}").alias(name) for name, field in EVENT_COLUMNS.items()]
    details = [F.col(f"e.`{field}`").alias(f"{name}_detail") for name, field in EVENT_DETAILS.items()]
    return one.select(*keep, *columns, *details, "raw_event", F.lit(run_id).cast("long").alias("ingestion_run_id"))


SIDE = f"struct<id:bigint,players:array<struct<id:bigint,shirtNumber:int>>,startingPositions:{STARTS},substitutions:{CHANGES},formations:array<struct<formation:string>>>"
MATCH = f"iterationId bigint, dateTime string, lastCalculationDate string, squadHome {SIDE}, squadAway {SIDE}"


def match_info_rows(raw: DataFrame, payload: str = "payload", iteration: str = "iteration_id") -> DataFrame:
    """One row per match with line-ups and changes of both sides; missing arrays are empty, the payload's iteration wins."""
    m = F.from_json(payload, MATCH)
    columns = [F.coalesce(m["iterationId"], F.col(iteration)).alias("iteration_id")]
    for side, name in (("home", "squadHome"), ("away", "squadAway")):
        s = m[name]
        columns += [s["id"].alias(f"{side}_squad_id")]
        columns += [F.coalesce(s[field], F.array().cast(kind)).alias(f"{side}_{to}") for field, to, kind in (("startingPositions", "starting", STARTS), ("substitutions", "changes", CHANGES), ("players", "players", "array<struct<id:bigint,shirtNumber:int>>"), ("formations", "formations", "array<struct<formation:string>>"))]
    return raw.select("match_id", *columns, F.col(payload).alias("raw_payload"))


# Fields of a set piece and of its sub-phases that become columns.
PIECE = "id bigint, matchId bigint, startTimeInSec double, endTimeInSec double, squadId bigint, phaseIndex int, setPieceCategory string, adjSetPieceCategory string, setPieceExecutionType string"
SUB_PHASE = (
    "id bigint, index int, startZone string, cornerEndZone string, cornerType string, freeKickEndZone string, freeKickType string, goalKickEndZone string, goalKickType string, throwInEndZone string, throwInType string, "
    "mainEventPlayerId bigint, mainEventOutcome string, passReceiverId bigint, ballTrajectory string, firstTouchPlayerId bigint, firstTouchWon boolean, indirectHeader string, secondTouchPlayerId bigint, secondTouchWon boolean, secondTouchEndZone string, aggregates map<string,double>"
)


def _struct(ddl: str) -> str:
    return "struct<" + ",".join(f.strip().replace(" ", ":", 1) for f in ddl.split(", ")) + ">"


def _names(ddl: str) -> list[str]:
    return [f.split()[0] for f in ddl.split(", ")]


def set_piece_rows(raw: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per (set piece, sub-phase); set pieces without sub-phases give none."""
    pieces = F.from_json(payload, f"array<struct<{','.join(f.strip().replace(' ', ':', 1) for f in PIECE.split(', '))},setPieceSubPhase:array<{_struct(SUB_PHASE)}>>>")
    one = raw.select(F.explode(pieces).alias("p")).select("p", F.explode("p.setPieceSubPhase").alias("s"))
    return one.select(*[F.col(f"p.{n}").alias("set_piece_id" if n == "id" else n) for n in _names(PIECE)], *[F.col(f"s.{n}").alias(f"sub_phase_{n}" if n in ("id", "index") else n) for n in _names(SUB_PHASE)])


KPIS = "kpis:array<struct<kpiId:bigint,value:double>>"


def player_kpi_rows(raw: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per player and KPI of both sides; a player without KPIs keeps one row with nulls."""
    player = f"struct<id:bigint,position:string,playDuration:double,matchShare:double,{KPIS}>"
    m = F.from_json(payload, f"squadHome struct<id:bigint,players:array<{player}>>, squadAway struct<id:bigint,players:array<{player}>>")
    sides = F.array(*[F.struct(F.lit(s).alias("side"), m[s]["id"].alias("squad_id"), m[s]["players"].alias("players")) for s in ("squadHome", "squadAway")])
    one = raw.select("match_id", F.explode(sides).alias("s")).select("match_id", "s.side", "s.squad_id", F.explode("s.players").alias("p"))
    return one.select("match_id", "side", "squad_id", "p", F.explode_outer("p.kpis").alias("k")).select(
        "match_id", "side", "squad_id", F.col("p.id").alias("player_id"), F.col("p.position").alias("position"), F.col("p.playDuration").alias("play_duration"), F.col("p.matchShare").alias("match_share"), F.col("k.kpiId").alias("kpi_id"), F.col("k.value").alias("value")
    )


def squad_kpi_rows(raw: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per squad and KPI of both sides."""
    m = F.from_json(payload, f"squadHome struct<id:bigint,{KPIS}>, squadAway struct<id:bigint,{KPIS}>")
    sides = F.array(*[F.struct(F.lit(s).alias("side"), m[s]["id"].alias("squad_id"), m[s]["kpis"].alias("kpis")) for s in ("squadHome", "squadAway")])
    one = raw.select("match_id", F.explode(sides).alias("s")).select("match_id", "s.side", "s.squad_id", F.explode("s.kpis").alias("k"))
    return one.select("match_id", "side", "squad_id", F.col("k.kpiId").alias("kpi_id"), F.col("k.value").alias("value"))


def _score_rows(raw: DataFrame, payload: str, array: str, score: str, who: str, more: str) -> DataFrame:
    kept = [c for c in raw.columns if c != payload]
    records = F.from_json(payload, f"array<struct<{who}:bigint,{more}{array}:array<struct<{score}:bigint,value:double>>>>")
    one = raw.select(*kept, F.explode(records).alias("r"))
    return one.select(*kept, "r", F.explode(f"r.{array}").alias("s"))


def player_score_rows(raw: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per player and score beside the other columns of ``raw``; records without scores give none."""
    rows = _score_rows(raw, payload, "playerScores", "playerScoreId", "playerId", "position:string,playDuration:double,matchShare:double,")
    kept = [c for c in raw.columns if c != payload]
    return rows.select(*kept, F.col("r.playerId").alias("player_id"), F.col("r.position").alias("position"), F.col("r.playDuration").alias("play_duration"), F.col("r.matchShare").alias("match_share"), F.col("s.playerScoreId").alias("player_score_id"), F.col("s.value").alias("value"))


def squad_score_rows(raw: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per squad and score beside the other columns of ``raw``; records without scores give none."""
    rows = _score_rows(raw, payload, "squadScores", "squadScoreId", "squadId", "")
    kept = [c for c in raw.columns if c != payload]
    return rows.select(*kept, F.col("r.squadId").alias("squad_id"), F.col("s.squadScoreId").alias("squad_score_id"), F.col("s.value").alias("value"))


def match_index_rows(raw: DataFrame, order: str, most: int | None = None, payload: str = "payload") -> DataFrame:
    """One row per match of the index: of several with one id the first in ``order`` stays; at most the first ``most``."""
    matches = F.from_json(payload, "array<struct<id:bigint,scheduledDate:string,homeSquadId:bigint,awaySquadId:bigint>>")
    rows = raw.select(F.col(order).alias("__order"), F.posexplode(matches).alias("__place", "m"))
    first = first_by(rows, ["m.id"], [F.col("__order"), F.col("__place")])
    if most is not None:
        first = first.orderBy("__order", "__place").limit(most)
    return first.select(F.col("m.id").alias("match_id"), F.expr("try_cast(m.scheduledDate as timestamp_ntz)").alias("scheduled_at"), F.col("m.homeSquadId").alias("home_squad_id"), F.col("m.awaySquadId").alias("away_squad_id"))


def own_values(events: DataFrame, name: str, kpis: str = "event_kpis", player: str = "player_id", keep: tuple[str, ...] = ("match_id", "event_id", "player_id")) -> DataFrame:
    """Of each event the value ``name`` that its KPI array (a variant: an object for each player) has for its own player."""
    each = events.select(*keep, F.col(player).alias("__own"), F.from_json(F.to_json(kpis) if dict(events.dtypes)[kpis] == "variant" else F.col(kpis), f"array<struct<playerId:bigint,`{name}`:double>>").alias("__all"))
    rows = each.select(*keep, "__own", F.explode("__all").alias("k")).where("k.playerId = __own")
    return rows.select(*keep, F.col(f"k.`{name}`").alias("value"))


def rating_rows(raw: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per (date, squad) of squad ratings; what else a rating says stays as a map of text."""
    groups = F.from_json(payload, "array<struct<date:string,squadRatings:array<map<string,string>>>>")
    one = raw.select("iteration_id", F.explode(groups).alias("g")).select("iteration_id", F.expr("try_cast(g.date as date)").alias("rating_date"), F.explode("g.squadRatings").alias("r"))
    get = lambda k: F.try_element_at("r", F.lit(k))
    return one.select("iteration_id", "rating_date", get("squadId").try_cast("bigint").alias("squad_id"), get("value").try_cast("double").alias("rating"), F.map_filter("r", lambda k, v: ~k.isin("squadId", "value")).alias("more"))


def asset_rows(raw: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per asset of a fixture; a fixture without assets keeps one row with nulls."""
    f = F.from_json(payload, "fixtureId string, assets array<struct<id:string,type:string,subType:string,size:bigint>>")
    one = raw.select(f["fixtureId"].alias("fixture_id"), F.explode_outer(f["assets"]).alias("a"))
    return one.select("fixture_id", F.col("a.id").alias("asset_id"), F.col("a.type").alias("asset_type"), F.col("a.subType").alias("asset_subtype"), F.col("a.size").alias("size"))


def in_scope(iterations: DataFrame, seasons: list[str], competitions: list[int], gender: str = "MALE") -> DataFrame:
    """Iterations of wanted seasons, competitions and gender."""
    return iterations.where(F.col("season").isin(seasons) & F.col("competition.id").isin(competitions) & (F.col("competition.gender") == gender))


def loadable(matches: DataFrame, now: Column) -> DataFrame:
    """Available matches that have begun; those without a readable date are left out."""
    return matches.where(F.coalesce("available", F.lit(False)) & (F.expr("try_cast(scheduledDate as timestamp)") <= now))
