"""Payload shapes: expected rows follow from the payloads by hand."""

import json

from pyspark.sql import functions as F

from fieldspark.sources import payloads as P


def put(spark, *objects, **more):
    return spark.createDataFrame([(1, 100, json.dumps(o)) for o in objects], "match_id long, iteration_id long, payload string")


def test_event(spark):
    event = {
        "id": 3, "index": 1, "sequenceIndex": 4, "currentAttackingSquadId": 10, "gameTime": {"gameTime": "1:00", "gameTimeInSec": 60.0}, "player": {"id": 5}, "pass": {"distance": 3}, "pxT": {"team": 0.1}, "setPiece": {"id": 8}, "opponent": {"x": 1},
        "opponents": 7, "inferredSetPiece": "CORNER", "bodyPartExtended": "FOOT_LEFT", "distanceToGoal": 20.5, "pressingPlayerId": 6,
    }
    r = P.event_rows(put(spark, event), run_id=12).first()
    assert (r["event_id"], r["clock"], r["player_id"], r["player_position"], r["action"], r["sequence_index"], r["current_attacking_squad_id"]) == (3, 60.0, 5, None, None, 4, 10)
    assert (r["opponents"], r["inferred_set_piece"], r["body_part_extended"], r["distance_to_goal"], r["pressing_player_id"], r["fouled_player_id"], r["ingestion_run_id"]) == (7, "CORNER", "FOOT_LEFT", 20.5, 6, None, 12)
    found = {k: json.loads(v.toJson()) for k, v in r.asDict().items() if k.endswith("_detail") and v is not None}
    assert found == {"pass_detail": {"distance": 3}, "pxt_detail": {"team": 0.1}, "set_piece_detail": {"id": 8}, "opponent_detail": {"x": 1}} and json.loads(r["raw_event"].toJson()) == event


def test_scores_and_index(spark):
    raw = put(spark, [{"playerId": 1, "position": "CB", "playDuration": 9.0, "matchShare": 0.5, "playerScores": [{"playerScoreId": 2, "value": 1.5}, {"playerScoreId": 3, "value": None}]}, {"playerId": 4, "playerScores": []}, {"playerId": 5}])
    assert [tuple(r) for r in P.player_score_rows(raw).orderBy("player_score_id").collect()] == [(1, 100, 1, "CB", 9.0, 0.5, 2, 1.5), (1, 100, 1, "CB", 9.0, 0.5, 3, None)]
    raw = put(spark, [{"squadId": 7, "squadScores": [{"squadScoreId": 2, "value": 0.5}]}, {"squadId": 8}])
    assert [tuple(r) for r in P.squad_score_rows(raw).collect()] == [(1, 100, 7, 2, 0.5)]
    raw = spark.createDataFrame([(2, json.dumps([{"id": 9, "homeSquadId": 3}])), (1, json.dumps([{"id": 9, "homeSquadId": 1}, {"id": 8}, {"id": 9, "homeSquadId": 2}]))], "n int, payload string")
    assert [r["home_squad_id"] for r in P.match_index_rows(raw, "n").where("match_id = 9").collect()] == [1]
    assert [r["match_id"] for r in P.match_index_rows(raw, "n", most=1).collect()] == [9]
    events = spark.createDataFrame([(1, 2, 5, json.dumps([{"playerId": 5, "SHOT_XG": 0.25}, {"playerId": 6, "SHOT_XG": 0.5}])), (1, 3, 5, None)], "match_id long, event_id long, player_id long, event_kpis string")
    assert [tuple(r) for r in P.own_values(events, "SHOT_XG").collect()] == [(1, 2, 5, 0.25)]


def test_match_info(spark):
    home = {"id": 10, "players": [{"id": 1, "shirtNumber": 9}], "startingPositions": [{"playerId": 1, "position": "CB", "positionSide": "LEFT"}], "substitutions": [{"playerId": 2, "gameTime": {"gameTimeInSec": 5.0}, "toPosition": "CB", "positionSide": "LEFT"}], "formations": [{"formation": "4-4-2"}]}
    r = P.match_info_rows(put(spark, {"iterationId": 7, "squadHome": home, "squadAway": {"id": 20}})).first()
    assert (r["iteration_id"], r["home_squad_id"], r["home_starting"][0]["position"], r["home_changes"][0]["gameTime"]["gameTimeInSec"]) == (7, 10, "CB", 5.0)
    assert r["away_squad_id"] == 20 and r["away_starting"] == r["away_changes"] == r["away_players"] == []
    assert P.match_info_rows(put(spark, {"squadHome": home})).first()["iteration_id"] == 100


def test_set_pieces(spark):
    rows = P.set_piece_rows(put(spark, [{"id": 1, "matchId": 9, "setPieceSubPhase": [{"id": 11, "index": 0, "firstTouchWon": True, "aggregates": {"a": 1.5}}, {"id": 12, "index": 1}]}, {"id": 2, "setPieceSubPhase": []}, {"id": 3}])).orderBy("sub_phase_id").collect()
    assert [(r["set_piece_id"], r["matchId"], r["sub_phase_id"], r["firstTouchWon"], r["aggregates"]) for r in rows] == [(1, 9, 11, True, {"a": 1.5}), (1, 9, 12, None, None)]


def test_kpis(spark):
    df = put(spark, {"squadHome": {"id": 10, "kpis": [{"kpiId": 1, "value": 2.0}], "players": [{"id": 5, "position": "CB", "kpis": [{"kpiId": 1, "value": 0.5}, {"kpiId": 2, "value": 1.5}]}, {"id": 6, "kpis": []}, {"id": 7}]}, "squadAway": {"id": 20, "players": None}})
    assert sorted(tuple(map(str, r)) for r in P.player_kpi_rows(df).select("side", "player_id", "kpi_id", "value").collect()) == [("squadHome", "5", "1", "0.5"), ("squadHome", "5", "2", "1.5"), ("squadHome", "6", "None", "None"), ("squadHome", "7", "None", "None")]
    assert [tuple(r) for r in P.squad_kpi_rows(df).collect()] == [(1, "squadHome", 10, 1, 2.0)]


def test_ratings_and_assets(spark):
    r = P.rating_rows(put(spark, [{"date": "2024-01-02", "squadRatings": [{"squadId": 4, "value": 1.25, "rank": 2}]}, {"date": "bad", "squadRatings": []}])).first()
    assert (str(r["rating_date"]), r["squad_id"], r["rating"], r["more"]) == ("2024-01-02", 4, 1.25, {"rank": "2"})
    rows = P.asset_rows(put(spark, {"fixtureId": "f1", "assets": [{"id": "a", "type": "t", "subType": "s", "size": 5}]}, {"fixtureId": "f2"})).orderBy("fixture_id").collect()
    assert [tuple(r) for r in rows] == [("f1", "a", "t", "s", 5), ("f2", None, None, None, None)]


def test_scope(spark):
    its = spark.createDataFrame([(1, "26/27", (41, "MALE")), (2, "26/27", (9, "MALE")), (3, "25/26", (41, "MALE")), (4, "26/27", (41, "FEMALE"))], "id long, season string, competition struct<id:long,gender:string>")
    assert [r["id"] for r in P.in_scope(its, ["26/27"], [41]).collect()] == [1]
    ms = spark.createDataFrame([(1, "2024-01-01T10:00:00Z", True), (2, "2030-01-01T10:00:00Z", True), (3, "bad", True), (4, "2024-01-01T10:00:00Z", False)], "id long, scheduledDate string, available boolean")
    assert [r["id"] for r in P.loadable(ms, F.expr("timestamp '2025-01-01 00:00:00'")).collect()] == [1]
