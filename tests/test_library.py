"""Expressions, sinks, queue, control and quality on tiny inputs."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from pitchlake import leagues
from pitchlake.functions import scalars as S
from pitchlake.operators import gold, ingest, lineup, silver
from pitchlake.plans import control, pipeline, quality
from pitchlake.sources import history, readers, sinks


def one(spark, column):
    return spark.range(1).select(column).first()[0]


@pytest.mark.parametrize("text,want", [("Red Star", "red_star"), ("São Paulo F.C.", "s_o_paulo_f_c"), ("", "unknown"), ("!!", "unknown"), ("__a1__", "a1"), (None, "unknown")])
def test_slug(spark, text, want):
    assert one(spark, S.slug(F.lit(text).cast("string"))) == want


@pytest.mark.parametrize("text,want", [("65'", 65), ("90+3'", 93), ("", None), (None, None), ("1234", 127)])
def test_clock(spark, text, want):
    assert one(spark, S.clock_minute(F.lit(text).cast("string"))) == want


@pytest.mark.parametrize("text,want", [("1", 1), ("1.0", 1), ("abc", None), ("NaN", None), ("-2.9", -2)])
def test_safe_int(spark, text, want):
    assert one(spark, S.safe_int(F.lit(text))) == want


def test_identifiers():
    assert [S.identifier(x) for x in ("A b", "9x", "", "é")] == ["a_b", "col_9x", "col_unknown", "col_unknown"]
    with pytest.raises(ValueError):
        S.quote_ident("a b")
    assert ingest.dynamic_names(["Payload JSON", "payload_json", "x"]) == {"Payload JSON": "src_payload_json", "payload_json": "src_payload_json", "x": "x"}
    assert leagues.league_slug("Some--New League") == "some_new_league"
    assert [leagues.league_slug(k) for k in ("ITA-Serie A", "ENG-Premier League", "FRA-Ligue 1")] == ["serie_a", "premier_league", "ligue_1"]
    assert leagues.with_mapping({}, "BRA-Brasileirao")["BRA-Brasileirao"]["ESPN"] == "bra.1" and leagues.with_mapping({}, "ITA-Serie A") == {}
    assert leagues.with_mapping({"BRA-Brasileirao": {"ESPN": "own"}}, "BRA-Brasileirao")["BRA-Brasileirao"]["ESPN"] == "own"
    with pytest.warns(UserWarning):
        assert leagues.with_mapping({}, "XX-None") == {}


def test_hashes(spark):
    m = {"entity_type": ' Te"am\\', "entity_id": "7", "path": "/a", "provider": "pé", "league": None, "season": 2024, "created_at": "2024-05-01T00:00:00Z"}
    later = m | {"created_at": "2024-06-01T00:00:00Z"}
    for one_ in (m, later, m | {"entity_id": None, "season": None}):
        df = spark.createDataFrame([(*one_.values(), "json")], "entity_type string, entity_id string, path string, provider string, league string, season int, created_at string, payload_format string")
        got = ingest.with_hashes(df).first()
        # a missing id counts as its text, the format doesn't count, the time does
        told = one_ | {"entity_id": str(one_["entity_id"])}
        assert got["message_hash"] == hashlib.sha256(json.dumps(told, sort_keys=True, ensure_ascii=False).encode()).hexdigest()
        folded = {k: str(one_[k] or "").strip().lower() for k in S.KEY_FIELDS}
        assert got["dedupe_key"] == hashlib.sha256(json.dumps(folded, sort_keys=True, ensure_ascii=False).encode()).hexdigest()


MESSAGES = [
    {"season": 2024}, {"season": "2024"}, {"season": "2024-25"}, {"season": 2024.0}, {"season": 2024.5}, {"season": None}, {}, {"season": 0}, {"season": True}, {"season": False}, {"season": 1e22}, {"season": 1.5e-7}, {"season": 123456789.25},
    {"season": 0.00012}, {"season": 12345678901234567890}, {"season": -3}, {"entity_id": 7}, {"entity_id": 7.5}, {"entity_id": True}, {"entity_id": None, "league": 5}, {"provider": "", "path": 'a "b" \\ é', "extra": {"x": [1]}}, {"entity_type": 0, "created_at": 1714521600},
]


def test_messages_of_any_json_value(spark):
    """Hashes are those of Python's own JSON; nothing that is an object fails."""
    base = {"entity_type": " Team", "entity_id": "A1", "payload_format": "json", "path": "/a", "provider": "espn", "league": "BRA", "season": 2024, "created_at": "2024-05-01"}
    whole = [m if not m else base | m for m in MESSAGES]
    lines = [json.dumps(m, ensure_ascii=i % 2 == 0) for i, m in enumerate(whole)] + ["", "[1]", '"x"', "5", "null", '{"a":', "{} x"]
    good, bad = readers.parse_lines(spark.createDataFrame(list(enumerate(lines)), "line_no long, raw string"))
    got = {r["line_no"]: r for r in ingest.with_hashes(good).collect()}
    assert sorted(got) == list(range(len(whole))) and sorted(r["line_no"] for r in bad.collect()) == list(range(len(whole), len(lines)))
    for i, m in enumerate(whole):
        told = {f: m.get(f) for f in S.HASH_FIELDS} | {"entity_id": str(m.get("entity_id"))}
        assert got[i]["message_hash"] == hashlib.sha256(json.dumps(told, ensure_ascii=False, sort_keys=True).encode()).hexdigest(), m
        key = {f: str(m.get(f) or "").strip().lower() for f in S.KEY_FIELDS}
        assert got[i]["dedupe_key"] == hashlib.sha256(json.dumps(key, ensure_ascii=False, sort_keys=True).encode()).hexdigest(), m
        assert got[i]["season"] == (None if m.get("season") is None else str(m["season"]))


def test_draw_while_unplayed_and_stray_score_column(spark):
    s = spark.createDataFrame([("g1", "A", "B", "3"), ("g2", "A", "B", "1")], "game string, home_team string, away_team string, home_score string")
    l = spark.createDataFrame([("g1", True, "2"), ("g1", False, "x")], "game string, is_home boolean, total_goals string")
    out = {r["game"]: r for r in silver.with_result(silver.scored_schedule(s, l), F.col("home_score"), F.col("away_score")).collect()}
    assert (out["g1"]["home_score"], out["g1"]["away_score"], out["g1"]["winner"]) == (2, 0, "A")
    assert out["g2"]["is_draw"] is None and out["g2"]["winner"] == "Draw"


def test_gold_without_games(spark):
    df = spark.createDataFrame([(None, "p", "t", "l", 2024, True, 3)], "game string, player string, team string, league string, season int, starter boolean, total_goals int")
    r = gold.player_season_stats(df).first()
    assert (r["matches_played"], r["goals"], r["assists"], r["goals_per_match"]) == (0, 3, 0, None)


def test_partition_write_is_idempotent(spark):
    sinks.ensure_namespace(spark, "lake_test")
    name = "lake_test.facts"
    sinks.drop_tables(spark, [name])
    rows = lambda v, s: spark.createDataFrame([(v, s, "L'1")], "v int, season int, league string")
    for v, s in ((1, 2023), (2, 2024), (3, 2024)):
        sinks.write_partitioned(rows(v, s), name, s, "L'1")
    assert sorted(map(tuple, spark.table(name).collect())) == [(1, 2023, "L'1"), (3, 2024, "L'1")]
    with pytest.raises(ValueError):
        sinks.write_partitioned(rows(1, 2023), name, 2024, "L'1")
    sinks.write_partitioned(rows(1, 2024).limit(0), name, 2024, "L'1")
    assert spark.table(name).count() == 1
    sinks.add_column(spark, name, "goals", "int")
    assert "goals" in spark.table(name).columns
    sinks.drop_tables(spark, [name])


def test_queue_lines_and_plan(spark, tmp_path):
    good = lambda i, t=" Team": json.dumps({"entity_type": t, "entity_id": str(i), "payload_format": "json", "path": "p", "provider": "x", "league": "l", "season": 2024, "created_at": "c"})
    f = tmp_path / "pending.jsonl"
    f.write_text("\n".join([good(1), "{bad", "", "3", good(1, "team"), good(2)]) + "\n")
    ok, bad = readers.jsonl_queue(spark, str(f))
    assert [r["line_no"] for r in ok.orderBy("line_no").collect()] == [0, 4, 5]
    assert [r["line_no"] for r in bad.orderBy("line_no").collect()] == [1, 2, 3]
    lines = spark.createDataFrame([(0, good(1)), (1, good(1, "team")), (2, good(2))], "line_no int, raw string")
    events = spark.createDataFrame([("done", None, "TEAM", "2", "x", "l", "2024")], "status string, dedupe_key string, entity_type string, entity_id string, provider string, league string, season string")
    sinks.drop_tables(spark, ["plan_keys"])
    plan = pipeline.plan_queue(lines, history.ensured(spark, "plan_keys", events))
    assert {k: v.count() for k, v in plan.items()} == {"failures": 0, "duplicates": 1, "done": 1, "batch": 1, "remaining": 0}
    sinks.drop_tables(spark, ["plan_keys"])


def test_control_and_quality(spark):
    t = control.seeded(control.empty(spark))
    assert t.count() == 20 and control.seeded(t).count() == 20
    with pytest.raises(ValueError):
        control.pending_season(t, "platinum")
    i = control.pending_season(t, "bronze").first()["id"]
    t = control.failed(control.started(t, i, "bronze"), i, "bronze", "e" * 5000)
    row = t.filter(F.col("id") == i).first()
    assert row["status"] == "failed" and len(row["last_error"]) == 2000
    assert control.reset(t, i).filter(F.col("id") == i).first()["last_error"] is None
    log = spark.createDataFrame([], "id long, season_id long, stage string, check_name string, status string, details string, checked_at timestamp")
    log = quality.recorded(log, i, "gold", quality.all_passed("gold"))
    assert [r["check_name"] for r in quality.summary(log, i).collect()] == ["player_season_stats_not_empty", "player_name_not_null", "team_name_not_null"]
    assert control.checks_of(log, t, "BRA-Brasileirao", 2026).count() == 3 and control.checks_of(log, t, "BRA-Brasileirao", 1900).count() == 0
    assert quality.summary(log, i).count() == 3 and quality.orphans(log, t).isEmpty()
    for bad in (("bronze", [("a", "pass", "")]), ("gold", [("a", "nope", "")])):
        with pytest.raises(ValueError):
            quality.recorded(log, i, *bad)
    with pytest.raises(RuntimeError):
        quality.keys_present(spark.createDataFrame([("",)], "player string"), ["player"], "t")


def test_null_keys_join_only_when_asked(spark):
    a = spark.createDataFrame([(None, 1), ("g", 2)], "game string, v int")
    b = spark.createDataFrame([(None, 7), ("g", 8), ("g", 9)], "game string, game_id int")
    assert {(r["v"], r["game_id"]) for r in lineup.enrich(a, b, ["game"], ["game_id"]).collect()} == {(1, None), (2, 8)}
    assert {(r["v"], r["game_id"]) for r in lineup.enrich(a, b, ["game"], ["game_id"], True).collect()} == {(1, 7), (2, 8)}
    assert lineup.enrich(a, b.drop("game"), ["game"], ["game_id"]) is a


def test_optional_source_and_files(spark, tmp_path):
    assert readers.optional_json(spark, str(tmp_path / "none.json"), "a int") is None
    (tmp_path / "e.json").write_text("[]")
    assert readers.optional_json(spark, str(tmp_path / "e.json"), "a int") is None
    assert sinks.json_array(spark.createDataFrame([], "a int")).first()[0] == "[]"
    for n in range(2):
        (tmp_path / "x.csv").write_text(str(n))
        moved = sinks.move_processed(spark, [str(tmp_path / "x.csv"), str(tmp_path / "x.csv"), str(tmp_path / "none.csv"), None], str(tmp_path))
    assert sorted(p.name for p in (tmp_path / "processed").iterdir() if p.suffix == ".csv") == ["x.csv", "x_1.csv"]
    assert moved == {str(tmp_path / "x.csv"): str(tmp_path / "processed" / "x_1.csv")}
