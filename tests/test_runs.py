"""Whole runs: Bronze to Gold, the queue, summaries and profiles on disk."""

import json

import pytest
from pyspark.sql import functions as F

from pitchlake import catalog
from pitchlake.operators import ingest, lineup, silver
from pitchlake.plans import control, pipeline
from pitchlake.sources import readers, sinks

LEAGUE, SEASON = "ITA-Serie A", 2024
GAMES, PLAYERS = 120, 4


def season(spark):
    """A schedule, two sheet rows and eight line-up rows a game; the home side scores its number modulo 3, the other 1."""
    g = spark.range(GAMES).select(F.format_string("2024-01-01 g%03d", "id").alias("game"), F.col("id").alias("game_id"), F.lit("2024-01-01").alias("date"), F.concat(F.lit("T"), (F.col("id") % 6).cast("string")).alias("home_team"), F.concat(F.lit("T"), (F.col("id") % 6 + 1).cast("string")).alias("away_team"), F.lit(LEAGUE).alias("league"), F.lit(SEASON).alias("season"))
    sides = g.select("*", F.explode(F.array(F.lit(True), F.lit(False))).alias("is_home")).withColumn("team", F.when(F.col("is_home"), F.col("home_team")).otherwise(F.col("away_team")))
    sheet = sides.select("game", "league", "season", "team", "is_home", F.concat(F.lit("V"), "home_team").alias("venue"), F.lit("100.0").alias("attendance"), F.lit(200).alias("capacity"), (F.col("game_id") * 0.5).alias("possession_pct"), F.lit("[raw]").alias("roster"))
    players = sides.select("*", F.explode(F.sequence(F.lit(0), F.lit(PLAYERS - 1))).alias("n"))
    goals = F.when(F.col("n") == 0, F.when(F.col("is_home"), F.col("game_id") % 3).otherwise(1)).otherwise(0)
    rows = players.select("game", F.concat("team", F.lit("-p"), "n").alias("player"), "team", "league", "season", "is_home", F.lit("M").alias("position"), (F.col("n") < 3).alias("starter"), goals.cast("string").alias("total_goals"), F.lit("1.0").alias("goal_assists"))
    return g, sheet, rows


def test_bronze_to_gold(spark, tmp_path):
    schedule, sheet, rows = season(spark)
    root, db = str(tmp_path / "lake"), "run_test"
    names = [f"{db}.{t}" for t in pipeline.TABLES]
    sinks.drop_tables(spark, names)

    def no_events():
        raise OSError("no events for this league")

    landed = pipeline.load_bronze(root, LEAGUE, SEASON, schedule, lambda: sheet, lambda: rows, no_events)
    assert {k: v["rows"] for k, v in landed.items()} == {"schedule": GAMES, "matchsheet": 2 * GAMES, "lineup": 2 * GAMES * PLAYERS, "events": 0}
    assert landed["schedule"]["path"] == f"{root}/espn/serie_a/2024/schedule.json" and "no events" in landed["events"]["error"]
    back = pipeline.read_bronze(spark, root, LEAGUE, SEASON, "matchsheet")
    assert back.count() == 2 * GAMES and dict(back.dtypes)["attendance"] == "string" and dict(back.dtypes)["possession_pct"] == "double" and "roster" not in back.columns
    checks = pipeline.run_silver(spark, root, db, SEASON, LEAGUE)
    assert len(checks) == 10 and {c[1] for c in checks} == {"pass"}
    counts = dict(pipeline.table_counts(spark, db))
    assert counts == {"teams": 6, "players": 7 * PLAYERS, "match_statistics": GAMES, "player_match_stats": 2 * GAMES * PLAYERS, "match_events": None, "player_season_stats": None}
    m = spark.table(f"{db}.match_statistics").agg(F.sum("home_score"), F.sum("away_score"), F.count_if(F.col("winner") == "Draw")).first()
    assert tuple(m) == (sum(i % 3 for i in range(GAMES)), GAMES, GAMES // 3)
    assert pipeline.run_gold(spark, db, SEASON, LEAGUE) == [("player_season_stats_not_empty", "pass", f"rows={7 * PLAYERS}"), ("player_name_not_null", "pass", "null_rate=0.0000"), ("team_name_not_null", "pass", "null_rate=0.0000")]
    gold = spark.table(f"{db}.player_season_stats").agg(F.sum("goals"), F.sum("assists"), F.sum("matches_started")).first()
    assert tuple(gold) == (m[0] + m[1], 2 * GAMES * PLAYERS, 2 * GAMES * 3)
    # a second run of another season leaves this one alone; the same season is replaced
    other = schedule.withColumn("season", F.lit(2023)), sheet.withColumn("season", F.lit(2023)), rows.withColumn("season", F.lit(2023))
    events = schedule.select("game", F.lit("goal").alias("event_type")).limit(3)
    pipeline.load_bronze(root, LEAGUE, 2023, other[0], lambda: other[1], lambda: other[2], lambda: events)
    for _ in range(2):
        pipeline.run_silver(spark, root, db, 2023, LEAGUE)
    assert spark.table(f"{db}.match_statistics").count() == 2 * GAMES
    e = spark.table(f"{db}.match_events")
    assert e.count() == 3 and dict(e.dtypes)["game_id"] == "bigint" and e.filter("game_id is null").isEmpty()
    sinks.drop_tables(spark, names)


def test_bronze_arrays_and_empty_files(spark, tmp_path):
    path = tmp_path / "schedule.json"
    path.write_text(json.dumps([{"game": f"g{i}", "season": 2024, "home_score": i, "extra": 1.5} for i in range(30)], indent=2))
    df = readers.bronze(spark, str(path), *pipeline.BRONZE["schedule"])
    assert df.count() == 30 and dict(df.dtypes)["home_score"] == "string" and dict(df.dtypes)["extra"] == "double" and "league" in df.columns and "away_score" not in df.columns
    path.write_text("[]")
    assert readers.bronze(spark, str(path), *pipeline.BRONZE["schedule"]).count() == 0
    assert readers.optional_bronze(spark, str(path), "game string") is None and readers.optional_bronze(spark, str(tmp_path / "no"), "game string") is None


def test_queue_end_to_end(spark, tmp_path):
    root, db = str(tmp_path / "out"), "queue_test"
    raw = tmp_path / "out" / "raw"
    raw.mkdir(parents=True)
    (tmp_path / "out" / "queue").mkdir()
    spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")

    def message(i, entity, name, body=None, fmt="json", **more):
        path = raw / name
        if body is not None:
            path.write_text(body if isinstance(body, str) else json.dumps(body))
        return json.dumps({"entity_type": entity, "entity_id": i, "payload_format": fmt, "path": str(path), "provider": "espn", "league": LEAGUE, "season": SEASON, "created_at": "2024-05-01T00:00:00Z"} | more)

    lines = [
        message(1, "match", "m1.json", {"game": "a", "Extra Key": {"x": [1, None]}, "ok": True}),
        "{broken",
        message(1, " MATCH", "m1.json"),
        message(2, "team", "t.json", [{"name": "T1"}, {"name": "T2", "payload_json": "p"}]),
        message(3, "team", "bad.json", [{"name": "T3"}, 5]),
        message(4, "match", "none.json"),
        message(5, "player", "p.csv", "name,age\nA,1\nB,\nC,3\n", "csv"),
        message(6, "match_stats", "s.json", [{"a": 1}]),
        message(7, "match", "junk.json", "{"),
        message(8, "match", "list.json", [{"a": 1}]),
        message(9, "match", "later.json", {"game": "z"}),
        message(10, "match", "later2.json", {"game": "y", "ok": False}),
    ]
    (tmp_path / "out" / "queue" / "pending.jsonl").write_text("\n".join(lines) + "\n")
    got = pipeline.consume(spark, root, db, batch=8)
    assert got == {"read": 12, "parse_failed": 1, "processed": 8, "done": 4, "failed": 6, "inserted_rows": 6, "files_moved": 3, "remaining": 2}
    match = spark.table(f"{db}.raw_soccerdata_match")
    row = match.first()
    assert (row["game"], row["extra_key"], row["ok"], row["meta_row_index"], row["meta_entity_id"]) == ("a", '{"x":[1,null]}', "True", 0, "1") and json.loads(row["payload_json"]) == {"game": "a", "Extra Key": {"x": [1, None]}, "ok": True}
    teams = spark.table(f"{db}.raw_soccerdata_team").orderBy("meta_row_index").collect()
    assert [(r["name"], r["src_payload_json"], r["meta_row_index"]) for r in teams] == [("T1", None, 0), ("T2", "p", 1)]
    players = spark.table(f"{db}.raw_soccerdata_player").orderBy("meta_row_index").collect()
    assert [(r["name"], r["age"]) for r in players] == [("A", "1"), ("B", None), ("C", "3")] and json.loads(players[1]["payload_json"]) == {"name": "B", "age": None}
    events = {r["entity_id"]: r for r in spark.table(f"{db}.raw_ingestion_events").collect()}
    assert {k: r["status"] for k, r in events.items()} == {"1": "done", "2": "done", "5": "done", "3": "failed", "4": "failed", "6": "failed", "7": "failed", "8": "failed"}
    why = {k: r["error_message"] for k, r in events.items()}
    assert why["3"] == "Payload for team contains non-object items" and why["4"].startswith("File not found") and why["6"] == "Unsupported entity_type: match_stats" and why["8"] == "Payload for match must be a JSON object" and why["7"] == "json_decode_error"
    done = spark.read.json(f"{root}/queue/done.jsonl")
    assert {(r["entity_id"], r["skip_reason"], r["moved_to"] is not None) for r in done.select("entity_id", "skip_reason", "moved_to").collect()} == {(1, None, True), (1, "duplicate_in_pending", True), (2, None, True), (5, None, True)}  # as they came, not as text
    assert (tmp_path / "out" / "processed" / "raw" / "m1.json").exists() and not (raw / "m1.json").exists() and (raw / "bad.json").exists()
    # the second run takes the rest; the done one is met again, and a new key becomes a column
    with open(tmp_path / "again.jsonl", "w") as f:
        f.write(message(2, "team", "t2.json", [{"name": "T9"}]) + "\n" + message(11, "match", "m11.json", {"game": "w", "new": 1}) + "\n")
    left = readers.numbered_lines(spark, f"{root}/queue/pending.jsonl").orderBy("line_no").collect()
    assert [json.loads(r["raw"])["entity_id"] for r in left] == [9, 10] and [r["line_no"] for r in left] == [0, 1]
    spark.read.text(str(tmp_path / "again.jsonl")).write.mode("append").text(f"{root}/queue/pending.jsonl")
    got = pipeline.consume(spark, root, db, batch=8)
    assert (got["read"], got["processed"], got["done"], got["inserted_rows"], got["remaining"]) == (4, 3, 4, 3, 0)
    match = {r["game"]: r for r in spark.table(f"{db}.raw_soccerdata_match").collect()}
    assert set(match) == {"a", "w", "y", "z"} and match["w"]["new"] == "1" and match["a"]["new"] is None and match["y"]["ok"] == "False"
    assert spark.table(f"{db}.raw_soccerdata_team").count() == 2
    assert pipeline.consume(spark, str(tmp_path / "nowhere"), db) == {"read": 0}
    spark.sql(f"DROP DATABASE {db} CASCADE")


def test_files_are_moved_by_tasks(spark, tmp_path):
    root = str(tmp_path / "out")
    for name, text in (("out/raw/a.json", "1"), ("out/b", "2"), ("x/c.csv", "3"), ("y/c.csv", "4"), ("y/processed.json", "5"), ("out/raw/with space%.json", "6")):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(text)
    names = ["out/raw/a.json", "out/b", "x/c.csv", "y/c.csv", "out/raw/a.json", "none.json", "out/raw", "out/raw/with space%.json"]
    paths = spark.createDataFrame([(f" {tmp_path / n} ",) for n in names] + [(None,), (" ",)], "path string")
    got = {r["path"]: r["moved_to"] for r in sinks.moved(paths, root).collect()}
    want = {f"{tmp_path}/out/raw/a.json": f"{root}/processed/raw/a.json", f"{tmp_path}/out/b": f"{root}/processed/b", f"{tmp_path}/x/c.csv": f"{root}/processed/c.csv", f"{tmp_path}/y/c.csv": f"{root}/processed/c_1.csv", f"{tmp_path}/out/raw/with space%.json": f"{root}/processed/raw/with space%.json"}
    assert got == want and (tmp_path / "out/processed/c_1.csv").read_text() == "4" and not (tmp_path / "out/b").exists() and (tmp_path / "y/processed.json").exists()
    # a task that is repeated finds what it moved
    assert {r["path"]: r["moved_to"] for r in sinks.moved(paths.filter("path like '%a.json%'"), root).collect()} == {f"{tmp_path}/out/raw/a.json": f"{root}/processed/raw/a.json"}


def test_numbered_lines_over_blocks(spark, tmp_path):
    path = tmp_path / "q.jsonl"
    path.write_text("".join(f"line {i}\n" for i in range(5000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    try:
        got = readers.numbered_lines(spark, str(path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted((r["line_no"], r["raw"]) for r in got) == [(i, f"line {i}") for i in range(5000)]


def test_upserts_keep_the_last_of_repeated_keys(spark):
    old = spark.createDataFrame([("k", "old", 1)], "key string, v string, at int")
    new = spark.createDataFrame([("k", "b", 3), ("k", "a", 2), ("n", "x", 5), ("n", "y", 4)], "key string, v string, at int")
    assert sorted(map(tuple, ingest.upsert(old, new, ["key"], order=F.col("at")).collect())) == [("k", "b", 3), ("n", "x", 5)]
    assert sorted(map(tuple, ingest.upsert(old, new, ["key"], keep=("at",), order=F.col("at")).collect())) == [("k", "b", 1), ("n", "x", 5)]
    e = lambda rows: spark.createDataFrame(rows, "message_hash string, status string, error string, processed_at int, entity_type string")
    got = ingest.upsert_events(e([("h", "failed", "x", 1, "old")]), e([("h", "failed", "y", 2, "n"), ("h", "done", None, 3, "n"), ("i", "done", None, 1, "n"), ("i", "failed", "z", 2, "n")]), F.col("processed_at"))
    assert sorted(map(tuple, got.collect())) == [("h", "done", None, 3, "old"), ("i", "failed", "z", 2, "n")]


def test_summaries_on_disk_enrich_lineups(spark, tmp_path):
    doc = json.loads(catalog.SUMMARY_ROWS)
    (tmp_path / "Summary_7.json").write_text(json.dumps(doc))
    (tmp_path / "Summary_8.json").write_text("{corrupt")
    nameless = json.loads(catalog.SUMMARY_ROWS)
    nameless["boxscore"]["form"] = nameless["boxscore"]["form"][:1]
    (tmp_path / "Summary_9.json").write_text(json.dumps(nameless))
    rows = spark.createDataFrame([("g7", "A", "Home FC"), ("g7", "C", "Away FC"), ("g7", "Z", "Home FC"), ("g8", "A", "Home FC"), ("g9", "A", "Home FC"), ("g9", "C", "Away FC"), ("g10", "A", "Home FC")], "game string, player string, team string")
    schedule = spark.createDataFrame([("g7", 7), ("g8", 8), ("g9", 9), ("g10", 10)], "game string, game_id int")
    found = readers.summaries(spark, str(tmp_path))
    assert lineup.stat_names(found) == ["totalGoals"]
    info = lineup.roster_rows(found.withColumns({"game": F.lit("g"), "league": F.lit("l"), "season": F.lit(2024)}), ("totalGoals", "starter")).filter("game_id = 7").collect()
    assert {(r["game"], r["league"], r["season"], r["player"], r["totalGoals"]) for r in info} == {("g", "l", 2024, "A", 2.0), ("g", "l", 2024, "Unknown", None), ("g", "l", 2024, "C", None)}
    got = {(r["game"], r["player"]): (r["athlete_id"], r["game_id"]) for r in lineup.enriched_lineup(rows, schedule, found, LEAGUE, SEASON).collect()}
    assert got == {("g7", "A"): (11, 7), ("g7", "C"): (None, 7), ("g7", "Z"): (None, None), ("g8", "A"): (None, None), ("g9", "A"): (11, 9), ("g9", "C"): (None, None), ("g10", "A"): (None, None)}
    assert lineup.enriched_lineup(rows, schedule.drop("game_id"), found, LEAGUE, SEASON) is rows
    none = lineup.enriched_lineup(rows, schedule, found.limit(0), LEAGUE, SEASON)
    assert none.count() == 7 and none.filter("athlete_id is not null").isEmpty()
    assert sorted(r[0] for r in readers.unreadable_summaries(spark, str(tmp_path), schedule).collect()) == [8, 10]


def test_profiles_on_disk(spark, tmp_path):
    (tmp_path / "athlete_5.json").write_text(json.dumps({"athlete": {"id": "5", "guid": "g", "displayName": "P", "active": True, "position": {"name": "F"}, "links": [{"rel": ["playercard"], "href": "h"}]}, "more": 1}))
    (tmp_path / "athlete_6.json").write_text("nothing")
    wanted = spark.createDataFrame([("5",), ("6",), ("7",)], "requested_id string")
    got = {r["espn_athlete_id"]: r for r in lineup.profile_rows(readers.profiles(spark, str(tmp_path), wanted)).collect()}
    assert set(got) == {5, 6, 7} and got[6]["display_name"] is None and got[7]["_raw"] is None
    five = got[5]
    assert (five["espn_guid"], five["position_name"], five["is_active"], five["profile_url"], json.loads(five["_raw"])["more"]) == ("g", "F", True, "h", 1) and len(five) == 17
    assert lineup.profile_rows(readers.profiles(spark, str(tmp_path))).count() == 1


def test_starter_branches(spark):
    df = spark.createDataFrame([("p", True, 1), ("q", None, None)], "player string, is_starter boolean, formation_place int")
    flag = lambda cols: [r[0] for r in df.select(*cols).select(silver.starter(cols).alias("s")).collect()]
    assert flag(["player", "is_starter", "formation_place"]) == [True, None] and flag(["player", "formation_place"]) == [True, False] and flag(["player"]) == [True, True]


def test_older_extraction(spark, tmp_path):
    schedule, sheet, rows = season(spark)
    paths, messages = pipeline.extract_matches(schedule, sheet, rows, str(tmp_path), LEAGUE, SEASON, most=5)
    assert messages.groupBy("entity_type").count().orderBy("entity_type").collect() == [("match", 5), ("match_lineup", 5), ("match_stats", 5)]
    match = readers.json_payloads(spark, [messages.filter("entity_type = 'match' and entity_id = '2'").first()["path"]]).select(F.to_json("payload")).first()[0]
    assert json.loads(match)["home_score"] == 2 and json.loads(match)["home_possession_pct"] == 1.0
    assert spark.read.option("header", True).csv(paths["all_matchsheets.csv"]).count() == 10 and spark.read.option("header", True).csv(paths["all_player_match_stats.csv"]).count() == 10 * PLAYERS


def test_control_table_is_stored(spark):
    name = "control_test"
    sinks.drop_tables(spark, [name])
    control.saved(control.seeded(control.ensured(spark, name)), name)
    assert control.ensured(spark, name).count() == 20
    assert control.season_id(spark.table(name), "FRA-Ligue 1", 2022).first()[0] is not None and control.season_id(spark.table(name), "x", 1).first()[0] is None
    sinks.drop_tables(spark, [name])


def test_head_takes_all_without_a_number(spark):
    df = spark.range(5)
    assert readers.head(df, 0, "id").count() == 5 and [r[0] for r in readers.head(df, 2, "id").collect()] == [0, 1]


def test_streaming_queue(spark, tmp_path):
    from pitchlake.streaming import queue_stream

    (tmp_path / "in").mkdir()
    line = lambda i: json.dumps({"entity_type": "match", "entity_id": i, "payload_format": "json", "path": "p", "provider": "x", "league": "l", "season": 2024, "created_at": "2024-05-01T00:00:00Z"}) + "\n"
    (tmp_path / "in" / "a.jsonl").write_text(line("1") + line("2") + line("1"))
    seen = []
    for more in ("", line("2") + line("3")):
        if more:
            (tmp_path / "in" / "b.jsonl").write_text(more)
        queue_stream.consume(spark, str(tmp_path / "in"), str(tmp_path / "cp"), lambda df, _: seen.extend(r["entity_id"] for r in df.collect())).awaitTermination()
    assert sorted(seen) == ["1", "2", "3"]


def test_unknown_quality_names():
    with pytest.raises(ValueError):
        control.stage_of("platinum")


def test_database_table_in_ranges(spark):
    """The database that comes with Spark stands in for any other."""
    url = "jdbc:derby:memory:ranges;create=true"
    rows = spark.range(100).select(F.col("id"), (F.col("id") % 7).cast("string").alias("kind"))
    rows.write.mode("overwrite").jdbc(url, "facts", properties={"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"})
    df = readers.jdbc_table(spark, url, "facts", '"id"', (0, 100), 4, driver="org.apache.derby.iapi.jdbc.AutoloadedDriver")
    assert df.rdd.getNumPartitions() == 4 and df.filter("id >= 50").count() == 50


def test_offline_source_feeds_bronze(spark, tmp_path):
    schedule, sheet, rows = season(spark)
    (tmp_path / "cache").mkdir()
    for name, df in (("schedule", schedule), ("matchsheet", sheet), ("lineup", rows)):
        records = [json.loads(r[0]) | {"index": 0} for r in df.select(F.to_json(F.struct("*"))).collect()]
        (tmp_path / "cache" / f"{name}.json").write_text(json.dumps(records, indent=1))
    source = pipeline.offline_source(spark, str(tmp_path / "cache"))
    landed = pipeline.load_bronze(str(tmp_path / "lake"), LEAGUE, SEASON, source["schedule"](), source["matchsheet"], source["lineup"], source["events"])
    assert {k: v["rows"] for k, v in landed.items()} == {"schedule": GAMES, "matchsheet": 2 * GAMES, "lineup": 2 * GAMES * PLAYERS, "events": 0} and "error" in landed["events"]
    assert "index" not in pipeline.read_bronze(spark, str(tmp_path / "lake"), LEAGUE, SEASON, "lineup").columns
