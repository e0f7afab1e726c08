"""Queries over the driver's tables, one for each group of operators, with DuckDB oracles."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitchlake import analogs as A
from pitchlake import leagues, schemas
from pitchlake.functions import scalars as S
from pitchlake.operators import gold, ingest, lineup, silver
from pitchlake.plans import control, incremental, pipeline, quality
from pitchlake.sources import fetch, history, readers, sinks, sizes, versions
from pitchlake.streaming import stages, windows

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


LEAGUE = "leagues AS (SELECT s_suppkey AS team, r_name AS league FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"
SHEET = f"""{LEAGUE}, raw AS (SELECT l_orderkey AS game, l_linestatus = 'O' AS is_home, MIN(l_suppkey) AS team, MIN(l_returnflag) AS venue,
  SUM(CAST(l_quantity AS BIGINT)) AS attendance, MAX(l_extendedprice) AS capacity, COUNT(*) AS shots, CAST(SUM(l_linenumber) AS BIGINT) AS possession
  FROM lineitem GROUP BY l_orderkey, l_linestatus),
sheet AS (SELECT raw.*, league, year(o_orderdate) AS season FROM raw JOIN orders ON game = o_orderkey JOIN leagues USING (team))"""
LINEUP = f"""{LEAGUE}, lineup AS (SELECT l_orderkey AS game, l_partkey AS player, team, league, year(o_orderdate) AS season, l_linestatus = 'O' AS is_home,
  l_returnflag AS "position", l_linenumber = 1 AS starter, CAST(l_quantity AS INT) AS goals, l_linenumber AS assists, CASE WHEN l_tax > 0.04 THEN 0 ELSE l_linenumber END AS yellow
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN leagues ON l_suppkey = team)"""
SCHEDULE = "schedule AS (SELECT o_orderkey AS game, year(o_orderdate) AS season, o_orderstatus AS league, o_orderpriority AS home_team, CAST(o_custkey AS VARCHAR) AS away_team FROM orders)"
SCORES = """scores AS (SELECT l_orderkey AS game, CAST(SUM(CAST(l_quantity AS BIGINT)) FILTER (WHERE l_linestatus = 'O') AS BIGINT) AS home_score,
  CAST(SUM(CAST(l_quantity AS BIGINT)) FILTER (WHERE l_linestatus <> 'O') AS BIGINT) AS away_score FROM lineitem GROUP BY l_orderkey)"""
MODE = """counts AS (SELECT team, league, season, venue, COUNT(*) AS n FROM sheet WHERE is_home GROUP BY ALL),
mode AS (SELECT team, league, season, venue AS home_venue FROM counts QUALIFY ROW_NUMBER() OVER (PARTITION BY team, league, season ORDER BY n DESC, venue ASC NULLS FIRST) = 1)"""
MATCH = f"""WITH {SCHEDULE}, {SHEET}, {SCORES},
m AS (SELECT s.*, home_score, away_score, h.venue, CAST(h.attendance AS DOUBLE) AS attendance, h.capacity, h.shots AS home_shots, h.possession AS home_possession, a.shots AS away_shots, a.possession AS away_possession
  FROM schedule s LEFT JOIN scores USING (game) LEFT JOIN (SELECT * FROM sheet WHERE is_home) h USING (game) LEFT JOIN (SELECT * FROM sheet WHERE NOT is_home) a USING (game))
SELECT *, home_score + away_score AS total_goals, abs(home_score - away_score) AS goal_diff, home_score = away_score AS is_draw,
  CASE WHEN home_score > away_score THEN home_team WHEN home_score < away_score THEN away_team ELSE 'Draw' END AS winner FROM m"""


@query(f"WITH {SHEET}, {MODE} SELECT t.team AS team_name, t.league, t.season, CAST(MAX(TRUNC(capacity)) AS INT) AS stadium_capacity, CAST(ROUND(AVG(attendance), 0) AS INT) AS avg_attendance, COUNT(*) AS home_matches, ANY_VALUE(home_venue) AS home_venue FROM sheet t LEFT JOIN mode USING (team, league, season) WHERE is_home GROUP BY t.team, t.league, t.season")
def team_dimension(spark: SparkSession, d: str) -> DataFrame:
    return silver.teams(A.matchsheet(spark, d))


@query(f"WITH {SHEET}, {MODE} SELECT team AS team_name, league, season, home_venue FROM mode")
def venue_mode(spark, d):
    return silver.venue_mode(silver.home_rows(A.matchsheet(spark, d)))


@query("SELECT c_nationkey, c_mktsegment, CAST(MAX(TRUNC(c_acctbal)) AS INT) AS max_balance, CAST(ROUND(AVG(CAST(TRUNC(c_acctbal) AS INT)), 0) AS INT) AS avg_balance, COUNT(*) AS n FROM customer GROUP BY ALL")
def team_stats_rounding(spark, d):
    c = A.read(spark, d, "customer")
    whole = S.safe_int(F.col("c_acctbal").cast("string"))
    return c.groupBy("c_nationkey", "c_mktsegment").agg(F.max(whole).alias("max_balance"), F.round(F.avg(whole), 0).cast("int").alias("avg_balance"), F.count("*").alias("n"))


@query(f"""WITH {LINEUP}, latest AS (SELECT player, team, "position", league, season FROM lineup QUALIFY ROW_NUMBER() OVER (PARTITION BY player, team ORDER BY game DESC, "position" ASC NULLS FIRST, season DESC, league) = 1),
played AS (SELECT player, team, COUNT(DISTINCT game) AS matches_played FROM lineup GROUP BY ALL) SELECT * FROM latest LEFT JOIN played USING (player, team)""")
def player_dimension(spark, d):
    return silver.players(A.lineup(spark, d))


@query(f"WITH {SCORES} SELECT * FROM scores")
def match_scores_outer(spark, d):
    rows = A.read(spark, d, "lineitem").select(F.col("l_orderkey").alias("game"), (F.col("l_linestatus") == "O").alias("is_home"), F.col("l_quantity").cast("string").alias("total_goals"))
    return silver.side_scores_joined(rows)


@query(f"WITH {SCORES} SELECT * FROM scores")
def match_scores_one_pass(spark, d):
    rows = A.read(spark, d, "lineitem").select(F.col("l_orderkey").alias("game"), (F.col("l_linestatus") == "O").alias("is_home"), F.col("l_quantity").cast("string").alias("total_goals"))
    return silver.side_scores(rows)


def _goal_rows(spark, d):
    return A.read(spark, d, "lineitem").select(F.col("l_orderkey").alias("game"), (F.col("l_linestatus") == "O").alias("is_home"), F.col("l_quantity").alias("total_goals"))


@query(MATCH)
def match_statistics(spark, d):
    return silver.match_statistics(A.schedule(spark, d), A.matchsheet(spark, d), _goal_rows(spark, d))


@query(MATCH)
def match_statistics_left_chain(spark, d):
    return silver.match_statistics_left_chain(A.schedule(spark, d), A.matchsheet(spark, d), _goal_rows(spark, d))


@query(f"""WITH {SCHEDULE}, {SCORES}, m AS (SELECT s.*, CASE WHEN home_score IS NOT NULL OR away_score IS NOT NULL THEN coalesce(home_score, 0) END AS home_score,
  CASE WHEN home_score IS NOT NULL OR away_score IS NOT NULL THEN coalesce(away_score, 0) END AS away_score FROM schedule s LEFT JOIN scores USING (game))
SELECT *, home_score + away_score AS total_goals, abs(home_score - away_score) AS goal_diff, home_score = away_score AS is_draw,
  CASE WHEN home_score IS NULL THEN NULL WHEN home_score > away_score THEN home_team WHEN home_score < away_score THEN away_team ELSE 'Draw' END AS winner FROM m""")
def match_metrics_zero_fill(spark, d):
    return silver.match_metrics_zero_fill(silver.scored_schedule(A.schedule(spark, d), _goal_rows(spark, d)))


@query("""SELECT o_orderkey AS game, o_orderpriority AS home_team, CAST(o_custkey AS VARCHAR) AS away_team, CAST(TRUNC(o_totalprice) AS INT) AS home_score, CAST(o_custkey AS INT) AS away_score,
  CAST(TRUNC(o_totalprice) AS INT) + CAST(o_custkey AS INT) AS total_goals, abs(CAST(TRUNC(o_totalprice) AS INT) - CAST(o_custkey AS INT)) AS goal_diff, CAST(TRUNC(o_totalprice) AS INT) = CAST(o_custkey AS INT) AS is_draw,
  CASE WHEN TRUNC(o_totalprice) > o_custkey THEN o_orderpriority WHEN TRUNC(o_totalprice) < o_custkey THEN CAST(o_custkey AS VARCHAR) ELSE 'Draw' END AS winner FROM orders""")
def match_scores_from_schedule(spark, d):
    o = A.read(spark, d, "orders").select(F.col("o_orderkey").alias("game"), F.col("o_orderpriority").alias("home_team"), F.col("o_custkey").cast("string").alias("away_team"), F.col("o_totalprice").cast("string").alias("home_score"), F.col("o_custkey").cast("string").alias("away_score"))
    return silver.with_result(silver.scored_schedule(o, o), F.col("home_score"), F.col("away_score"))


@query(f'WITH {LINEUP} SELECT game, player, team, league, season, is_home, "position", starter, goals AS total_goals, assists AS goal_assists, yellow AS yellow_cards FROM lineup')
def player_match_stats(spark, d):
    return silver.player_match_stats(A.lineup(spark, d))


@query(f"WITH {LINEUP} SELECT player, team, COUNT(*) AS n, COUNT(*) AS reference_started, CAST(COUNT(*) FILTER (WHERE starter) AS BIGINT) AS kept_started FROM lineup GROUP BY ALL")
def starter_modes(spark, d):
    rows = A.lineup(spark, d)
    both = rows.select("player", "team", silver.starter(rows.columns, "reference").alias("r"), silver.starter(rows.columns, "keep").alias("k"))
    return both.groupBy("player", "team").agg(F.count("*").alias("n"), F.count_if("r").alias("reference_started"), F.count_if("k").alias("kept_started"))


@query("SELECT event_type, user_id, event_id AS game_id, 2024 AS season, 'BRA-Brasileirao' AS league FROM events")
def match_events(spark, d):
    e = A.read(spark, d, "events").select("event_type", "user_id", F.concat("event_id", F.lit(".0")).alias("game_id"))
    return silver.match_events(e, 2024, "BRA-Brasileirao")


SEASON = f"""WITH {LINEUP} SELECT player, team, league, season, COUNT(DISTINCT game) AS matches_played, CAST(SUM(CASE WHEN starter THEN 1 ELSE 0 END) AS BIGINT) AS matches_started,
  CAST(SUM(goals) AS BIGINT) AS goals, CAST(SUM(assists) AS BIGINT) AS assists, CAST(SUM(yellow) AS BIGINT) AS yellow_cards, CAST(SUM(goals) + SUM(assists) AS BIGINT) AS goal_contributions,
  ROUND(SUM(goals) / COUNT(DISTINCT game), 2) AS goals_per_match FROM lineup GROUP BY player, team, league, season"""


@query(SEASON)
def player_season_stats(spark, d):
    return gold.player_season_stats(silver.player_match_stats(A.lineup(spark, d)))


@query(SEASON + " ORDER BY goals DESC, player, team, season LIMIT 10")
def top_season_scorers(spark, d):
    return gold.top_scorers(player_season_stats(spark, d))


@query("SELECT l_partkey AS player, l_suppkey AS team, CAST(SUM(CAST(l_quantity AS INT)) AS BIGINT) AS goals, CAST(SUM(l_linenumber) AS BIGINT) AS assists, COUNT(*) AS matches FROM lineitem GROUP BY ALL HAVING SUM(CAST(l_quantity AS INT)) > 0 ORDER BY goals DESC, player, team LIMIT 15")
def top_scorers_having(spark, d):
    A.read(spark, d, "lineitem").createOrReplaceTempView("pitchlake_lineitem")
    return spark.sql("SELECT l_partkey AS player, l_suppkey AS team, SUM(CAST(l_quantity AS INT)) AS goals, SUM(l_linenumber) AS assists, COUNT(*) AS matches FROM pitchlake_lineitem GROUP BY ALL HAVING SUM(CAST(l_quantity AS INT)) > 0 ORDER BY goals DESC, player, team LIMIT 15")


@query(f"WITH {SCORES} SELECT game, home_score + away_score AS total_goals FROM scores WHERE home_score + away_score > 0 ORDER BY total_goals DESC, game LIMIT 10")
def top_matches(spark, d):
    total = silver.side_scores(_goal_rows(spark, d)).select("game", (F.col("home_score") + F.col("away_score")).alias("total_goals"))
    return total.filter("total_goals > 0").orderBy(F.desc("total_goals"), "game").limit(10)


@query("SELECT o_orderkey, o_custkey, year(o_orderdate) AS season, o_orderstatus AS league FROM orders WHERE year(o_orderdate) = 1997 AND o_orderstatus = 'F'")
def partition_scan(spark, d):
    """Written by season and league, then read back: only the wanted partition's files are opened."""
    path = f"{_folder(spark)}/parts"
    o = A.read(spark, d, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("season"), F.col("o_orderstatus").alias("league"))
    o.repartition("season", "league").write.partitionBy("season", "league").parquet(path)
    return readers.partition_scan(spark.read.schema("o_orderkey long, o_custkey long, season int, league string").parquet(path), 1997, "F")


@query("SELECT e.event_id, e.event_id % 20000 AS game, o.game_id FROM events e LEFT JOIN (SELECT o_orderkey AS game, MIN(o_custkey) AS game_id FROM orders GROUP BY 1) o ON e.event_id % 20000 = o.game")
def events_game_id(spark, d):
    e = A.read(spark, d, "events").select("event_id", (F.col("event_id") % 20000).alias("game"))
    return lineup.events_with_game_id(e, A.read(spark, d, "orders").select(F.col("o_orderkey").alias("game"), F.col("o_custkey").alias("game_id")))


IDS = """rows_ AS (SELECT l_orderkey AS game, l_partkey AS player, l_suppkey AS team FROM lineitem),
ids AS (SELECT l_orderkey AS game, l_partkey AS player, l_suppkey AS team, l_partkey * 10 AS athlete_id, l_orderkey + 1 AS game_id FROM lineitem WHERE l_linenumber <= 3
  QUALIFY ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_partkey, l_suppkey ORDER BY l_partkey) = 1)"""


def _enriched(spark, d):
    li = A.read(spark, d, "lineitem").select(F.col("l_orderkey").alias("game"), F.col("l_partkey").alias("player"), F.col("l_suppkey").alias("team"), "l_linenumber")
    rosters = li.filter("l_linenumber <= 3").select("game", "player", "team", (F.col("player") * 10).alias("athlete_id"), (F.col("game") + 1).alias("game_id"))
    return lineup.lineup_ids(li.drop("l_linenumber"), rosters)


@query(f"WITH {IDS} SELECT r.*, athlete_id, game_id FROM rows_ r LEFT JOIN ids USING (game, player, team)")
def lineup_enrichment(spark, d):
    return _enriched(spark, d)


@query(f"WITH {IDS} SELECT ROUND(100.0 * COUNT(athlete_id) / COUNT(*), 6) AS coverage_pct FROM rows_ r LEFT JOIN ids USING (game, player, team)")
def id_coverage(spark, d):
    return lineup.coverage(_enriched(spark, d), "athlete_id").select(F.round("coverage_pct", 6).alias("coverage_pct"))


MSG = """msgs AS (SELECT event_id AS line_no, CASE WHEN event_id % 2 = 1 THEN upper(event_type) ELSE ' ' || event_type || chr(9) END AS entity_type, CAST(user_id AS VARCHAR) AS entity_id,
  'json' AS payload_format, '/data/' || event_id || '.json' AS path, 'ESPN' AS provider, 'BRA-"Serie\\A"' AS league, year(ts) AS season, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS created_at FROM events),
esc AS (SELECT *, to_json(entity_type)::VARCHAR AS je, to_json(league)::VARCHAR AS jl FROM msgs),
hashed AS (SELECT line_no, sha256('{"created_at": "' || created_at || '", "entity_id": "' || entity_id || '", "entity_type": ' || je || ', "league": ' || jl || ', "path": "' || path || '", "provider": "ESPN", "season": ' || season || '}') AS message_hash,
  sha256('{"entity_id": "' || entity_id || '", "entity_type": "' || lower(trim(entity_type, ' ' || chr(9))) || '", "league": ' || lower(jl) || ', "provider": "espn", "season": "' || season || '"}') AS dedupe_key FROM esc)"""


def _hashed(spark, d):
    return ingest.with_hashes(A.messages(spark, d)).select("line_no", "message_hash", "dedupe_key")


@query(f"WITH {MSG} SELECT * FROM hashed")
def message_hashes(spark, d):
    return _hashed(spark, d)


@query(f"WITH {MSG} SELECT line_no, dedupe_key, CASE WHEN ROW_NUMBER() OVER (PARTITION BY dedupe_key ORDER BY line_no) = 1 THEN 'first' ELSE 'duplicate_in_pending' END AS status FROM hashed")
def queue_dedupe(spark, d):
    first, more = ingest.split_duplicates(_hashed(spark, d).select("line_no", "dedupe_key"))
    return first.withColumn("status", F.lit("first")).unionByName(more)


DONE = """first AS (SELECT m.*, h.message_hash, h.dedupe_key FROM msgs m JOIN hashed h USING (line_no)), done AS (SELECT f.*, value FROM first f JOIN events ON line_no = event_id WHERE value > 90),
keyed AS (SELECT DISTINCT dedupe_key FROM done WHERE value > 95), legacy AS (SELECT DISTINCT lower(trim(entity_type, ' ' || chr(9))) AS t, entity_id, season FROM done WHERE value <= 95)"""
HIT = "(EXISTS (SELECT 1 FROM keyed k WHERE k.dedupe_key = f.dedupe_key) OR EXISTS (SELECT 1 FROM legacy g WHERE g.t = lower(trim(f.entity_type, ' ' || chr(9))) AND g.entity_id = f.entity_id AND g.season = f.season))"


def _done(spark, d):
    """All messages against those of a high value as done events; the highest have a key."""
    m = ingest.with_hashes(A.messages(spark, d))
    value = A.read(spark, d, "events").select(F.col("event_id").alias("line_no"), "value")
    events = m.join(value, "line_no").filter("value > 90").withColumns({"dedupe_key": F.when(F.col("value") > 95, F.col("dedupe_key")), "status": F.lit("done")})
    return ingest.split_done(m, events)


@query(f"WITH {MSG}, {DONE} SELECT line_no, 'already_done_in_db' AS status FROM first f WHERE {HIT}")
def queue_done_split_semi(spark, d):
    return _done(spark, d)[1].select("line_no", "status")


@query(f"WITH {MSG}, {DONE} SELECT line_no FROM first f WHERE NOT {HIT}")
def queue_done_split_anti(spark, d):
    return _done(spark, d)[0].select("line_no")


@query("SELECT event_id AS line_no, CASE WHEN ROW_NUMBER() OVER (ORDER BY event_id) <= 100 THEN 'batch' ELSE 'remaining' END AS part FROM events")
def queue_batch_split(spark, d):
    now, later = ingest.batch_split(A.read(spark, d, "events").select(F.col("event_id").alias("line_no")))
    return now.withColumn("part", F.lit("batch")).unionByName(later.withColumn("part", F.lit("remaining")))


SLUG = "trim(regexp_replace({0}, '[^a-zA-Z0-9]+', '_', 'g'), '_')"


@query(f"SELECT page_id, coalesce(nullif(lower({SLUG.format('url')}), ''), 'unknown') AS url_slug FROM pages")
def slugify(spark, d):
    return A.read(spark, d, "pages").select("page_id", S.slug(F.col("url")).alias("url_slug"))


@query(f"SELECT p_partkey, CASE WHEN n = '' THEN 'col_unknown' WHEN regexp_matches(n, '^[0-9]') THEN 'col_' || n ELSE n END AS name_id, CASE WHEN b = '' THEN 'col_unknown' WHEN regexp_matches(b, '^[0-9]') THEN 'col_' || b ELSE b END AS key_id FROM (SELECT p_partkey, lower({SLUG.format('p_name')}) AS n, lower({SLUG.format('''(p_partkey || ' ' || p_brand)''')}) AS b FROM part)")
def normalize_identifier(spark, d):
    return A.read(spark, d, "part").select("p_partkey", S.normalize_identifier(F.col("p_name")).alias("name_id"), S.normalize_identifier(F.concat_ws(" ", F.col("p_partkey").cast("string"), "p_brand")).alias("key_id"))


@query("SELECT page_id, CASE WHEN len(g) > 0 THEN CAST(list_sum(list_transform(g, lambda x: CAST(x AS INT))) AS INT) END AS minute FROM (SELECT page_id, regexp_extract_all(url, '[0-9]{1,3}') AS g FROM pages)")
def clock_minutes(spark, d):
    return A.read(spark, d, "pages").select("page_id", S.clock_minute(F.col("url")).alias("minute"))


@query("""SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS k, '{"event_id":' || event_id || ',"event_type":"' || event_type || '","missing":null}' AS payload_json FROM events""")
def json_fields(spark, d):
    e = A.read(spark, d, "events").withColumn("missing", F.lit(None).cast("string"))
    return e.select("event_id", F.from_json("props", "k int")["k"].alias("k"), S.row_json("event_id", "event_type", "missing").alias("payload_json"))


#: Events as new rows for users and orders: each user comes many times, and the last event counts.
NEW = "last AS (SELECT user_id AS id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1)"


@query(f"""WITH {NEW} SELECT o_orderkey AS id, CAST(NULL AS VARCHAR) AS note, o_custkey AS value FROM orders WHERE o_orderkey NOT IN (SELECT id FROM last) UNION ALL
SELECT id, event_type AS note, coalesce(o_custkey, event_id) AS value FROM last LEFT JOIN orders ON o_orderkey = id""")
def upsert_rows(spark, d):
    old = A.read(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("value"))
    new = A.read(spark, d, "events").select(F.col("user_id").alias("id"), F.col("event_id").alias("value"), F.col("event_type").alias("note"))
    return ingest.upsert(old.withColumn("note", F.lit(None).cast("string")), new, ["id"], keep=("value",), order=F.col("value"))


@query("SELECT o_orderkey AS id, 'order' AS origin FROM orders UNION ALL SELECT event_id, 'event' FROM events WHERE event_id NOT IN (SELECT o_orderkey FROM orders)")
def insert_ignore(spark, d):
    old = A.read(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.lit("order").alias("origin"))
    return ingest.insert_ignore(old, A.read(spark, d, "events").select(F.col("event_id").alias("id"), F.lit("event").alias("origin")), ["id"])


@query(f"""WITH {NEW} SELECT o_orderkey AS message_hash, CASE WHEN id IS NOT NULL THEN 'done' ELSE 'failed' END AS status, o_orderpriority AS entity_type, CASE WHEN id IS NULL THEN 'boom' ELSE event_type END AS error, CASE WHEN id IS NOT NULL THEN event_id ELSE 0 END AS processed_at FROM orders LEFT JOIN last ON id = o_orderkey
UNION ALL SELECT id, 'done', event_type, event_type, event_id FROM last WHERE id NOT IN (SELECT o_orderkey FROM orders)""")
def event_upsert(spark, d):
    old = A.read(spark, d, "orders").select(F.col("o_orderkey").alias("message_hash"), F.lit("failed").alias("status"), F.col("o_orderpriority").alias("entity_type"), F.lit("boom").alias("error"), F.lit(0).cast("long").alias("processed_at"))
    new = A.read(spark, d, "events").select(F.col("user_id").alias("message_hash"), F.lit("done").alias("status"), F.col("event_type").alias("entity_type"), F.col("event_type").alias("error"), F.col("event_id").alias("processed_at"))
    return ingest.upsert_events(old, new, F.col("processed_at"))


@query("""WITH r AS (SELECT event_id, event_type, props, CASE WHEN event_type IN ('click', 'view') THEN 'match' WHEN event_type = 'error' THEN 'season' ELSE 'team' END AS entity FROM events)
SELECT event_id, CASE entity WHEN 'season' THEN 'Unsupported entity_type: season' WHEN 'team' THEN CASE WHEN event_type = 'signup' THEN 'Payload for team contains non-object items' END END AS error,
  CASE WHEN entity = 'match' THEN 1 WHEN event_type = 'purchase' THEN 2 ELSE 0 END AS n_rows FROM r""")
def payload_shapes(spark, d):
    """Objects for matches, lists for teams (one kind with an item that is no object), and a type that isn't supported."""
    e = A.read(spark, d, "events")
    entity = F.when(F.col("event_type").isin("click", "view"), "match").when(F.col("event_type") == "error", "season").otherwise("team")
    text = F.when(entity == "match", F.col("props")).when(F.col("event_type") == "signup", F.concat(F.lit("["), "props", F.lit(",3]"))).otherwise(F.concat(F.lit("["), "props", F.lit(","), "props", F.lit("]")))
    payloads = e.select(F.col("event_id").cast("string").alias("message_hash"), entity.alias("entity_type"), F.parse_json(text).alias("payload"))
    rows = ingest.to_rows(payloads).groupBy("message_hash").agg(F.count("*").cast("int").alias("n_rows"))
    errors = payloads.select("message_hash", ingest.payload_error(F.col("entity_type"), F.col("payload")).alias("error"))
    return errors.join(rows, "message_hash", "left").select(F.col("message_hash").cast("long").alias("event_id"), "error", F.coalesce("n_rows", F.lit(0)).alias("n_rows"))


@query("""SELECT CAST(event_id AS VARCHAR) AS meta_message_hash, 0 AS meta_row_index, CAST(user_id AS VARCHAR) AS meta_entity_id, json_extract_string(props, '$.k') AS k, event_type AS src_payload_json, CASE WHEN event_type = 'view' THEN 'True' END AS col_1st,
  CASE WHEN event_type <> 'view' THEN '[1,{"a":null}]' END AS a_b FROM events""")
def dynamic_columns(spark, d):
    """Every key of every payload as a text column; names are normalised and may clash with meta columns or each other."""
    e = A.read(spark, d, "events")
    hash_ = F.col("event_id").cast("string").alias("message_hash")
    more = F.when(F.col("event_type") == "view", F.lit(',"1st":true}')).otherwise(F.lit(',"A b":0,"a-b":[1,{"a":null}]}'))
    text = F.concat(F.substring_index("props", "}", 1), F.lit(',"Payload JSON":"'), "event_type", F.lit('"'), more)
    rows = ingest.to_rows(e.select(hash_, F.lit("match").alias("entity_type"), F.parse_json(text).alias("payload")))
    messages = e.select(hash_, F.col("user_id").alias("entity_id"), F.lit("x").alias("provider"), F.lit("l").alias("league"), F.lit(2024).alias("season"), F.lit("p").alias("path"), F.lit(None).cast("string").alias("created_at"))
    names = sorted(r[0] for r in ingest.payload_names(rows).collect())
    return ingest.dynamic_rows(rows, messages, names).drop("meta_entity_type", "meta_provider", "meta_league", "meta_season", "meta_source_path", "meta_source_created_at", "meta_ingested_at", "payload_json")


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey = (SELECT max(c_custkey) FROM customer WHERE c_mktsegment = 'BUILDING' AND c_nationkey = 7)")
def scalar_lookup(spark, d):
    """A scalar subquery's one value, met by a broadcast join."""
    one = A.read(spark, d, "customer").filter("c_mktsegment = 'BUILDING' and c_nationkey = 7").agg(F.max("c_custkey").alias("o_custkey"))
    return A.read(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice").join(F.broadcast(one), "o_custkey")


@query("SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 25")
def head_rows(spark, d):
    return readers.head(A.read(spark, d, "orders").select("o_orderkey", "o_orderdate"), 25, "o_orderdate", "o_orderkey")


@query("""WITH t AS (SELECT count(*) AS n, count(*) FILTER (WHERE o_orderpriority IS NULL OR o_orderpriority = '') AS bad, count(o_totalprice) AS scores FROM orders),
p AS (SELECT count(*) AS n, count(*) FILTER (WHERE text IS NULL OR text = '') AS bad FROM documents)
SELECT 'teams_not_empty' AS check_name, CASE WHEN n > 0 THEN 'pass' ELSE 'fail' END AS status FROM t UNION ALL SELECT 'team_name_null_rate_ok', CASE WHEN bad = 0 THEN 'pass' WHEN bad <= 0.05 * n THEN 'warn' ELSE 'fail' END FROM t
UNION ALL SELECT 'players_not_empty', CASE WHEN n > 0 THEN 'pass' ELSE 'fail' END FROM p UNION ALL SELECT 'player_name_null_rate_ok', CASE WHEN bad = 0 THEN 'pass' WHEN bad <= 0.05 * n THEN 'warn' ELSE 'fail' END FROM p
UNION ALL SELECT 'player_team_null_rate_ok', 'fail' UNION ALL SELECT 'match_statistics_not_empty', CASE WHEN n > 0 THEN 'pass' ELSE 'fail' END FROM t UNION ALL SELECT 'match_game_null_rate_ok', 'pass'
UNION ALL SELECT 'home_score_not_all_null', CASE WHEN scores > 0 THEN 'pass' ELSE 'fail' END FROM t UNION ALL SELECT 'player_match_stats_not_empty', 'fail' UNION ALL SELECT 'player_match_game_null_rate_ok', 'fail'""")
def quality_catalogue(spark, d):
    """The ten Silver checks on stand-ins: a column of nulls fails, a missing table fails."""
    o = A.read(spark, d, "orders")
    tables = {"teams": o.select(F.col("o_orderpriority").alias("team_name")), "players": A.read(spark, d, "documents").select(F.col("text").alias("player"), F.lit(None).cast("string").alias("team")), "match_statistics": o.select(F.col("o_orderkey").alias("game"), F.col("o_totalprice").alias("home_score"))}
    rows = quality.evaluate(tables, quality.SILVER)
    return spark.createDataFrame([r[:2] for r in rows], "check_name string, status string")


@query("SELECT s_suppkey AS id, s_name AS name, CAST(NULL AS VARCHAR) AS segment, s_nationkey AS nation FROM supplier UNION ALL SELECT c_custkey, c_name, c_mktsegment, NULL FROM customer")
def union_by_name(spark, d):
    s = A.read(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"))
    c = A.read(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"), F.col("c_name").alias("name"))
    return ingest.merged(s, c)


@query("SELECT 'customer' AS name, COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE c_name IS NULL OR c_name = '') AS nulls FROM customer UNION ALL SELECT 'documents', COUNT(*), COUNT(*) FILTER (WHERE text IS NULL OR text = '') FROM documents UNION ALL SELECT 'labels', COUNT(*), COUNT(*) FILTER (WHERE toxic IS NULL) FROM labels")
def null_rate_checks(spark, d):
    parts = [quality.null_counts(A.read(spark, d, t), [c]).select(F.lit(t).alias("name"), "n_rows", F.col(f"null_{c}").alias("nulls")) for t, c in (("customer", "c_name"), ("documents", "text"), ("labels", "toxic"))]
    return ingest.merged(*parts)


@query("SELECT c_mktsegment, COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE c_name IS NULL OR c_name = '') AS null_c_name FROM customer GROUP BY 1")
def gate_counts(spark, d):
    c = A.read(spark, d, "customer")
    return c.groupBy("c_mktsegment").agg(F.count("*").alias("n_rows"), F.count_if(S.null_or_empty(F.col("c_name"))).alias("null_c_name"))


@query("SELECT p_partkey, 0.0::DOUBLE AS name_number, CAST(p_size AS DOUBLE) AS size_number, p_size AS size_int FROM part")
def to_numeric_coerce(spark, d):
    p = A.read(spark, d, "part")
    return p.select("p_partkey", S.to_numeric(F.concat(F.lit("n"), "p_name")).alias("name_number"), S.to_numeric(F.col("p_size").cast("string")).alias("size_number"), S.safe_int(F.concat(F.col("p_size").cast("string"), F.lit(".0"))).alias("size_int"))


@query("SELECT DISTINCT l_partkey AS athlete_id FROM lineitem WHERE l_partkey IS NOT NULL")
def distinct_ids(spark, d):
    return lineup.distinct_ids(A.read(spark, d, "lineitem").select(F.col("l_partkey").alias("athlete_id")))


@query("SELECT l_orderkey AS game, l_linestatus = 'O' AS is_home, CAST(SUM(CAST(l_quantity AS BIGINT)) AS DOUBLE) AS goals FROM lineitem GROUP BY ALL")
def numeric_side_sums(spark, d):
    return silver.numeric_side_sums(_goal_rows(spark, d))


@query("SELECT user_id, event_type, value FROM events QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY event_id) = 1")
def first_row_per_group(spark, d):
    return silver.first_per_group(A.read(spark, d, "events"), "user_id", "event_id", ["event_type", "value"])


@query("SELECT event_type AS status, COUNT(*) AS n FROM events GROUP BY 1")
def run_counters(spark, d):
    return ingest.run_counters(A.read(spark, d, "events").withColumnRenamed("event_type", "status"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y%m%dT%H%M%S') AS run_id, regexp_replace(o_orderpriority || '/' || o_orderkey, '[^a-zA-Z0-9_]+', '_', 'g') AS workflow_id, substr(o_orderpriority, 1, 3) AS short FROM orders")
def text_formats(spark, d):
    o = A.read(spark, d, "orders")
    return o.select("o_orderkey", S.run_id(F.col("o_orderdate")).alias("run_id"), S.workflow_id(F.concat_ws("/", "o_orderpriority", F.col("o_orderkey").cast("string"))).alias("workflow_id"), S.truncated(F.col("o_orderpriority"), 3).alias("short"))


def _folder(spark: SparkSession) -> str:
    """A fresh folder for round trips, under the shared one that the cluster names; only a local session may do without."""
    import tempfile

    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if shared:
        return f"{shared.rstrip('/')}/trip-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    return tempfile.mkdtemp(prefix="pitchlake-")


@query("SELECT l_suppkey AS team, 's_' || l_suppkey AS team_key, COUNT(*) AS n FROM lineitem GROUP BY ALL")
def fanout_by_team(spark, d):
    """Written by team and read again."""
    path = f"{_folder(spark)}/fan"
    rows = A.read(spark, d, "lineitem").select(F.concat(F.lit("s_"), F.col("l_suppkey").cast("string")).alias("team_key"), F.col("l_suppkey").alias("team"), "l_linenumber")
    sinks.fan_out(rows.repartition("team_key"), "team_key", path)
    back = spark.read.option("header", True).schema("team_key string, team long, l_linenumber int, team_key_slug string").csv(path)
    return back.groupBy("team", "team_key").agg(F.count("*").alias("n"))


@query("SELECT o_orderstatus AS league, year(o_orderdate) AS season, COUNT(*) AS n, CAST(SUM(o_orderkey) AS BIGINT) AS keys FROM orders GROUP BY ALL")
def partition_overwrite_roundtrip(spark, d):
    """Every partition written, one of them twice more by the sink with other rows in between, then read."""
    name = f"trip_{uuid.uuid4().hex}"
    rows = A.read(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("season"), F.col("o_orderstatus").alias("league"))
    rows.repartition("season", "league").write.partitionBy("season", "league").format("parquet").saveAsTable(name)
    try:
        one = readers.partition_scan(rows, 1997, "F")
        for part in (one.withColumn("o_orderkey", F.lit(-1).cast("long")), one):
            sinks.write_partitioned(part, name, 1997, "F")
        found = spark.table(name).groupBy("league", "season").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"))
        return spark.createDataFrame(found.collect(), found.schema)  # a row a partition
    finally:
        sinks.drop_tables(spark, [name])


@query("SELECT s_suppkey AS id, s_name AS name, CASE WHEN s_suppkey = 1 THEN 800 WHEN s_suppkey = 2 THEN 850 END AS goals FROM supplier")
def schema_evolution(spark, d):
    """A column added, then two rows updated."""
    rows = A.read(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")).withColumn("goals", F.lit(None).cast("int"))
    return sinks.updated(sinks.updated(rows, F.col("id") == 1, {"goals": F.lit(800)}), F.col("id") == 2, {"goals": F.lit(850)})


SUMMARY_ROWS = """{"boxscore":{"form":[{"team":{"displayName":"Home FC"}},{"team":{"displayName":"Away FC"}}]},"rosters":[{"roster":[
{"athlete":{"id":"11","displayName":"A"},"position":{"name":"Forward"},"formationPlace":"9","starter":true,"subbedIn":false,"subbedOut":true,"plays":[{"substitution":true,"clock":{"displayValue":"70'"}}],"stats":[{"name":"totalGoals","value":1},{"name":"totalGoals","value":2}]},
{"athlete":{"id":"12"},"starter":false,"subbedIn":{"didSub":true,"clock":{"displayValue":"90+3'"}},"subbedOut":false}]},{"roster":[{"athlete":{"displayName":"C"},"starter":true}]}]}"""


@query("SELECT 'g' || o_orderkey AS game, o_orderkey AS game_id, o_orderstatus AS league, year(o_orderdate) AS season, v.* FROM orders, LATERAL (VALUES ('Home FC', true, o_custkey, 'A', 'Forward', '9', true, 'start', CAST(1 + o_orderkey % 89 AS VARCHAR), CAST(o_orderkey % 7 AS DOUBLE)), ('Home FC', true, 12, 'Unknown', NULL, NULL, false, '93', 'end', NULL), ('Away FC', false, NULL, 'C', NULL, NULL, true, 'start', 'end', NULL)) v(team, is_home, athlete_id, player, \"position\", formation_place, starter, sub_in, sub_out, \"totalGoals\")")
def roster_explode(spark, d):
    """A summary for every order, with an id, a minute and goals of its own."""
    info = A.read(spark, d, "orders").select(F.concat(F.lit("g"), "o_orderkey").alias("game"), F.col("o_orderkey").alias("game_id"), F.col("o_orderstatus").alias("league"), F.year("o_orderdate").alias("season"), "o_custkey")
    own = [('"id":"11"', F.concat(F.lit('"id":"'), "o_custkey", F.lit('"'))), ("70'", F.concat((F.col("game_id") % 89 + 1).cast("string"), F.lit("'"))), ('"value":2', F.concat(F.lit('"value":'), F.col("game_id") % 7))]
    doc = F.lit(SUMMARY_ROWS)
    for old, new in own:
        doc = F.replace(doc, F.lit(old), new)
    return lineup.roster_rows(info.select("*", F.from_json(doc, schemas.SUMMARY).alias("s")).select("*", "s.*").drop("o_custkey"), ("totalGoals",))


@query("""SELECT 'g' || l_orderkey AS game, 'A' AS player, CASE WHEN l_linestatus = 'O' THEN 'Home FC' ELSE 'Nowhere' END AS team, l_linenumber,
  CASE WHEN l_linestatus = 'O' AND o_orderstatus <> 'P' THEN 11 END::BIGINT AS athlete_id, CASE WHEN l_linestatus = 'O' AND o_orderstatus <> 'P' THEN l_orderkey END AS game_id
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey""")
def lineup_from_summaries(spark, d):
    """Ids from summaries to line-ups; matches of one status have no summary, and one side's team isn't in any."""
    li = A.read(spark, d, "lineitem").select(F.concat(F.lit("g"), "l_orderkey").alias("game"), F.lit("A").alias("player"), F.when(F.col("l_linestatus") == "O", "Home FC").otherwise("Nowhere").alias("team"), "l_linenumber")
    o = A.read(spark, d, "orders")
    schedule = o.select(F.concat(F.lit("g"), "o_orderkey").alias("game"), F.col("o_orderkey").alias("game_id"))
    found = o.filter("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("game_id"), F.from_json(F.lit(SUMMARY_ROWS), schemas.SUMMARY).alias("s")).select("game_id", "s.*")
    return lineup.enriched_lineup(li, schedule, found, "BRA-Brasileirao", 2024)


#: starter, subbedIn, subbedOut, minutes of substitutions among the plays, expected sub_in and sub_out; A and B stand for two minutes of the order.
SUBSTITUTIONS = [
    (True, None, None, "", "start", "end"), (True, "false", "true", "A", "start", "A"), (True, "false", "true", "", "start", None),
    (True, None, '{"didSub":true,"clock":{"displayValue":"A"}}', "", "start", None), (True, '{"didSub":false}', '{"didSub":true,"clock":{"displayValue":"A"}}', "", "start", "A"),
    (False, '{"didSub":true,"clock":{"displayValue":"A"}}', None, "", "A", "end"), (False, '{"didSub":true,"clock":{"displayValue":"A"}}', '{"didSub":true,"clock":{"displayValue":"B"}}', "", "A", "B"),
    (False, "true", "true", "AB", "A", "B"), (False, "true", "true", "A", "A", None), (False, '{"didSub":true,"clock":{"displayValue":"A"}}', "true", "", "A", None), (False, None, "false", "", None, None),
]


def _expected(column: int) -> str:
    word = {"A": "CAST(a AS VARCHAR)", "B": "CAST(a + b AS VARCHAR)", None: "NULL"}
    return "CASE k " + " ".join(f"WHEN {i} THEN {word.get(r[column], repr(r[column]))}" for i, r in enumerate(SUBSTITUTIONS)) + " END"


@query(f"""WITH c AS (SELECT o_orderkey, o_orderkey % {len(SUBSTITUTIONS)} AS k, o_custkey % 89 + 1 AS a, o_orderkey % 9 + 1 AS b FROM orders) SELECT o_orderkey AS id, {_expected(4)} AS sub_in, {_expected(5)} AS sub_out FROM c""")
def substitution_minutes(spark, d):
    """The truth table of substitutions, a case an order, with minutes (45+3') of its own."""
    o = A.read(spark, d, "orders")
    k = F.col("o_orderkey") % len(SUBSTITUTIONS)
    first = F.concat((F.col("o_custkey") % 89 + 1).cast("string"), F.lit("'"))
    second = F.concat((F.col("o_custkey") % 89 + 1).cast("string"), F.lit("+"), (F.col("o_orderkey") % 9 + 1).cast("string"), F.lit("'"))

    def case(column: int) -> Column:
        found = F.lit(None).cast("string")
        for i, r in enumerate(SUBSTITUTIONS):
            found = F.when(k == i, F.lit(r[column]).cast("string")).otherwise(found)
        return found

    timed = lambda c: F.replace(F.replace(c, F.lit('"A"'), F.concat(F.lit('"'), first, F.lit('"'))), F.lit('"B"'), F.concat(F.lit('"'), second, F.lit('"')))
    play = lambda minute: F.struct(F.lit(True).alias("substitution"), F.struct(minute.alias("displayValue")).alias("clock"))
    plays = F.slice(F.array(play(first), play(second)), 1, F.length(case(3)))
    rows = o.select(F.col("o_orderkey").alias("id"), (case(0) == "true").alias("starter"), timed(case(1)).alias("i"), timed(case(2)).alias("o"), plays.alias("plays"))
    entered, left = lineup.substitution(F.col("starter"), F.col("i"), F.col("o"), F.col("plays"))
    return rows.select("id", entered.alias("sub_in"), left.alias("sub_out"))


@query("""SELECT c_custkey AS espn_athlete_id, CAST(NULL AS VARCHAR) AS espn_guid, CAST(NULL AS VARCHAR) AS first_name, CAST(NULL AS VARCHAR) AS last_name, CASE WHEN c_nationkey > 9 THEN c_name END AS display_name, CAST(NULL AS VARCHAR) AS full_name, CAST(NULL AS VARCHAR) AS jersey,
  CAST(NULL AS VARCHAR) AS position_id, CASE WHEN c_nationkey > 9 THEN c_mktsegment END AS position_name, CAST(NULL AS VARCHAR) AS team_id, CASE WHEN c_nationkey > 9 THEN 'T' END AS team_name, CAST(NULL AS VARCHAR) AS date_of_birth, CASE WHEN c_nationkey > 9 THEN c_nationkey END AS age,
  CAST(NULL AS VARCHAR) AS gender, CASE WHEN c_nationkey > 9 THEN true END AS is_active, CASE WHEN c_nationkey > 9 THEN 'http://x/card' END AS profile_url FROM customer""")
def profile_flatten(spark, d):
    """A profile for every customer; those of some nations are empty, so that the requested id counts."""
    c = A.read(spark, d, "customer")
    full = F.concat(F.lit('{"athlete":{"id":"'), "c_custkey", F.lit('","displayName":"'), "c_name", F.lit('","position":{"name":"'), "c_mktsegment", F.lit('"},"team":{"displayName":"T"},"active":true,"age":'), "c_nationkey", F.lit(',"links":[{"rel":["stats"],"href":"http://x/s"},{"rel":["overview"],"href":"http://x/card"}]}}'))
    doc = F.when(F.col("c_nationkey") > 9, full).otherwise('{"athlete":{}}')
    return lineup.profile_rows(c.select(F.from_json(doc, schemas.PROFILE).alias("p"), F.col("c_custkey").cast("string").alias("requested_id")).select("p.*", "requested_id")).drop("_raw")


#: Seasons are the years of each order status; their state comes from how many orders they have.
CONTROL = """n AS (SELECT o_orderstatus AS league_key, CAST(year(o_orderdate) AS INT) AS season, COUNT(*) AS n FROM orders GROUP BY ALL),
control AS (SELECT row_number() OVER (ORDER BY league_key, season) AS id, league_key, season, ['pending', 'bronze_done', 'silver_done', 'failed', 'complete'][1 + n % 5] AS status,
  CASE WHEN n % 5 = 3 THEN ['bronze', 'silver', 'gold'][1 + n % 3] END AS last_error_stage FROM n)"""


def _control(spark, d):
    n = A.read(spark, d, "orders").groupBy(F.col("o_orderstatus").alias("league_key"), F.year("o_orderdate").alias("season")).agg(F.count("*").alias("n"))
    pick = lambda words, by: F.element_at(F.array(*map(F.lit, words)), (F.col("n") % by + 1).cast("int"))
    rows = n.withColumns({"id": F.row_number().over(Window.orderBy("league_key", "season")).cast("long"), "status": pick(("pending", "bronze_done", "silver_done", "failed", "complete"), 5), "last_error_stage": F.when(F.col("n") % 5 == 3, pick(("bronze", "silver", "gold"), 3))})  # a row a season
    return control.empty(spark).unionByName(rows.drop("n"), allowMissingColumns=True)


READY = """s(stage, ready) AS (VALUES ('bronze', 'pending'), ('silver', 'bronze_done'), ('gold', 'silver_done')), l(asked) AS (VALUES (NULL), ('F'), ('O'), ('P'))"""


@query(f"""WITH {CONTROL}, {READY} SELECT stage, asked, id, league_key, season, status FROM s, l JOIN control ON status = ready OR (status = 'failed' AND last_error_stage = stage)
WHERE asked IS NULL OR league_key = asked QUALIFY row_number() OVER (PARTITION BY stage, asked ORDER BY season DESC, league_key) = 1""")
def season_state_machine(spark, d):
    """The season each stage would take next, of all leagues and of each."""
    t = _control(spark, d)
    parts = [control.pending_season(t, s, league).select(F.lit(s).alias("stage"), F.lit(league).cast("string").alias("asked"), "id", "league_key", "season", "status") for s in control.STAGES for league in (None, "F", "O", "P")]
    return ingest.merged(*parts)


@query("""SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE CAST(value AS DOUBLE) END AS clean, '{"k":' || json_extract_string(props, '$.k') || ',"t":"' || event_type || '"}' AS nested, '[1,' || event_id || ']' AS listed, CAST(event_id AS VARCHAR) AS plain,
  lower(event_type) AS entity_type, CAST(user_id AS VARCHAR) AS entity_id, '' AS provider, 'bra-x' AS league, CAST(year(ts) AS VARCHAR) AS season FROM events""")
def stored_values(spark, d):
    """Stored text of nested values, NaN as null, and the folded signature of an event."""
    e = A.read(spark, d, "events")
    value = S.nan_to_null(F.when(F.col("event_type") == "error", float("nan")).otherwise(F.col("value").cast("double")))
    k = F.from_json("props", "k int")["k"]
    rows = e.select("event_id", value.alias("clean"), S.text_value(F.struct(k.alias("k"), F.col("event_type").alias("t")), "struct").alias("nested"), S.text_value(F.array(F.lit(1).cast("long"), "event_id"), "array").alias("listed"), S.text_value(F.col("event_id"), "bigint").alias("plain"), F.upper("event_type").alias("entity_type"), F.col("user_id").alias("entity_id"), F.lit(None).cast("string").alias("provider"), F.lit(" BRA-x\n").alias("league"), F.year("ts").alias("season"))
    return rows.withColumn("s", S.event_signature({f: F.col(f) for f in S.KEY_FIELDS})).select("event_id", "clean", "nested", "listed", "plain", "s.*")


@query("SELECT row_number() OVER (ORDER BY event_id) - 1 AS line_no, CASE WHEN event_type <> 'error' THEN CAST(user_id AS VARCHAR) END AS entity_id, event_type = 'error' AS failed FROM events")
def queue_file_roundtrip(spark, d):
    """Events written as queue lines in their order, one kind as broken ones, and read again with line numbers."""
    path = f"{_folder(spark)}/pending.jsonl"
    e = A.read(spark, d, "events")
    line = F.when(F.col("event_type") == "error", F.concat(F.lit("{broken "), "event_id")).otherwise(F.to_json(F.struct("event_type", F.col("user_id").cast("string").alias("entity_id"))))
    e.orderBy("event_id").select(line.alias("value")).write.text(path)
    good, bad = readers.jsonl_queue(spark, path)
    return good.select("line_no", "entity_id", F.lit(False).alias("failed")).unionByName(bad.select("line_no", F.lit(None).cast("string").alias("entity_id"), F.lit(True).alias("failed")))


SEASONS = """m AS (SELECT event_id, ts, event_type, CAST(user_id AS VARCHAR) AS u, CASE event_type WHEN 'view' THEN '"' || year(ts) || '-25"' WHEN 'click' THEN year(ts) || '.5' WHEN 'purchase' THEN 'null' WHEN 'signup' THEN CAST(year(ts) AS VARCHAR) ELSE year(ts) || '.0' END AS s FROM events)"""


@query(f"""WITH {SEASONS} SELECT event_id AS line_no, CASE WHEN s <> 'null' THEN trim(s, '"') END AS season, sha256('{{"created_at": "' || strftime(ts, '%Y-%m-%d') || '", "entity_id": "' || u || '", "entity_type": "match", "league": "L", "path": null, "provider": "p", "season": ' || s || '}}') AS message_hash,
  sha256('{{"entity_id": "' || CASE WHEN u = '0' THEN '' ELSE u END || '", "entity_type": "match", "league": "l", "provider": "p", "season": "' || CASE WHEN s = 'null' THEN '' ELSE trim(s, '"') END || '"}}') AS dedupe_key FROM m""")
def queue_seasons(spark, d):
    """Messages with a season as text, fraction, null and number, ids as numbers, and keys that no schema knows; each hashed as it stands."""
    e = A.read(spark, d, "events")
    year = F.year("ts").cast("string")
    season = F.when(F.col("event_type") == "view", F.concat(F.lit('"'), year, F.lit('-25"'))).when(F.col("event_type") == "click", F.concat(year, F.lit(".5"))).when(F.col("event_type") == "purchase", "null").when(F.col("event_type") == "signup", year).otherwise(F.concat(year, F.lit(".0")))
    raw = F.concat(F.lit('{"entity_type":"match","entity_id":'), "user_id", F.lit(',"provider":"p","league":"L","season":'), season, F.lit(',"created_at":"'), F.date_format("ts", "yyyy-MM-dd"), F.lit('","more":'), "props", F.lit("}"))
    good, _ = readers.parse_lines(e.select(F.col("event_id").alias("line_no"), raw.alias("raw")))
    return ingest.with_hashes(good).select("line_no", "season", "message_hash", "dedupe_key")


@query("SELECT CAST(l_suppkey AS VARCHAR) AS team, year(o_orderdate) AS season, COUNT(*) AS n, CAST(SUM(CAST(l_quantity AS INT)) AS BIGINT) AS goals, SUM(l_linenumber * 0.5) AS more FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL")
def bronze_roundtrip(spark, d):
    """Line-ups landed as a Bronze file and read back whole, typed, with a column that no schema knows."""
    li, o = A.read(spark, d, "lineitem"), A.read(spark, d, "orders")
    rows = li.join(o, li.l_orderkey == o.o_orderkey).select(F.col("l_orderkey").cast("string").alias("game"), F.col("l_partkey").cast("string").alias("player"), F.col("l_suppkey").cast("string").alias("team"), F.lit("x").alias("league"), F.year("o_orderdate").alias("season"), F.lit(True).alias("is_home"), F.col("l_returnflag").alias("position"), F.col("l_quantity").cast("string").alias("total_goals"), (F.col("l_linenumber") * 0.5).alias("more"))
    root = _folder(spark)
    pipeline.land(rows, root, "BRA-Brasileirao", 2024, "lineup")
    back = pipeline.read_bronze(spark, root, "BRA-Brasileirao", 2024, "lineup")
    return back.groupBy("team", "season").agg(F.count("*").alias("n"), F.sum(S.safe_int(F.col("total_goals"))).alias("goals"), F.sum("more").alias("more"))


@query("SELECT s_nationkey AS nation, '[' || string_agg('{\"id\":' || s_suppkey || ',\"name\":\"' || s_name || '\",\"note\":null}', ',' ORDER BY s_suppkey) || ']' AS json FROM supplier GROUP BY 1")
def json_arrays(spark, d):
    """One JSON array a group, nulls kept; rows come in the order of their ids."""
    s = A.read(spark, d, "supplier").select(F.col("s_nationkey").alias("nation"), F.struct(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.lit(None).cast("string").alias("note")).alias("r"))
    ordered = s.groupBy("nation").agg(F.array_sort(F.collect_list("r")).alias("rs"))
    return ordered.select("nation", F.to_json("rs", {"ignoreNullFields": "false"}).alias("json"))


@query("SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer")
def csv_roundtrip(spark, d):
    path = f"{_folder(spark)}/csv"
    sinks.write_csv(A.read(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")), path)
    return spark.read.option("header", True).schema("id long, name string, segment string").csv(path)


@query("""WITH c AS (SELECT n_regionkey AS id, COUNT(*) AS n, COUNT(*) FILTER (WHERE c_nationkey = 3 OR c_mktsegment = '') AS a, COUNT(*) FILTER (WHERE c_mktsegment = 'BUILDING' AND n_regionkey = 2) AS b FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1),
log AS (SELECT id, 'player_season_stats_not_empty' AS check_name, CASE WHEN n > 0 THEN 'pass' ELSE 'fail' END AS status, 'rows=' || n AS details FROM c
  UNION ALL SELECT id, 'player_name_not_null', CASE WHEN a > 0 THEN 'fail' ELSE 'pass' END, 'null_rate=' || printf('%.4f', a / n) FROM c UNION ALL SELECT id, 'team_name_not_null', CASE WHEN b > 0 THEN 'fail' ELSE 'pass' END, 'null_rate=' || printf('%.4f', b / n) FROM c)
SELECT CAST(id AS BIGINT) AS season_id, CASE WHEN id = 4 THEN 'orphan' ELSE 'gold' END AS stage, check_name, status, details FROM log""")
def quality_log(spark, d):
    """The checks of Gold on each region's customers, recorded; the summaries of four regions, and of the last one, which is no season, the orphans."""
    c = A.read(spark, d, "customer").join(A.read(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    log = spark.createDataFrame([], schemas.CHECKS)
    regions = [r[0] for r in A.read(spark, d, "region").select("r_regionkey").orderBy("r_regionkey").collect()]  # five
    for r in regions:
        stats = c.filter(F.col("n_regionkey") == r).select(F.when(F.col("c_nationkey") != 3, F.col("c_name")).alias("player"), F.when((F.col("c_mktsegment") != "BUILDING") | F.lit(r != 2), F.col("c_mktsegment")).alias("team"))
        log = quality.recorded(log, r, "gold", quality.evaluate({"player_season_stats": stats}, quality.GOLD))
    seasons = A.read(spark, d, "region").filter("r_regionkey < 4").select(F.col("r_regionkey").cast("long").alias("id"))
    shown = [quality.summary(quality.cascaded(log, seasons), r, "gold").select(F.lit(r).cast("long").alias("season_id"), "stage", "check_name", "status", "details") for r in regions if r < 4]
    return ingest.merged(*shown, quality.orphans(log, seasons).select("season_id", F.lit("orphan").alias("stage"), "check_name", "status", "details"))


@query("SELECT s_suppkey AS id, s_name AS name, CASE s_suppkey WHEN 1 THEN 800 WHEN 2 THEN 850 END AS goals, s_suppkey <= 3 AS again FROM supplier")
def table_evolution(spark, d):
    """A stored table gets a column and updates, and rows of known keys replace old ones."""
    name = f"trip_{uuid.uuid4().hex}"
    rows = A.read(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    sinks.create_or_replace(rows, name)
    sinks.add_column(spark, name, "goals", "int")
    sinks.rewrite_table(sinks.updated(spark.table(name), F.col("id").isin(1, 2), {"goals": F.col("id").cast("int") * 50 + 750}), name)
    few = spark.table(name).filter("id <= 3").withColumn("again", F.lit(True))
    sinks.store(few, name, ["id"], lambda old, new: ingest.upsert(old, new, ["id"]))
    out = spark.table(name).select("id", "name", "goals", F.coalesce("again", F.lit(False)).alias("again"))
    path = f"{_folder(spark)}/evolved"
    out.write.parquet(path)
    sinks.drop_tables(spark, [name])
    return spark.read.schema("id long, name string, goals int, again boolean").parquet(path)


@query(f"""WITH {CONTROL}, ch AS (SELECT event_id AS moment, 1 + user_id % (SELECT COUNT(*) FROM control) AS id, ['bronze', 'silver', 'gold'][1 + event_id % 3] AS stage,
  CASE event_type WHEN 'view' THEN 'started' WHEN 'click' THEN 'completed' WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'reset' ELSE 'started' END AS outcome, props FROM events),
st AS (SELECT *, CASE outcome WHEN 'failed' THEN 'failed' WHEN 'reset' THEN 'pending' WHEN 'started' THEN stage || '_running' ELSE CASE stage WHEN 'gold' THEN 'complete' ELSE stage || '_done' END END AS after FROM ch),
last AS (SELECT id, arg_max(after, moment) AS after, max(moment) AS changed, COUNT(*) FILTER (WHERE outcome <> 'completed') AS n, max(moment) FILTER (WHERE stage = 'silver' AND outcome = 'completed') AS silver_done FROM st GROUP BY id),
err AS (SELECT id, outcome, stage, props FROM st WHERE outcome <> 'completed' QUALIFY row_number() OVER (PARTITION BY id ORDER BY moment DESC) = 1)
SELECT c.id, league_key, season, coalesce(after, status) AS status, CASE WHEN n > 0 THEN CASE WHEN e.outcome = 'failed' THEN e.stage END ELSE last_error_stage END AS last_error_stage,
  CASE WHEN e.outcome = 'failed' THEN CAST(least(2000, 300 * length(e.props)) AS INT) END AS error_length, silver_done, changed FROM control c LEFT JOIN last USING (id) LEFT JOIN err e USING (id)""")
def season_transitions(spark, d):
    """Every event as what happened to a season in a stage, all folded into the control table; errors are longer than what it keeps."""
    t = _control(spark, d)
    n = t.count()
    stage = F.element_at(F.array(*map(F.lit, control.STAGES)), (F.col("event_id") % 3 + 1).cast("int"))
    outcome = F.when(F.col("event_type") == "click", "completed").when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "signup", "reset").otherwise("started")
    changes = A.read(spark, d, "events").select((F.col("user_id") % n + 1).alias("id"), stage.alias("stage"), outcome.alias("outcome"), F.repeat("props", F.lit(300)).alias("error"), F.timestamp_seconds("event_id").alias("at"))
    done = control.folded(t, changes)
    return done.select("id", "league_key", "season", "status", "last_error_stage", F.length("last_error").alias("error_length"), F.unix_timestamp("silver_completed_at").alias("silver_done"), F.unix_timestamp("updated_at").alias("changed"))


PARTS = "o AS (SELECT o_orderkey, year(o_orderdate) AS season, o_orderstatus AS league FROM orders)"


@query(f"""WITH {PARTS} SELECT 'before' AS phase, league, season, COUNT(*) AS n, CAST(SUM(o_orderkey) AS BIGINT) AS keys FROM o GROUP BY ALL
UNION ALL SELECT 'first', league, season, COUNT(*), CAST(SUM(CASE WHEN season = 1997 AND league = 'F' THEN -o_orderkey ELSE o_orderkey END) AS BIGINT) FROM o GROUP BY ALL
UNION ALL SELECT 'second', league, season, COUNT(*), CAST(SUM(o_orderkey) AS BIGINT) FROM o WHERE NOT (season = 1997 AND league = 'F' AND o_orderkey % 2 = 0) GROUP BY ALL
UNION ALL SELECT 'third', league, season, COUNT(*), CAST(SUM(o_orderkey) AS BIGINT) FROM o WHERE NOT (season = 1997 AND league = 'F') GROUP BY ALL""")
def atomic_publish(spark, d):
    """A partition published three times, at last without rows; what a reader sees before and after each."""
    name = f"trip_{uuid.uuid4().hex}"
    rows = A.read(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("season"), F.col("o_orderstatus").alias("league"))
    rows.repartition("season", "league").write.partitionBy("season", "league").format("parquet").saveAsTable(name)
    one = readers.partition_scan(rows, 1997, "F")
    states = [("before", None), ("first", one.withColumn("o_orderkey", -F.col("o_orderkey"))), ("second", one.filter("o_orderkey % 2 = 1")), ("third", one.limit(0))]
    try:
        seen = []
        for phase, df in states:
            if df is not None:
                versions.publish(df, name, {"season": 1997, "league": "F"})
            seen += spark.table(name).groupBy(F.lit(phase).alias("phase"), "league", "season").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys")).collect()  # a row a partition
        return readers.in_memory(spark, seen, "phase string, league string, season int, n long, keys long")
    finally:
        sinks.drop_tables(spark, [name])


@query(f"""WITH {NEW}, kept AS (SELECT o_orderkey AS id, o_custkey AS value FROM orders) SELECT id, value, CAST(NULL AS VARCHAR) AS note FROM kept WHERE id NOT IN (SELECT id FROM last)
UNION ALL SELECT id, coalesce(value, event_id) AS value, event_type AS note FROM last LEFT JOIN kept USING (id)""")
def bucketed_upsert(spark, d):
    """A stored table of orders in buckets of its key takes in events in two steps, errors last; the first value of a key stays."""
    name = f"trip_{uuid.uuid4().hex}"
    merge = lambda old, new: ingest.upsert(old, new, ["id"], keep=("value",), order=F.col("at"))
    old = A.read(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("value"), F.lit(0).cast("long").alias("at"))
    last = A.read(spark, d, "events").groupBy(F.col("user_id").alias("id")).agg(F.max("event_id").alias("value"), F.max("event_id").alias("at"), F.max_by("event_type", "event_id").alias("note"))
    try:
        sinks.store(old, name, ["id"], merge)
        for part in (last.filter("note <> 'error'"), last.filter("note = 'error'")):
            sinks.store(part, name, ["id"], merge)
        path = f"{_folder(spark)}/upserted"
        versions.rows_of(spark, name).select("id", "value", "note").write.parquet(path)
    finally:
        sinks.drop_tables(spark, [name])
    return spark.read.schema("id long, value long, note string").parquet(path)


@query("SELECT event_id, user_id, event_type, value, CASE WHEN event_id % 3 = 0 THEN '{\"}[é\\' END AS note FROM events")
def array_roundtrip(spark, d):
    """Events as arrays of records, one array a file (5,000 records at most), with strings that look like structure; read back record by record."""
    path = f"{_folder(spark)}/arrays"
    e = A.read(spark, d, "events").select("event_id", "user_id", "event_type", "value", F.when(F.col("event_id") % 3 == 0, '{"}[é\\').alias("note"), F.floor(F.col("event_id") / 5000).alias("part"))
    sinks.json_array(e, "part").repartition("part").write.partitionBy("part").text(path)
    return readers.json_rows(spark, path, "event_id long, user_id long, event_type string, value double, note string")


@query("""SELECT c_custkey AS espn_athlete_id, CASE WHEN c_nationkey > 4 THEN 'P' || c_custkey || ' ' || c_mktsegment END AS display_name, CASE WHEN c_nationkey > 4 THEN c_nationkey END AS age FROM customer""")
def fetched_profiles(spark, d):
    """A request for every customer, answered by its own address (a data URL); those of some nations have an address nobody answers."""
    c = A.read(spark, d, "customer")
    body = F.to_json(F.struct(F.struct(F.col("c_custkey").cast("string").alias("id"), F.concat_ws(" ", F.concat(F.lit("P"), "c_custkey"), "c_mktsegment").alias("displayName"), F.col("c_nationkey").alias("age")).alias("athlete")))
    url = F.when(F.col("c_nationkey") > 4, F.concat(F.lit("data:application/json,"), F.replace(F.url_encode(body), F.lit("+"), F.lit("%20")))).otherwise("nowhere:x")
    got = fetch.fetched(c.select(F.col("c_custkey").cast("string").alias("requested_id"), url.alias("url")), delay=0.0)
    rows = got.select("requested_id", F.col("body").alias("_raw"), F.from_json("body", schemas.PROFILE).alias("p")).select("requested_id", "_raw", "p.*")
    return lineup.profile_rows(rows).select("espn_athlete_id", "display_name", "age")


@query(f"WITH {MSG}, {DONE} SELECT line_no, {HIT} AS done FROM first f")
def done_history(spark, d):
    """All messages against a history of keys in buckets, added in two runs (events with a key, and older ones without) and partly twice."""
    name = f"trip_{uuid.uuid4().hex}"
    m = ingest.with_hashes(A.messages(spark, d))
    value = A.read(spark, d, "events").select(F.col("event_id").alias("line_no"), "value")
    events = m.join(value, "line_no").filter("value > 90").withColumn("status", F.lit("done"))
    try:
        for part in (events.filter("value > 95"), events.filter("value <= 97").withColumn("dedupe_key", F.lit(None).cast("string"))):
            history.add(history.done_keys(part), name)
        path = f"{_folder(spark)}/flagged"
        history.flagged(m, spark.table(name)).select("line_no", "done").write.parquet(path)
    finally:
        sinks.drop_tables(spark, [name])
    return spark.read.schema("line_no long, done boolean").parquet(path)


def _database(spark) -> str:
    name = f"trip_{uuid.uuid4().hex}"
    sinks.ensure_namespace(spark, name)
    return name


def _kept(spark, df, columns: list[str], name: str) -> DataFrame:
    """A result written to a folder of its own, so that its tables may go."""
    path = f"{_folder(spark)}/{name}"
    df.select(*columns).write.parquet(path)
    return spark.read.schema(df.select(*columns).schema).parquet(path)


GOLD = ["player", "team", "league", "season", "matches_played", "matches_started", "goals", "assists", "yellow_cards", "goal_contributions", "goals_per_match"]


@query(SEASON.replace(" FROM lineup GROUP BY", " FROM lineup WHERE (season, league) IN (SELECT (season, league) FROM lineup GROUP BY season, league HAVING COUNT(*) % 3 <> 0) GROUP BY"))
def gold_of_due_seasons(spark, d):
    """Silver in partitions; Gold of all seasons due in one run, where a season is due by how many rows it has."""
    db = _database(spark)
    try:
        stats = silver.player_match_stats(A.lineup(spark, d))
        n = sizes.tasks(stats)  # a season and league takes several of these tasks, each small enough to sort in memory
        rows = incremental.arranged(stats, ["game"], n, max(1, n // 8)).drop(incremental.CUT)
        versions.publish_many(rows, f"{db}.player_match_stats", incremental.PARTITION, arranged=True)
        state = spark.table(f"{db}.player_match_stats").groupBy("season", F.col("league").alias("league_key")).agg(F.when(F.count("*") % 3 != 0, "silver_done").otherwise("complete").alias("status"))
        incremental.gold_due(spark, db, incremental.seasons_due(state))
        return _kept(spark, spark.table(f"{db}.player_season_stats"), GOLD, "gold")
    finally:
        spark.sql(f"DROP DATABASE {db} CASCADE")


@query(SEASON)
def incremental_gold(spark, d):
    """Matches taken in in three parts, of which the last brings some again; the result is that of all rows."""
    db = _database(spark)
    stats = silver.player_match_stats(A.lineup(spark, d))
    try:
        for part in (stats.filter("game % 3 = 0"), stats.filter("game % 3 = 1").withColumn("total_goals", F.col("total_goals") + 5), stats.filter("game % 3 > 0")):
            incremental.take_in(spark, db, part)
        return _kept(spark, spark.table(f"{db}.player_season_stats"), GOLD, "gold")
    finally:
        spark.sql(f"DROP DATABASE {db} CASCADE")


ARRIVALS = """a AS (SELECT event_id, user_id, event_type, value, least((day(ts) - 1) // 10, 2) AS part, CASE WHEN day(ts) > 20 AND event_type = 'error' THEN ts - INTERVAL 15 DAY ELSE ts END AS ts FROM events),
mark AS (SELECT max(ts) - INTERVAL 2 HOUR AS m FROM a WHERE part < 2), w AS (SELECT a.*, time_bucket(INTERVAL 6 HOUR, ts) AS start FROM a)"""


def _arrivals(spark, d, take):
    """Events in files that come in three times (by ten days), errors of the last days fifteen days late; ``take(stream, folder)`` after each arrival."""
    folder = _folder(spark)
    e = A.read(spark, d, "events").select("event_id", "user_id", "event_type", "value", F.col("ts").cast("timestamp").alias("ts"))
    late = (F.dayofmonth("ts") > 20) & (F.col("event_type") == "error")
    rows = e.withColumns({"part": F.least(F.floor((F.dayofmonth("ts") - 1) / 10), F.lit(2)), "ts": F.when(late, F.col("ts") - F.expr("INTERVAL 15 DAYS")).otherwise(F.col("ts"))})
    for part in (0, 1, 2):
        rows.filter(F.col("part") == part).drop("part").write.mode("append").parquet(f"{folder}/in")
        take(windows.files(spark, f"{folder}/in", "event_id long, user_id long, event_type string, value double, ts timestamp"), folder)


@query(f"""WITH {ARRIVALS} SELECT strftime(start, '%Y-%m-%d %H:%M:%S') AS start, event_type, COUNT(*) AS n, max(value) AS top FROM w, mark WHERE NOT (part = 2 AND start + INTERVAL 6 HOUR <= m) GROUP BY ALL""")
def event_windows(spark, d):
    """Windows of six hours over a file stream in three runs, kept in a table; what comes after its window has ended is dropped."""
    name = f"trip_{uuid.uuid4().hex}"
    keys = ["start", "event_type"]
    take = lambda stream, folder: windows.drained(windows.tumbling(stream, "ts", "6 hours", "2 hours", "event_type", top=F.max("value")), name, keys, f"{folder}/cp").awaitTermination()
    try:
        _arrivals(spark, d, take)
        found = versions.rows_of(spark, name).withColumn("start", F.date_format("start", "yyyy-MM-dd HH:mm:ss"))
        return _kept(spark, found, [*keys, "n", "top"], "windows")
    finally:
        sinks.drop_tables(spark, [name])


@query(f"""WITH {ARRIVALS} SELECT CAST(part AS BIGINT) AS batch, COUNT(*) AS n, COUNT(*) FILTER (WHERE part = 2 AND start + INTERVAL 6 HOUR <= m) AS late FROM w, mark GROUP BY part""")
def late_events(spark, d):
    """How many rows of each arrival came after their window had ended."""
    name = f"trip_{uuid.uuid4().hex}"
    try:
        _arrivals(spark, d, lambda stream, folder: windows.watched(stream, name, "ts", "6 hours", "2 hours", f"{folder}/cp").awaitTermination())
        return _kept(spark, versions.rows_of(spark, name), ["batch", "n", "late"], "late")
    finally:
        sinks.drop_tables(spark, [name])


@query("""WITH e AS (SELECT user_id, ts, value, ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS gap FROM events), s AS (SELECT *, sum(CASE WHEN gap < INTERVAL 6 HOUR THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts) AS no FROM e)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start, COUNT(*) AS n, max(value) AS top FROM s GROUP BY user_id, no HAVING max(ts) + INTERVAL 6 HOUR <= (SELECT max(ts) - INTERVAL 2 HOUR FROM events)""")
def event_sessions(spark, d):
    """Sessions of users (less than six hours from event to event) over a file stream in three runs; those that are complete."""
    name = f"trip_{uuid.uuid4().hex}"
    folder = _folder(spark)
    e = A.read(spark, d, "events").select("user_id", "value", F.col("ts").cast("timestamp").alias("ts"))
    try:
        for part in (0, 1, 2):
            e.filter(F.least(F.floor((F.dayofmonth("ts") - 1) / 10), F.lit(2)) == part).write.mode("append").parquet(f"{folder}/in")
            stream = windows.files(spark, f"{folder}/in", "user_id long, value double, ts timestamp")
            windows.drained(windows.sessions(stream, "ts", "6 hours", "2 hours", "user_id", top=F.max("value")), name, ["user_id", "start"], f"{folder}/cp", "append").awaitTermination()
        found = versions.rows_of(spark, name).withColumn("start", F.date_format("start", "yyyy-MM-dd HH:mm:ss"))
        return _kept(spark, found, ["user_id", "start", "n", "top"], "sessions")
    finally:
        sinks.drop_tables(spark, [name])


@query("""WITH r AS (SELECT user_id AS id, ts, ['bronze', 'silver', 'gold'][1 + event_id % 3] AS stage, event_type FROM events),
l AS (SELECT id, ts, stage, event_type, row_number() OVER (PARTITION BY id ORDER BY ts DESC) AS k FROM r),
s AS (SELECT id, ts, CASE event_type WHEN 'click' THEN CASE stage WHEN 'gold' THEN 'complete' ELSE stage || '_done' END WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'pending' ELSE stage || '_running' END AS status, event_type IN ('view', 'purchase') AS running FROM l WHERE k = 1),
m AS (SELECT max(ts) - INTERVAL 1 HOUR AS m FROM events)
SELECT id, CASE WHEN running AND ts + INTERVAL 12 HOUR < m THEN 'failed' ELSE status END AS status, running AND ts + INTERVAL 12 HOUR < m AS timed_out FROM s, m""")
def stage_stream(spark, d):
    """Events as stage results of as many seasons as there are users, in files that come in three times; who has run for twelve hours has failed."""
    name = f"trip_{uuid.uuid4().hex}"
    folder = _folder(spark)
    stage = F.element_at(F.array(*map(F.lit, control.STAGES)), (F.col("event_id") % 3 + 1).cast("int"))
    outcome = F.when(F.col("event_type") == "click", "completed").when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "signup", "reset").otherwise("started")
    e = A.read(spark, d, "events").select(F.col("user_id").alias("id"), stage.alias("stage"), outcome.alias("outcome"), F.col("props").alias("error"), F.col("ts").cast("timestamp").alias("at"))
    try:
        for part in (0, 1, 2):
            e.filter(F.least(F.floor((F.dayofmonth("at") - 1) / 10), F.lit(2)) == part).write.mode("append").parquet(f"{folder}/in")
            stream = windows.files(spark, f"{folder}/in", "id long, stage string, outcome string, error string, at timestamp")
            stages.kept(stream, name, "12h", "1 hour", f"{folder}/cp").awaitTermination()
        found = versions.rows_of(spark, name).withColumn("timed_out", F.coalesce((F.col("status") == "failed") & (F.col("last_error") == stages.NO_ANSWER), F.lit(False)))
        return _kept(spark, found, ["id", "status", "timed_out"], "stages")
    finally:
        sinks.drop_tables(spark, [name])


@query("""WITH n AS (SELECT n_nationkey, CASE n_nationkey % 6 WHEN 0 THEN 'BRA-Brasileirao' WHEN 1 THEN 'ITA-Serie A' WHEN 2 THEN 'ENG-Premier League' WHEN 3 THEN 'FRA-Ligue 1' WHEN 4 THEN n_name || ' -- ' || n_regionkey ELSE '!!' END AS k FROM nation)
SELECT c_custkey, k AS league_key, CASE k WHEN 'BRA-Brasileirao' THEN 'brasileirao' WHEN 'ITA-Serie A' THEN 'serie_a' WHEN 'ENG-Premier League' THEN 'premier_league' WHEN 'FRA-Ligue 1' THEN 'ligue_1' ELSE coalesce(nullif(lower(trim(regexp_replace(k, '[^a-zA-Z0-9]+', '_', 'g'), '_')), ''), 'unknown') END AS slug FROM customer JOIN n ON c_nationkey = n_nationkey""")
def league_slugs(spark, d):
    """Registered and other leagues of customers by nation, as the slugs that paths use."""
    n = A.read(spark, d, "nation")
    k = n.n_nationkey % 6
    key = F.lit("!!")
    for i, name in enumerate(leagues.LEAGUES):
        key = F.when(k == i, name).otherwise(key)
    key = F.when(k == 4, F.concat_ws(" -- ", "n_name", F.col("n_regionkey").cast("string"))).otherwise(key)
    named = n.select("n_nationkey", key.alias("league_key"))
    return A.read(spark, d, "customer").join(F.broadcast(named), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "league_key", leagues.league_slug_column(F.col("league_key")).alias("slug"))
