"""Bronze to Gold for one season and league, and one run of the queue."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake import schemas
from pitchlake.functions.scalars import entity_table_name
from pitchlake.leagues import bronze_path, league_slug
from pitchlake.operators import gold, ingest, silver
from pitchlake.operators import lineup as enrich
from pitchlake.plans import quality
from pitchlake.sources import history, readers, sinks, versions

TABLES = ("teams", "players", "match_statistics", "player_match_stats", "match_events", "player_season_stats")


#: Bronze entity -> columns it always has, and known ones it may have.
BRONZE = {"schedule": (schemas.SCHEDULE, schemas.SCHEDULE_MORE), "matchsheet": (schemas.MATCHSHEET, schemas.MATCHSHEET_MORE), "lineup": (schemas.LINEUP, schemas.LINEUP_MORE), "events": (schemas.EVENTS, schemas.EVENTS_MORE)}


def land(df: DataFrame, root: str, league: str, season: int, entity: str) -> dict[str, object]:
    """Writes an extracted entity to its Bronze path, a record a line, replacing what was there; rows, path and seconds."""
    began = time.perf_counter()
    path = bronze_path(root, league, season, entity)
    sinks.write_json(df, path)
    rows = df.sparkSession.read.text(path).count()
    return {"entity": entity, "rows": rows, "path": path, "elapsed_seconds": round(time.perf_counter() - began, 2)}


def read_bronze(spark: SparkSession, root: str, league: str, season: int, entity: str) -> DataFrame:
    return readers.bronze(spark, bronze_path(root, league, season, entity), *BRONZE[entity])


def offline_source(spark: SparkSession, folder: str) -> dict[str, Callable[[], DataFrame]]:
    """A season's extracts that lie in a folder (``schedule.json`` and so on), in place of a remote source: entity -> reader.

    A reader raises if its file is missing; index columns that an export added are dropped.
    """
    def reader(entity: str) -> Callable[[], DataFrame]:
        return lambda: readers.bronze(spark, f"{folder.rstrip('/')}/{entity}.json", *BRONZE[entity]).drop("index", "level_0")

    return {e: reader(e) for e in BRONZE}


def load_bronze(root: str, league: str, season: int, schedule: DataFrame, matchsheet: Callable[[], DataFrame], lineup: Callable[[], DataFrame], events: Callable[[], DataFrame], summaries: DataFrame | None = None) -> dict[str, dict]:
    """Lands the four entities of a season, the line-up and the events with ids; entity -> what :func:`land` returns.

    The sources of events may fail: then the error is reported, and an empty file is written.
    """
    spark = schedule.sparkSession
    out = {"schedule": land(schedule, root, league, season, "schedule")}
    games = readers.game_ids(schedule) if "game_id" in schedule.columns else schedule.select("game")
    out["matchsheet"] = land(matchsheet().drop("roster"), root, league, season, "matchsheet")
    rows = lineup()
    if summaries is not None:
        rows = enrich.enriched_lineup(rows, games, summaries, league, season)
    out["lineup"] = land(rows, root, league, season, "lineup")
    try:
        out["events"] = land(enrich.events_with_game_id(events(), games), root, league, season, "events")
    except Exception as e:  # noqa: BLE001  a season without events is still one
        out["events"] = land(spark.createDataFrame([], schemas.EVENTS), root, league, season, "events") | {"error": str(e)[:2000]}
    return out


def run_silver(spark: SparkSession, root: str, database: str, season: int, league: str, starter_mode: str = "keep") -> list[tuple[str, str, str]]:
    """Reads Bronze, writes five tables, returns the checks, evaluated from what the writes themselves saw."""
    schedule, sheet, lineup = (read_bronze(spark, root, league, season, e) for e in ("schedule", "matchsheet", "lineup"))
    events = readers.optional_bronze(spark, bronze_path(root, league, season, "events"), *BRONZE["events"])
    built = {"teams": silver.teams(sheet), "players": silver.players(lineup), "match_statistics": silver.match_statistics(schedule, sheet, lineup), "player_match_stats": silver.player_match_stats(lineup, starter_mode)}
    sinks.ensure_namespace(spark, database)
    found = {name: sinks.write_partitioned(sinks.audited(df), f"{database}.{name}", season, league, quality.observations(name, quality.SILVER)) for name, df in built.items()}
    if events is not None:
        sinks.write_optional(sinks.audited(silver.match_events(events, season, league)), f"{database}.match_events", season, league)
    return quality.verdicts(found, quality.SILVER)


def run_gold(spark: SparkSession, database: str, season: int, league: str) -> list[tuple[str, str, str]]:
    """Season statistics from Silver, published only if they have rows and keys; the evaluated checks."""
    stats = readers.partition_scan(spark.table(f"{database}.player_match_stats"), season, league)
    name = "player_season_stats"
    found = sinks.write_partitioned(sinks.audited(gold.player_season_stats(stats)), f"{database}.{name}", season, league, quality.observations(name, quality.GOLD), quality.gold_gate(name, ["player", "team"]))
    return quality.verdicts({name: found}, quality.GOLD)


def guarded(stage: Callable[[], object], on_failure: Callable[[str], None]) -> object:
    """Runs a stage; a failure is recorded before it is raised again."""
    try:
        return stage()
    except Exception as e:
        on_failure(str(e))
        raise


def table_counts(spark: SparkSession, database: str) -> list[tuple[str, int | None]]:
    """Rows of each table; a missing one is reported as None."""
    return [(n, spark.table(f"{database}.{n}").count() if sinks.exists(spark, f"{database}.{n}") else None) for n in TABLES]


def plan_queue(lines: DataFrame, done: DataFrame, batch: int = ingest.BATCH) -> dict[str, DataFrame]:
    """The phases before processing: failures, duplicates, those that the history of keys (``done``) holds, this batch, and what remains."""
    good, failures = readers.parse_lines(lines)
    firsts, duplicates = ingest.split_duplicates(ingest.with_hashes(good))
    fresh, known = history.split(firsts, done)
    now, later = ingest.batch_split(fresh, batch)
    return {"failures": failures, "duplicates": duplicates, "done": known, "batch": now, "remaining": later}


RESULT = "message_hash string, status string, inserted_rows long, error string"


def process_batch(spark: SparkSession, batch: DataFrame, store: Callable[[str, DataFrame], None]) -> DataFrame:
    """Loads, checks and stores the payloads of a batch; returns ``message_hash, status, inserted_rows, error``.

    ``batch`` is at most a queue batch, so its messages (not their payloads) may
    come to the driver.  JSON files are read together, each CSV file by itself;
    a missing, unreadable or wrongly shaped one fails its own message only.
    Rows reach ``store(entity, rows)`` once for each entity, with the keys of
    all its payloads as columns.
    """
    files = sinks.Files(spark)
    rows = {m["message_hash"]: m.asDict() for m in batch.collect()}
    failed: dict[str, str] = {}
    by_format: dict[str, dict[str, str]] = {"json": {}, "csv": {}}
    for h, m in rows.items():
        path, fmt = m["path"] or "", (m["payload_format"] or "").strip().lower()
        if not path or not files.exists(path):
            failed[h] = f"File not found: {path}"
        elif fmt not in by_format:
            failed[h] = f"Unsupported payload_format: {fmt}"
        else:
            by_format[fmt][h] = path
    objects = spark.createDataFrame([], "message_hash string, entity_type string, meta_row_index int, row variant")
    entity_of = lambda h: (rows[h]["entity_type"] or "").strip().lower()
    if by_format["json"]:
        told = spark.createDataFrame([(h, entity_of(h), files.qualified(p)) for h, p in by_format["json"].items()], "message_hash string, entity_type string, file string")
        # a payload may be a folder that holds one file
        read = readers.json_payloads(spark, sorted(set(by_format["json"].values()))).withColumn("file", F.explode(F.array("file", F.regexp_replace("file", "/[^/]*$", ""))))
        loaded = told.join(read, "file", "left")
        error = F.when(F.col("payload").isNull(), F.lit("json_decode_error")).otherwise(ingest.payload_error(F.col("entity_type"), F.col("payload")))
        failed |= {r[0]: r[1] for r in loaded.select("message_hash", error.alias("e")).filter("e is not null").collect()}  # at most a batch
        objects = ingest.to_rows(loaded.select("message_hash", "entity_type", "payload"))
    for h, path in by_format["csv"].items():
        entity = entity_of(h)
        try:
            if entity not in ingest.LISTS:
                raise ValueError(f"Payload for {entity} must be a JSON object" if entity in ingest.SINGLE else f"Unsupported entity_type: {entity}")
            one = readers.csv_payload(spark, path)
            objects = objects.unionByName(one.select(F.lit(h).alias("message_hash"), F.lit(entity).alias("entity_type"), "meta_row_index", "row"))
        except Exception as e:  # noqa: BLE001  each message stands alone
            failed[h] = str(e)[:2000]
    counts: dict[str, int] = {}
    messages = spark.createDataFrame([(m["message_hash"], m["entity_id"], m["provider"], m["league"], m["season"], m["path"], m["created_at"]) for m in rows.values()], "message_hash string, entity_id string, provider string, league string, season string, path string, created_at string")
    for entity in sorted({entity_of(h) for h in rows if h not in failed}):
        own = sinks.staged(objects.filter(F.col("entity_type") == entity).withColumn("row", F.to_json("row")), f"payload-{uuid.uuid4().hex}")
        parsed = own.withColumn("row", F.parse_json("row"))
        try:
            names = sorted(r[0] for r in ingest.payload_names(parsed).collect())  # columns of one table
            store(entity, ingest.dynamic_rows(parsed, messages, names))
            counts |= {r[0]: r[1] for r in own.groupBy("message_hash").count().collect()}
        except Exception as e:  # noqa: BLE001  the entity's messages fail together, the others go on
            failed |= {h: str(e)[:2000] for h in rows if h not in failed and entity_of(h) == entity}
        finally:
            sinks.unstaged(own)
    out = [(h, "failed", 0, failed[h]) if h in failed else (h, "done", counts.get(h, 0), None) for h in rows]
    return spark.createDataFrame(out, RESULT)


def events_of(messages: DataFrame, results: DataFrame) -> DataFrame:
    """One control row per processed message."""
    m = messages.join(results, "message_hash")
    return m.select(
        "message_hash", "dedupe_key", "entity_type", F.col("entity_id").cast("string").alias("entity_id"), "provider", F.col("league").alias("league_key"), F.col("season").try_cast("int").alias("season"), "payload_format",
        F.col("path").alias("source_path"), "status", F.col("error").alias("error_message"), F.try_to_timestamp("created_at").alias("created_at"), F.current_timestamp().alias("processed_at"),
    )


def ensured_events(spark: SparkSession, name: str) -> DataFrame:
    """The table of ingestion events, made empty if it is absent."""
    if not sinks.exists(spark, name):
        versions.keyed_table(spark.createDataFrame([], schemas.RAW_EVENTS), name, ["message_hash"])
    return versions.rows_of(spark, name)


def store_raw(database: str) -> Callable[[str, DataFrame], None]:
    """Upserts into the raw table of an entity, by message and row; the first ingestion time stays."""
    keys = ["meta_message_hash", "meta_row_index"]
    return lambda entity, rows: sinks.store(rows, f"{database}.{entity_table_name(entity)}", keys, lambda old, new: ingest.upsert(old, new, keys, keep=("meta_ingested_at",)))


def consume(spark: SparkSession, root: str, database: str, batch: int = ingest.BATCH, move: bool = True) -> dict[str, int]:
    """One run over ``root``/queue/pending.jsonl: parse, dedupe, done-check, process a batch, rewrite the queue, move files.

    Results are appended to queue/done.jsonl and queue/failed.jsonl; what the
    batch leaves goes back to pending.jsonl, in its order.  Returns the counters.
    """
    pending = f"{root.rstrip('/')}/queue/pending.jsonl"
    files = sinks.Files(spark)
    if not files.exists(pending):
        return {"read": 0}
    sinks.ensure_namespace(spark, database)
    keys = f"{database}.raw_done_keys"
    done_before = history.ensured(spark, keys, ensured_events(spark, f"{database}.raw_ingestion_events"))
    # every phase is written once: the lines and the keys they were judged by change at the end
    lines = sinks.staged(readers.numbered_lines(spark, pending), "queue")
    kept = [lines]
    try:
        plan = {k: sinks.staged(v, k) for k, v in plan_queue(lines, done_before, batch).items()}
        kept += plan.values()
        now = plan["batch"]
        results = sinks.staged(process_batch(spark, now, store_raw(database)), "results")
        kept.append(results)
        sinks.store(events_of(now, results), f"{database}.raw_ingestion_events", ["message_hash"], lambda old, new: ingest.upsert_events(old, new, F.col("processed_at")))
        # fields go back to files with the JSON value they came with
        told_fields = ("entity_type", "entity_id", "path", "provider", "league", "season", "payload_format")
        fields = [*[F.parse_json(F.col("as_json")[f]).alias(f) for f in told_fields], "message_hash", "dedupe_key", F.col("path").alias("path_")]
        history.add(now.join(results.filter("status = 'done'"), "message_hash", "left_semi"), keys)
        told = now.join(results, "message_hash").select("status", *fields, "inserted_rows", "error")
        skipped = plan["duplicates"].unionByName(plan["done"]).select(F.lit("done").alias("status"), *fields, F.lit(0).cast("long").alias("inserted_rows"), F.col("status").alias("skip_reason"))
        done = told.filter("status = 'done'").drop("error").unionByName(skipped, allowMissingColumns=True)
        failures = plan["failures"].select(F.lit("failed").alias("status"), "error", "raw_line")
        failed = told.filter("status = 'failed'").drop("path_").unionByName(failures, allowMissingColumns=True)
        plan["remaining"].select("line_no").join(lines, "line_no").orderBy("line_no").select("raw").write.mode("overwrite").text(f"{pending}__next")
        sinks.swap_folder(spark, f"{pending}__next", pending)
        # the tasks move files, as many as there are distinct paths; none comes to the driver
        places = sinks.moved(done.select(F.col("path_").alias("path")), root).withColumnRenamed("path", "path_") if move else spark.createDataFrame([], "path_ string, moved_to string")
        n_moved = places.count()
        sinks.append_jsonl(done.withColumn("path_", F.btrim("path_")).join(places, "path_", "left").drop("path_").withColumn("processed_at", F.current_timestamp()), f"{root.rstrip('/')}/queue/done.jsonl")
        sinks.append_jsonl(failed.withColumn("failed_at", F.current_timestamp()), f"{root.rstrip('/')}/queue/failed.jsonl")
        inserted = results.agg(F.coalesce(F.sum("inserted_rows"), F.lit(0))).first()[0]
        return {"read": lines.count(), "parse_failed": plan["failures"].count(), "processed": results.count(), "done": done.count(), "failed": failed.count(), "inserted_rows": inserted, "files_moved": n_moved, "remaining": plan["remaining"].count()}
    finally:
        for df in kept:
            sinks.unstaged(df)


def extract_matches(schedule: DataFrame, sheet: DataFrame, lineup: DataFrame, root: str, league: str, season: int, most: int = 0) -> tuple[dict[str, str], DataFrame]:
    """The older extraction: every match of a season (or the first ``most``) with scores and statistics, its files, and their queue messages.

    Matches, sheets and line-ups are each written by one job, a folder for each
    game id (no loop over matches), with two outputs for the whole run; returns
    the paths and the messages.  A missing side's goals count as 0; a match
    without line-ups has no score.
    """
    schedule = readers.head(schedule, most, "date", "game")
    scored = silver.match_metrics_zero_fill(silver.scored_schedule(schedule.drop("home_score", "away_score"), lineup))
    meta = sheet.filter("is_home").groupBy("game").agg(F.min("venue").alias("venue"), F.min("attendance").alias("attendance"))
    sides = [silver.side_stats(sheet, home, False) for home in (True, False)]
    matches = scored.join(meta, "game", "left").join(sides[0], "game", "left").join(sides[1], "game", "left")
    games = schedule.select("game", "game_id").distinct()
    run = f"{root.rstrip('/')}/raw/soccerdata/{league_slug(league)}/{season}"
    parts = {"match": matches, "match_stats": sheet.drop("roster").join(games, "game"), "match_lineup": lineup.drop("game_id").join(games, "game")}
    messages = []
    for entity, df in parts.items():
        folder = f"{run}/{entity}"
        out = df.withColumn("game_id_", F.col("game_id")).write.mode("overwrite").partitionBy("game_id_")
        out.json(folder) if entity == "match" else out.option("header", True).csv(folder)
        fmt = "json" if entity == "match" else "csv"
        path = F.concat(F.lit(f"{folder}/game_id_="), F.col("game_id").cast("string"))
        ids = df.select("game_id").distinct()
        messages.append(ingest.queue_message(ids, entity_type=F.lit(entity), entity_id=F.col("game_id").cast("string"), payload_format=F.lit(fmt), path=path, provider=F.lit("espn"), league=F.lit(league), season=F.lit(season)))
    paths = sinks.run_outputs({"all_matchsheets.csv": parts["match_stats"], "all_player_match_stats.csv": silver.player_match_stats(parts["match_lineup"])}, run)
    return paths, ingest.merged(*messages)
