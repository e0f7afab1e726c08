"""One stage of one season, from the control table to the audit log: what a scheduler calls."""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from pitchlake import schemas
from pitchlake.plans import control, pipeline, quality
from pitchlake.sources import sinks


def due(table: DataFrame, stage: str, env: Mapping[str, str]) -> tuple[int, str, int] | None:
    """(id, league, season) to run: of the league and season that ``LEAGUE_KEY`` and ``SEASON`` name, if set, the newest that the stage may take."""
    rows = table
    if env.get("SEASON"):
        rows = rows.filter(rows["season"] == int(env["SEASON"]))
    found = control.pending_season(rows, stage, env.get("LEAGUE_KEY") or None).first()
    return (found["id"], found["league_key"], found["season"]) if found else None


def ensured_log(spark: SparkSession, name: str) -> DataFrame:
    """The table of checks, made empty if it is absent."""
    if not sinks.exists(spark, name):
        spark.createDataFrame([], schemas.CHECKS).write.format("parquet").saveAsTable(name)
    return spark.table(name)


def run_stage(spark: SparkSession, root: str, database: str, stage: str, env: Mapping[str, str] = os.environ) -> tuple[str, int, list[tuple[str, str, str]]] | None:
    """Runs ``silver`` or ``gold`` for the season that is due; (league, season, checks), or None if none is.

    The season is marked as running before, and as done or failed after; the checks are added to the log, also
    those that warn or fail.  What the stage raises is recorded (its first 2,000 characters) and raised again.
    """
    run = {"silver": lambda season, league: pipeline.run_silver(spark, root, database, season, league), "gold": lambda season, league: pipeline.run_gold(spark, database, season, league)}
    if stage not in run:
        raise ValueError(f"unknown stage: {stage}")
    sinks.ensure_namespace(spark, database)
    seasons, log = f"{database}.pipeline_season_control", f"{database}.pipeline_quality_checks"
    found = due(control.ensured(spark, seasons), stage, env)
    if found is None:
        return None
    own, league, season = found
    control.saved(control.started(spark.table(seasons), own, stage), seasons)
    checks = pipeline.guarded(lambda: run[stage](season, league), lambda error: control.saved(control.failed(spark.table(seasons), own, stage, error), seasons))
    sinks.rewrite_table(quality.recorded(ensured_log(spark, log), own, stage, checks), log)
    control.saved(control.completed(spark.table(seasons), own, stage), seasons)
    return league, season, checks
