"""Stages run from the control table, and many changes folded into it."""

import pytest
from pyspark.sql import functions as F
from test_runs import LEAGUE, SEASON, season

from pitchlake.plans import control, pipeline, quality, run


def test_stages_run_in_order(spark, tmp_path):
    root, db = str(tmp_path / "lake"), "stages_test"
    spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
    assert run.run_stage(spark, root, db, "silver", {}) is None
    name = f"{db}.pipeline_season_control"
    t = control.seeded(spark.table(name))
    own = {(r["league_key"], r["season"]): r["id"] for r in t.collect()}
    ready = own[LEAGUE, SEASON]
    control.saved(control.completed(control.started(t, ready, "bronze"), ready, "bronze"), name)
    state = lambda: spark.table(name).filter(F.col("id") == ready).first()
    # no files yet: the failure is recorded and raised, and the season may be tried again
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        run.run_stage(spark, root, db, "silver", {"LEAGUE_KEY": LEAGUE, "SEASON": str(SEASON)})
    assert (state()["status"], state()["last_error_stage"]) == ("failed", "silver") and 0 < len(state()["last_error"]) <= 2000
    schedule, sheet, rows = season(spark)
    pipeline.load_bronze(root, LEAGUE, SEASON, schedule, lambda: sheet, lambda: rows, lambda: schedule.select("game", F.lit("goal").alias("event_type")))
    assert run.run_stage(spark, root, db, "silver", {"SEASON": "2023"}) is None
    league, year, checks = run.run_stage(spark, root, db, "silver", {})
    assert (league, year) == (LEAGUE, SEASON) and len(checks) == 10 and state()["status"] == "silver_done" and state()["last_error"] is None
    assert len(run.run_stage(spark, root, db, "gold", {"LEAGUE_KEY": LEAGUE})[2]) == 3 and state()["status"] == "complete"
    log = spark.table(f"{db}.pipeline_quality_checks")
    assert quality.summary(log, ready).count() == 13 and quality.summary(log, ready, "gold").count() == 3
    with pytest.raises(ValueError):
        run.run_stage(spark, root, db, "bronze", {})
    spark.sql(f"DROP DATABASE {db} CASCADE")


def test_many_changes_equal_one_after_another(spark):
    t = spark.createDataFrame([(1, "L", 2024, "pending"), (2, "L", 2023, "failed"), (3, "L", 2022, "complete")], "id long, league_key string, season int, status string")
    t = control.empty(spark).unionByName(t, allowMissingColumns=True).withColumn("last_error_stage", F.when(F.col("id") == 2, "gold"))
    told = [(1, "bronze", "started", None), (1, "bronze", "completed", None), (1, "silver", "started", None), (1, "silver", "failed", "x" * 3000), (2, "gold", "completed", "not looked at"), (1, "gold", "completed", None), (2, "nothing", "started", None), (2, "gold", "unknown", None), (9, "gold", "started", None)]
    changes = spark.createDataFrame([(*c, i) for i, c in enumerate(told)], "id long, stage string, outcome string, error string, n long").withColumn("at", F.timestamp_seconds("n")).drop("n")
    got = control.folded(t, changes)
    want = t
    for i, stage, outcome, error in told[:6]:
        want = {"started": lambda: control.started(want, i, stage), "completed": lambda: control.completed(want, i, stage), "failed": lambda: control.failed(want, i, stage, error)}[outcome]()  # noqa: B023
    cols = ["id", "status", "last_error", "last_error_stage"]
    assert got.select(cols).orderBy("id").collect() == want.select(cols).orderBy("id").collect() and got.columns == t.columns
    first = got.filter("id = 1").first()
    assert len(first["last_error"]) == 2000 and first["silver_started_at"].second == 2 and first["gold_completed_at"].second == 5 and first["silver_completed_at"] is None
    reset = control.folded(got, spark.createDataFrame([(1, "silver", "reset", None)], "id long, stage string, outcome string, error string").withColumn("at", F.timestamp_seconds(F.lit(100))))
    assert reset.filter("id = 1").select("status", "last_error", "last_error_stage").first() == ("pending", None, None)
