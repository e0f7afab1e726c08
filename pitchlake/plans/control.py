"""Season control: a small table with one writer; every function maps the table to its next state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitchlake.functions.scalars import truncated
from pitchlake.leagues import seed_rows
from pitchlake.operators.ingest import insert_ignore
from pitchlake.schemas import CONTROL
from pitchlake.sources.sinks import exists, rewrite_table, updated

#: stage -> (prerequisite status, running status, done status): fixed values.
STAGES = {"bronze": ("pending", "bronze_running", "bronze_done"), "silver": ("bronze_done", "silver_running", "silver_done"), "gold": ("silver_done", "gold_running", "complete")}


def stage_of(name: str) -> tuple[str, str, str]:
    if name not in STAGES:
        raise ValueError(f"unknown stage: {name}")
    return STAGES[name]


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], CONTROL)


def ensured(spark: SparkSession, name: str) -> DataFrame:
    """The control table, made empty if it is absent; calling it again changes nothing."""
    if not exists(spark, name):
        empty(spark).write.format("parquet").saveAsTable(name)
    return spark.table(name)


def saved(control: DataFrame, name: str) -> DataFrame:
    """Makes a state of the control table the stored one."""
    rewrite_table(control, name)
    return control.sparkSession.table(name)


def season_id(control: DataFrame, league: str, season: int) -> DataFrame:
    """``season_id``: one row, null for an unknown season (a scalar lookup)."""
    return control.filter((F.col("league_key") == league) & (F.col("season") == season)).agg(F.max("id").alias("season_id"))


def checks_of(log: DataFrame, control: DataFrame, league: str, season: int) -> DataFrame:
    """The checks of a season that is named by league and year: the scalar lookup as a broadcast join of one row."""
    return log.join(F.broadcast(season_id(control, league, season)), "season_id").orderBy("stage", F.desc("checked_at"), "id")


def seeded(control: DataFrame) -> DataFrame:
    """Adds the registered leagues' seasons that are missing; ids go on from the largest."""
    spark = control.sparkSession
    rows = spark.createDataFrame(seed_rows(), "league_key string, season int")
    fresh = insert_ignore(control, rows, ["league_key", "season"])
    top = F.coalesce(F.max("id").over(Window.partitionBy()), F.lit(0))  # a table of a few rows
    number = F.row_number().over(Window.partitionBy(F.col("id").isNull()).orderBy("league_key", "season"))
    return fresh.withColumns({"id": F.coalesce("id", top + number), "status": F.coalesce("status", F.lit("pending")), "created_at": F.coalesce("created_at", F.current_timestamp()), "updated_at": F.coalesce("updated_at", F.current_timestamp())})


def pending_season(control: DataFrame, stage: str, league: str | None = None) -> DataFrame:
    """The newest season a stage may take: its prerequisite met, or failed in this stage. At most one row."""
    ready, _, _ = stage_of(stage)
    rows = control.filter((F.col("status") == ready) | ((F.col("status") == "failed") & (F.col("last_error_stage") == stage)))
    if league is not None:
        rows = rows.filter(F.col("league_key") == league)
    return rows.orderBy(F.desc("season"), "league_key").limit(1).select("id", "league_key", "season", "status")


def _set(control: DataFrame, season_id: int, values: dict) -> DataFrame:
    return updated(control, F.col("id") == season_id, values | {"updated_at": F.current_timestamp()})


def started(control: DataFrame, season_id: int, stage: str) -> DataFrame:
    null = F.lit(None).cast("string")
    return _set(control, season_id, {"status": F.lit(stage_of(stage)[1]), f"{stage}_started_at": F.current_timestamp(), "last_error": null, "last_error_stage": null})


def completed(control: DataFrame, season_id: int, stage: str) -> DataFrame:
    return _set(control, season_id, {"status": F.lit(stage_of(stage)[2]), f"{stage}_completed_at": F.current_timestamp()})


def failed(control: DataFrame, season_id: int, stage: str, error: str) -> DataFrame:
    stage_of(stage)
    return _set(control, season_id, {"status": F.lit("failed"), "last_error": truncated(F.lit(error)), "last_error_stage": F.lit(stage)})


def reset(control: DataFrame, season_id: int) -> DataFrame:
    null = F.lit(None).cast("string")
    return _set(control, season_id, {"status": F.lit("pending"), "last_error": null, "last_error_stage": null})


#: What can happen to a season in a stage.
OUTCOMES = ("started", "completed", "failed", "reset")


def status_after(stage: Column, outcome: Column) -> Column:
    """The status that an outcome leaves; null for an unknown outcome or stage (a reset needs no stage)."""
    found = F.when(outcome == "reset", "pending").when(stage.isin(*STAGES) & (outcome == "failed"), "failed")
    for s, (_, running, done) in STAGES.items():
        found = found.when((stage == s) & (outcome == "started"), running).when((stage == s) & (outcome == "completed"), done)
    return found


def folded(control: DataFrame, changes: DataFrame) -> DataFrame:
    """The table after many changes at once: ``id, stage, outcome, error, at`` in the order of ``at``, each as :func:`started` and so on would apply it.

    One aggregation of times by season, then the last rows of each (the table is small) are met with them, so that no task sorts or keeps
    the texts of all; unknown stages and outcomes change nothing.
    """
    told = changes.withColumn("status_", status_after(F.col("stage"), F.col("outcome"))).filter("status_ is not null")
    errors = F.col("outcome") != "completed"  # which leaves the last error as it was
    hit = F.col("outcome") == "failed"
    marks = [F.max(F.when((F.col("stage") == s) & (F.col("outcome") == o), F.col("at"))).alias(f"{s}_{o}_") for s in STAGES for o in ("started", "completed")]
    # only numbers and times are added up here, which takes no sort
    sums = told.groupBy("id").agg(F.max(F.when(errors, F.col("at"))).alias("error_at_"), F.count_if(errors).alias("n_"), F.max("at").alias("at_"), *marks)
    times = sums.join(F.broadcast(control.select("id").distinct()), "id", "left_semi")
    # a row or two a season go on with their texts
    wanted = F.broadcast(times.select(F.col("id").alias("i_"), "at_", "error_at_"))
    late = told.join(wanted, (F.col("id") == F.col("i_")) & ((F.col("at") == F.col("at_")) | (F.col("at") == F.col("error_at_"))))
    error = F.struct(F.when(hit, truncated(F.col("error"))).alias("e"), F.when(hit, F.col("stage")).alias("s"))
    texts = late.groupBy("id").agg(F.max_by("status_", "at").alias("status_"), F.max_by(F.when(errors, error), F.when(errors, F.col("at"))).alias("error_"))
    last = times.join(texts, "id", "left")
    new = {"status": F.coalesce("status_", "status"), "last_error": F.when(F.col("n_") > 0, F.col("error_.e")).otherwise(F.col("last_error")), "last_error_stage": F.when(F.col("n_") > 0, F.col("error_.s")).otherwise(F.col("last_error_stage")), "updated_at": F.coalesce("at_", "updated_at")}
    new |= {f"{s}_{o}_at": F.coalesce(f"{s}_{o}_", f"{s}_{o}_at") for s in STAGES for o in ("started", "completed")}
    return control.join(last, "id", "left").withColumns(new).select(*control.columns)
