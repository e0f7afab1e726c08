"""The state of each season's stage from a stream of stage results; a stage that doesn't answer in time fails by itself.

One small state a season (its status, the last error and its stage) is a row of a keyed table.  A batch is added up by season first, so
that whatever it brings, a season costs a row, and is folded into the table by one join; no Python runs for a season.  The watermark is the
latest time of all batches so far less the lateness: when it passes the time that a started stage has, without another result, the season
fails with :data:`NO_ANSWER`.  A batch that is repeated changes nothing: it meets the mark that it met before, and what it tells again is already there.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pitchlake.functions.scalars import truncated
from pitchlake.operators.ingest import upsert
from pitchlake.plans.control import STAGES, status_after
from pitchlake.sources import sinks, versions
from pitchlake.sources.files import Files

#: The error of a stage that was started and never told how it ended.
NO_ANSWER = "no answer in time"
STATE = "status string, last_error string, last_error_stage string, running string, changed timestamp"


def after(state: tuple, stage: str, outcome: str, error: str | None) -> tuple:
    """(status, last error, its stage, stage that runs) after a result; unknown stages and outcomes change nothing (a reset needs no stage)."""
    if outcome == "reset":
        return "pending", None, None, None
    if stage not in STAGES:
        return state
    _, running, done = STAGES[stage]
    if outcome == "started":
        return running, None, None, stage
    if outcome == "completed":
        return done, state[1], state[2], None
    if outcome == "failed":
        return "failed", None if error is None else error[:2000], stage, None
    return state


def told(results: DataFrame) -> DataFrame:
    """What a batch's results leave, a row a season: its last status, the stage that runs by it, the last error if one was set or cleared, the latest time."""
    at = F.col("at")
    status = status_after(F.col("stage"), F.col("outcome"))
    counts = results.withColumn("s_", status).filter(at.isNotNull())
    valid = F.when(F.col("s_").isNotNull(), at)
    sets = F.when(F.col("s_").isNotNull() & (F.col("outcome") != "completed"), at)
    hit = F.col("outcome") == "failed"
    error = F.struct(F.when(hit, truncated(F.col("error"))).alias("e"), F.when(hit, F.col("stage")).alias("s"))
    last = F.struct(F.col("s_").alias("status"), F.when(F.col("outcome") == "started", F.col("stage")).alias("running"))
    return counts.groupBy("id").agg(F.max_by(last, valid).alias("last_"), F.max_by(F.when(sets.isNotNull(), error), sets).alias("error_"), F.max("at").alias("at_"))


def millis(span: str) -> int:
    return int(pd.Timedelta(span).total_seconds() * 1000)


def folded(old: DataFrame, new: DataFrame, patience: str, mark: int) -> DataFrame:
    """States ``id`` and :data:`STATE` that change: those of seasons in ``new`` (:func:`told`), and those that the mark (milliseconds) finds waiting for too long."""
    both = old.join(new, "id", "full_outer")
    own, error = F.col("last_").isNotNull(), F.col("error_").isNotNull()
    states = both.select(
        "id",
        F.coalesce("last_.status", "status").alias("status"),
        F.when(error, F.col("error_.e")).otherwise(F.col("last_error")).alias("last_error"),
        F.when(error, F.col("error_.s")).otherwise(F.col("last_error_stage")).alias("last_error_stage"),
        F.when(own, F.col("last_.running")).otherwise(F.col("running")).alias("running"),
        F.greatest("changed", "at_").alias("changed"),
        F.col("at_").isNotNull().alias("hit_"),
    )
    until = F.timestamp_micros(F.unix_micros("changed") + millis(patience) * 1000)
    over = F.coalesce(F.col("running").isNotNull() & (F.unix_millis(until) < mark), F.lit(False))
    fails = {"status": F.lit("failed"), "last_error": F.lit(NO_ANSWER), "last_error_stage": F.col("running"), "running": F.lit(None).cast("string"), "changed": until}
    changing = states.withColumn("over_", over).filter("hit_ or over_")
    return changing.select("id", *[F.when(F.col("over_"), v).otherwise(F.col(c)).alias(c) for c, v in fails.items()])


def into_table(name: str, patience: str, lateness: str, checkpoint: str) -> Callable[[DataFrame, int], None]:
    """Folds a batch into the table of states.  The latest time of all batches up to each is a small file beside the checkpoint."""
    place = lambda number: f"{checkpoint.rstrip('/')}/marks/{number}"

    def store(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        files = Files(spark)
        latest = int(files.read_text(place(number - 1))) if files.exists(place(number - 1)) else None
        on_time = batch if latest is None else batch.filter(F.unix_micros("at") > (latest - millis(lateness)) * 1000)
        new = sinks.staged(told(on_time), name)
        try:
            own = new.agg(F.unix_millis(F.max("at_"))).first()[0]
            latest = max((x for x in (latest, own) if x is not None), default=None)
            if latest is None:
                return
            old = versions.rows_of(spark, name) if sinks.exists(spark, name) else spark.createDataFrame([], f"id long, {STATE}")
            changes = folded(old, new, patience, latest - millis(lateness))
            sinks.store(changes, name, ["id"], lambda old, new: upsert(old, new, ["id"]))
            files.write_text(place(number), str(latest))
        finally:
            sinks.unstaged(new)

    return store


def kept(results: DataFrame, name: str, patience: str, lateness: str, checkpoint: str) -> StreamingQuery:
    """Keeps the table of states up to date with what is there now of a stream ``id, stage, outcome, error, at``, then ends.

    Within a batch a season's results count in the order of ``at`` (those without one don't count); results before the watermark are dropped.
    """
    store = into_table(name, patience, lateness, checkpoint)
    return results.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
