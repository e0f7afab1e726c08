"""Windows over event time on a file stream: late rows within a bound change their window, later ones are counted apart.

The watermark of a micro-batch is the latest time of all batches before it less the lateness; rows of a window that ended by then are dropped by
the engine, and its state goes.  :func:`late_rows` says which these are, by the same rule, from the marks that earlier batches left.
Results are written in update mode: a window that changes is written again, whole, so a batch that is repeated changes nothing.  Windows
that are complete when they come (append mode) are a partition of their batch, which a repeated batch replaces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pitchlake.operators.ingest import upsert
from pitchlake.sources import sinks, versions


def tumbling(rows: DataFrame, time: str, every: str, lateness: str, *keys: str, **aggregates: Column) -> DataFrame:
    """``start, end``, keys and aggregates (the number of rows ``n`` at least) of windows of equal length."""
    window = rows.withWatermark(time, lateness).groupBy(F.window(time, every).alias("w_"), *keys)
    return window.agg(F.count("*").alias("n"), *[c.alias(k) for k, c in aggregates.items()]).select("w_.start", "w_.end", *keys, "n", *aggregates)


def sessions(rows: DataFrame, time: str, gap: str, lateness: str, *keys: str, **aggregates: Column) -> DataFrame:
    """The same of sessions: rows of a key that follow each other by less than ``gap``.  A session is complete once the watermark has passed it: append mode."""
    session = rows.withWatermark(time, lateness).groupBy(F.session_window(time, gap).alias("w_"), *keys)
    return session.agg(F.count("*").alias("n"), *[c.alias(k) for k, c in aggregates.items()]).select("w_.start", "w_.end", *keys, "n", *aggregates)


def into_table(name: str, keys: list[str]) -> Callable[[DataFrame, int], None]:
    """Stores the windows of a batch in a keyed table, in place of what they were before."""
    return lambda batch, _: sinks.store(batch, name, keys, lambda old, new: upsert(old, new, keys))


def added_to_table(name: str) -> Callable[[DataFrame, int], None]:
    """Stores the windows of a batch, which never change again, as the table's partition ``batch``; nothing stored before is read or rewritten."""
    return lambda batch, number: versions.publish(batch.withColumn("batch", F.lit(number).cast("long")), name, {"batch": number})


def drained(windows: DataFrame, name: str, keys: list[str], checkpoint: str, mode: str = "update") -> StreamingQuery:
    """Takes what is there now, then ends.  In append mode the table is one of batches, else one of ``keys``."""
    store = added_to_table(name) if mode == "append" else into_table(name, keys)
    return windows.writeStream.outputMode(mode).foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def late_rows(batch: DataFrame, time: str, every: str, lateness: str, latest: object) -> DataFrame:
    """The rows whose window had ended by the watermark, given the latest time of all batches before (None: there were none)."""
    mark = F.lit(latest).cast("timestamp") - F.expr(f"INTERVAL {lateness}")
    return batch.filter(F.coalesce(F.window(time, every)["end"] <= mark, F.lit(False)))


def late_into_table(name: str, time: str, every: str, lateness: str) -> Callable[[DataFrame, int], None]:
    """Stores of each batch its latest time and how many of its rows came late: ``batch, latest, n, late``."""
    def store(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        latest = None
        if sinks.exists(spark, name):
            latest = spark.table(name).filter(F.col("batch") < number).agg(F.max("latest")).first()[0]
        own = batch.agg(F.lit(number).cast("long").alias("batch"), F.max(time).alias("latest"), F.count("*").alias("n"))
        late = late_rows(batch, time, every, lateness, latest).agg(F.count("*").alias("late"))
        sinks.store(own.join(F.broadcast(late)), name, ["batch"], lambda old, new: upsert(old, new, ["batch"]))  # one row each

    return store


def watched(rows: DataFrame, name: str, time: str, every: str, lateness: str, checkpoint: str) -> StreamingQuery:
    """Counts late rows of what is there now, then ends."""
    return rows.writeStream.foreachBatch(late_into_table(name, time, every, lateness)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def files(spark: SparkSession, folder: str, schema: str, **options: object) -> DataFrame:
    """A stream of the Parquet files that come to a folder."""
    return spark.readStream.schema(schema).options(**options).parquet(folder)
