"""What has been done, as a table of keys that lies in buckets of its key.

A batch is small and the history long: only the batch is shuffled to the history's buckets, the history
itself is read where it lies.  Each run adds its keys, one file a bucket; :func:`compacted` makes one of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.functions.scalars import KEY_FIELDS, dedupe_key
from pitchlake.sources.sinks import exists

KEY, BUCKETS = "dedupe_key", 64


def done_keys(events: DataFrame) -> DataFrame:
    """One key a done event: its own, or for an older event without one that of its five fields."""
    league = "league_key" if "league_key" in events.columns else "league"
    own = dedupe_key({f: F.col(league if f == "league" else f) for f in KEY_FIELDS})
    return events.filter("status = 'done'").select(F.coalesce(F.col(KEY), own).alias(KEY)).distinct()


def add(keys: DataFrame, name: str, buckets: int = BUCKETS) -> None:
    """Adds keys to the history, which is made if it is absent; keys that are there already may come again."""
    spaced = keys.filter(f"{KEY} is not null").select(KEY).repartition(buckets, KEY)
    spaced.write.bucketBy(buckets, KEY).sortBy(KEY).mode("append").format("parquet").saveAsTable(name)


def ensured(spark: SparkSession, name: str, events: DataFrame) -> DataFrame:
    """The history, made from all events so far if it is absent."""
    if not exists(spark, name):
        add(done_keys(events), name)
    return spark.table(name)


def flagged(messages: DataFrame, history: DataFrame) -> DataFrame:
    """``messages`` with ``done``: whether the history holds their key."""
    # distinct within each bucket: keys that were added twice count once
    return messages.join(history.select(KEY).distinct().withColumn("done", F.lit(True)), KEY, "left").select(*messages.columns, F.coalesce("done", F.lit(False)).alias("done"))


def split(messages: DataFrame, history: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(messages not done yet, those already done with their status)."""
    both = flagged(messages, history)
    return both.filter(~F.col("done")).drop("done"), both.filter("done").drop("done").withColumn("status", F.lit("already_done_in_db"))


def compacted(spark: SparkSession, name: str, buckets: int = BUCKETS) -> None:
    """The history with one file a bucket, each key once; written beside it first."""
    beside = f"{name}__next"
    spark.sql(f"DROP TABLE IF EXISTS {beside}")
    add(spark.table(name).select(KEY).distinct(), beside, buckets)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"ALTER TABLE {beside} RENAME TO {name}")
