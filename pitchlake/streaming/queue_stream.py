"""A streaming form of the file queue (an addition; the batch form is the contract).

New queue files are taken once each (checkpoint), deduplicated by key across
batches (state bounded by the watermark on ``created_at``), and handed on in
idempotent micro-batches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pitchlake.operators.ingest import parsed_messages, with_hashes


def messages(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(folder).select(F.col("value").alias("raw"))
    return with_hashes(parsed_messages(lines))


def consume(spark: SparkSession, folder: str, checkpoint: str, store: Callable[[DataFrame, int], None], lateness: str = "7 days") -> StreamingQuery:
    """Drains what is there now, then ends."""
    stream = messages(spark, folder).withColumn("event_time", F.coalesce(F.try_to_timestamp("created_at"), F.current_timestamp()))
    unique = stream.withWatermark("event_time", lateness).dropDuplicatesWithinWatermark(["dedupe_key"])
    return unique.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
