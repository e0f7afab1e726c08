"""Session settings; never stops a session it didn't start."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: ANSI stays on; a write replaces only the partitions it holds; the last of repeated map keys wins.
CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.session.timeZone": "UTC",
}


def session(name: str = "pitchlake", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    for k, v in {**CONF, **conf}.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
