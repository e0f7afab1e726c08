"""The history of done keys: nothing of it is shuffled."""

from pyspark.sql import functions as F

from pitchlake.operators import ingest
from pitchlake.sources import history, sinks


def test_only_the_batch_is_shuffled(spark):
    name = "history_test"
    sinks.drop_tables(spark, [name])
    key = F.sha2(F.col("id").cast("string"), 256).alias("dedupe_key")
    for lo in (0, 2000):
        history.add(spark.range(lo, lo + 3000).select(key), name, 16)
    messages = spark.range(4000, 6000).select("id", key).union(spark.createDataFrame([(1, None)], "id long, dedupe_key string"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for _ in range(2):
            fresh, known = history.split(messages, spark.table(name))
            assert known.count() == 1000 and fresh.count() == 1001 and {r["status"] for r in known.collect()} == {"already_done_in_db"}
            plan = history.flagged(messages, spark.table(name))._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange ") == 1 and "Bucketed: true" in plan  # that of the messages
            history.compacted(spark, name, 16)
            assert spark.table(name).count() == 5000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        sinks.drop_tables(spark, [name])


def test_keys_of_older_events(spark):
    rows = [("K", "team", "1", "p", "L", 2024, "done"), (None, " TEAM", "1", "P", "l", 2024, "done"), (None, "team", "2", "p", "L", None, "failed"), (None, "team", "2", "p", "L", None, "done")]
    events = spark.createDataFrame(rows, "dedupe_key string, entity_type string, entity_id string, provider string, league_key string, season int, status string")
    messages = ingest.with_hashes(spark.createDataFrame([("team", "1", "p", "L", 2024, "x", "c"), ("team", "2", "p", "L", None, "x", "c"), ("team", "3", "p", "L", None, "x", "c")], "entity_type string, entity_id string, provider string, league string, season int, path string, created_at string"))
    keys = {r[0] for r in history.done_keys(events).collect()}
    own = {r["entity_id"]: r["dedupe_key"] for r in messages.collect()}
    assert keys == {"K", own["1"], own["2"]}
