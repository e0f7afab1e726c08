"""Steps whose tasks stay small however much comes in."""

from pyspark.sql import functions as F

from pitchlake import catalog
from pitchlake.operators import gold
from pitchlake.plans import control, incremental
from pitchlake.sources import sizes


def test_gold_takes_partitions_by_the_size_of_its_input(spark, tmp_path, monkeypatch):
    rows = spark.range(3000).select((F.col("id") % 50).alias("game"), (F.col("id") % 300).alias("player"), F.lit("t").alias("team"), F.lit("L").alias("league"), F.lit(2024).alias("season"), (F.col("id") % 2 == 0).alias("starter"), F.lit(1).alias("total_goals"))
    want = sorted(map(tuple, gold.player_season_stats(rows).collect()))
    rows.write.parquet(str(tmp_path / "rows"))
    stored = spark.read.parquet(str(tmp_path / "rows"))
    assert sizes.input_bytes(rows) == 0 and sizes.input_bytes(stored) > 2000
    assert sizes.spread(stored, "player", share=1 << 30) is stored
    monkeypatch.setattr(sizes, "SHARE", sizes.input_bytes(stored) // 19)
    found = gold.player_season_stats(stored)
    assert found.rdd.getNumPartitions() >= 19
    assert sorted(map(tuple, found.collect())) == want


def test_folding_sorts_no_texts(spark):
    t = spark.createDataFrame([(1, "L", 2024, "pending")], "id long, league_key string, season int, status string")
    t = control.empty(spark).unionByName(t, allowMissingColumns=True)
    changes = spark.range(1000).select((F.col("id") % 2 + 1).alias("id"), F.lit("gold").alias("stage"), F.when(F.col("id") < 990, "failed").otherwise("completed").alias("outcome"), F.repeat(F.col("id").cast("string"), F.lit(700)).alias("error"), F.timestamp_seconds("id").alias("at"))
    done = control.folded(t, changes)
    # the texts that are sorted are those of the last rows only: a join has picked them below
    assert "BroadcastHashJoin" in done._jdf.queryExecution().executedPlan().toString().rpartition("SortAggregate")[2]
    first = done.first()
    assert (first["status"], first["last_error"], first["last_error_stage"]) == ("complete", ("988" * 700)[:2000], "gold") and first["updated_at"].timestamp() == 998


def test_increments_shuffle_rows_once_for_each_table(spark, monkeypatch):
    db = "arranged_test"
    spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
    spark.sql(f"CREATE DATABASE {db}")
    rows = spark.range(600).select((F.col("id") % 50).alias("game"), (F.col("id") % 60).alias("player"), F.lit("t").alias("team"), F.lit("L").alias("league"), (2020 + F.col("id") % 3).cast("int").alias("season"), (F.col("id") % 2 == 0).alias("starter"), F.lit(1).alias("total_goals"))
    plans = []
    publish = incremental.versions.publish_many
    monkeypatch.setattr(incremental.versions, "publish_many", lambda df, *a, **k: plans.append((df._jdf.queryExecution().executedPlan().toString(), k)) or publish(df, *a, **k))
    incremental.take_in(spark, db, rows.filter("game < 30"))
    incremental.take_in(spark, db, rows.filter("game > 20").withColumn("total_goals", F.lit(2)))
    shuffles = [p.count("Exchange hashpartitioning") for p, _ in plans]
    # old rows, their games and new rows; then Gold's, once each
    assert shuffles[0] == 1 and shuffles[1] == 1 and shuffles[2] <= 3 and shuffles[3] == 1 and all(k.get("arranged") for _, k in plans)
    got = spark.table(f"{db}.player_season_stats").drop("processed_at")
    want = gold.player_season_stats(rows.withColumn("total_goals", F.when(F.col("game") > 20, 2).otherwise(1)))
    assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect()))
    spark.sql(f"DROP DATABASE {db} CASCADE")


def test_silver_of_due_seasons_is_cut_by_size(spark, monkeypatch):
    seen = []
    publish = catalog.versions.publish_many
    monkeypatch.setattr(catalog.versions, "publish_many", lambda df, *a, **k: seen.append(df) or publish(df, *a, **k))
    monkeypatch.setattr(sizes, "SHARE", 10_000)
    rows = catalog.gold_of_due_seasons(spark, "/root/testdata/sf0.001").count()
    assert rows and seen[0].rdd.getNumPartitions() >= 12
