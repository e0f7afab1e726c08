"""Gold of the seasons that are due, and Gold from partial sums."""

from pyspark.sql import functions as F

from pitchlake.operators import gold
from pitchlake.plans import incremental
from pitchlake.sources import versions


def stats(spark, games, season, league="A 1%", goals=1):
    g = spark.range(*games).select(F.format_string("g%d", "id").alias("game"), F.explode(F.sequence(F.lit(0), F.lit(3))).alias("n"))
    return g.select("game", F.concat(F.lit("p"), F.col("n") % 3).alias("player"), F.lit("t").alias("team"), F.lit(league).alias("league"), F.lit(season).alias("season"), (F.col("n") < 2).alias("starter"), F.lit(goals).alias("total_goals"), (F.col("n") % 2).alias("saves"))


def rows(df):
    cols = sorted(set(df.columns) - {"processed_at"})
    return sorted(map(tuple, df.select(cols).collect()))


def test_increments_equal_a_full_run(spark):
    db = "incremental_test"
    spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
    spark.sql(f"CREATE DATABASE {db}")
    parts = [stats(spark, (0, 10), 2023), stats(spark, (0, 6), 2024).unionByName(stats(spark, (0, 4), 2024, "B")), stats(spark, (4, 9), 2024, goals=3)]
    places = lambda table: {(r["season"], r["league"]): versions.place(spark, f"{db}.{table}", r.asDict()) for r in spark.table(f"{db}.{table}").select("season", "league").distinct().collect()}
    assert incremental.take_in(spark, db, parts[0].limit(0)) == []
    for p in parts[:2]:
        incremental.take_in(spark, db, p)
    before = places("player_season_stats"), places("player_match_sums")
    hit = incremental.take_in(spark, db, parts[2])
    assert hit == [{"season": 2024, "league": "A 1%"}]
    # other seasons are left where they are
    for old, new in zip(before, (places("player_season_stats"), places("player_match_sums")), strict=True):
        assert {k for k in new if new[k] != old.get(k)} == {(2024, "A 1%")}
    whole = parts[0].unionByName(stats(spark, (0, 4), 2024)).unionByName(stats(spark, (0, 4), 2024, "B")).unionByName(parts[2])
    want = rows(gold.player_season_stats(whole))
    assert rows(spark.table(f"{db}.player_season_stats")) == want and len(want) == 9
    incremental.take_in(spark, db, parts[2])
    assert rows(spark.table(f"{db}.player_season_stats")) == want
    spark.sql(f"DROP DATABASE {db} CASCADE")


def test_only_due_seasons_are_scanned(spark):
    db = "due_test"
    spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
    spark.sql(f"CREATE DATABASE {db}")
    both = stats(spark, (0, 10), 2023).unionByName(stats(spark, (0, 5), 2024)).unionByName(stats(spark, (0, 5), 2022))
    versions.publish_many(both, f"{db}.player_match_stats", ["season", "league"])
    control = spark.createDataFrame([("A 1%", 2024, "silver_done"), ("A 1%", 2023, "complete"), ("A 1%", 2021, "silver_done"), ("A 1%", 2022, "silver_done")], "league_key string, season int, status string")
    due = incremental.seasons_due(control)
    plan = incremental.due_rows(spark.table(f"{db}.player_match_stats"), due)._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan[plan.index("PartitionFilters") :]
    versions.publish_many(gold.player_season_stats(stats(spark, (0, 2), 2021)), f"{db}.player_season_stats", ["season", "league"])
    done = incremental.gold_due(spark, db, due)
    assert sorted(s["season"] for s in done) == [2022, 2024]
    got = spark.table(f"{db}.player_season_stats")
    assert sorted({r["season"] for r in got.collect()}) == [2022, 2024]  # 2021 has no rows in Silver any more
    assert rows(got) == rows(gold.player_season_stats(both.filter("season <> 2023")))
    spark.sql(f"DROP DATABASE {db} CASCADE")
