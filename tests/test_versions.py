"""Partitions that change in one step, tables cut into buckets of their keys, and checks gathered while writing."""

import pytest
from pyspark.sql import functions as F

from pitchlake.operators import ingest
from pitchlake.plans import quality
from pitchlake.sources import sinks, versions
from pitchlake.sources.files import Files


def rows(spark, value, n=1000, season=2024, league="L'1"):
    return spark.range(n).select("id", F.lit(value).alias("v"), F.lit(season).alias("season"), F.lit(league).alias("league"))


def test_readers_see_one_version(spark):
    name = "versions_test"
    sinks.drop_tables(spark, [name])
    spec = {"season": 2024, "league": "L'1"}
    for value, season in ((1, 2023), (1, 2024)):
        versions.publish(rows(spark, value, season=season), name, {"season": season, "league": "L'1"})
    old = spark.table(name).filter("season = 2024").toLocalIterator()
    first = next(old)  # this scan has begun
    assert versions.publish(rows(spark, 2, 10), name, spec)["n_rows"] == 10
    between = spark.table(name).filter("season = 2024").collect()
    versions.publish(rows(spark, 3, 20), name, spec)
    rest = [first, *old]
    assert len(rest) == 1000 and {r["v"] for r in rest} == {1}
    assert len(between) == 10 and {r["v"] for r in between} == {2}
    after = spark.table(name).groupBy("season", "v").count().collect()
    assert sorted(map(tuple, after)) == [(2023, 1, 1000), (2024, 3, 20)]
    # nothing retired is young enough to stay for ever
    files = Files(spark)
    gone = versions.expire(spark, name, retained=0)
    assert len(gone) == 2 and not any(files.exists(p) for p in gone) and spark.table(name).count() == 1020
    # no rows: the partition goes, for new readers
    versions.publish(rows(spark, 3, 0), name, spec)
    assert spark.sql(f"SHOW PARTITIONS {name}").count() == 1 and spark.table(name).count() == 1000
    assert versions.place(spark, name, spec) is None and versions.publish(rows(spark, 3, 0), name, spec)["n_rows"] == 0
    sinks.drop_tables(spark, [name])


def test_what_fails_publishes_nothing(spark):
    name = "versions_fail"
    sinks.drop_tables(spark, [name])
    spec = {"season": 2024, "league": "L'1"}
    versions.publish(rows(spark, 1, 5), name, spec)
    with pytest.raises(ValueError):
        versions.publish(rows(spark, 2, 5, season=2023), name, spec)
    with pytest.raises(RuntimeError, match="empty keys"):
        versions.publish(rows(spark, 2, 5).withColumn("player", F.lit("")), name, spec, {"null_player": F.count_if(F.col("player") == "")}, quality.gold_gate("t", ["player"]))
    with pytest.raises(RuntimeError, match="is empty"):
        versions.publish(rows(spark, 2, 0), name, spec, gate=quality.gold_gate("t", []))
    with pytest.raises(Exception, match="boom"):
        versions.publish(rows(spark, 2, 5).withColumn("v", F.raise_error(F.lit("boom")).cast("int")), name, spec)
    assert [r["v"] for r in spark.table(name).collect()] == [1] * 5
    left = [p for p in Files(spark).names(f"{versions.place(spark, name)}/_versions") if not p.endswith("_retired")]
    assert len(left) == 1
    # types of the table stay, new columns are added, missing ones are null
    versions.publish(rows(spark, 2, 3).withColumn("v", F.lit(7).cast("long")).withColumn("more", F.lit("m")), name, spec)
    assert [(r["v"], r["more"]) for r in spark.table(name).collect()] == [(7, "m")] * 3 and dict(spark.table(name).dtypes)["v"] == "int"
    versions.publish(rows(spark, 2, 1).drop("v"), name, spec)
    assert spark.table(name).first()["v"] is None
    sinks.drop_tables(spark, [name])


def test_upserts_touch_only_their_buckets(spark):
    name = "keyed_test"
    sinks.drop_tables(spark, [name])
    merge = lambda old, new: ingest.upsert(old, new, ["id"], keep=("first",), order=F.col("v"))
    sinks.store(spark.range(2000).select("id", F.lit(0).alias("v"), F.lit("a").alias("first")), name, ["id"], merge)
    assert versions.buckets_of(spark, name) == 64
    places = lambda: {r[0]: versions.place(spark, name, {versions.BUCKET: r[0]}) for r in spark.table(name).select(versions.BUCKET).distinct().collect()}
    before = places()
    new = spark.createDataFrame([(5, 1, "b", 9.5), (5, 2, "c", 8.5), (5000, 3, "d", None), (None, 1, "n", 1.0)], "id long, v int, first string, more double")
    sinks.store(new, name, ["id"], merge)
    after = places()
    hit = {r[0] for r in new.select(versions.bucket_of(["id"], 64)).collect()}
    assert {b for b in after if after[b] != before[b]} == hit and len(hit) <= 3
    got = {r["id"]: r for r in versions.rows_of(spark, name).collect()}
    assert len(got) == 2002 and (got[5]["v"], got[5]["first"], got[5]["more"]) == (2, "a", 8.5) and got[5000]["v"] == 3 and got[None]["first"] == "n" and got[6]["more"] is None
    assert spark.table(name).filter(F.col(versions.BUCKET) != versions.bucket_of(["id"], 64)).isEmpty()
    sinks.store(new.limit(0), name, ["id"], merge)
    assert places() == after
    sinks.drop_tables(spark, [name])


def test_many_partitions_with_odd_values(spark):
    name = "versions_many"
    sinks.drop_tables(spark, [name])
    df = spark.createDataFrame([(i, s, x) for i, (s, x) in enumerate([(1, "a b"), (1, "c%/d='e"), (None, "n"), (2, "é"), (2, "a b")])], "v long, season int, league string")
    for n in range(2):
        done = versions.publish_many(df.withColumn("v", F.col("v") + 10 * n), name, ["season", "league"])
        assert len(done) == 5 and sorted(map(str, spark.table(name).collect())) == sorted(map(str, df.withColumn("v", F.col("v") + 10 * n).collect()))
    versions.publish_many(df.filter("season = 2"), name, ["season", "league"], due=[{"season": 1, "league": "a b"}, {"season": 7, "league": "x"}, {"season": 2, "league": "é"}])
    assert sorted((r["v"], r["league"]) for r in spark.table(name).collect()) == [(3, "é"), (4, "a b"), (11, "c%/d='e"), (12, "n")]
    sinks.drop_tables(spark, [name])


def test_checks_of_a_write_equal_those_of_a_scan(spark):
    name = "observed_test"
    sinks.drop_tables(spark, [name])
    df = spark.range(100).select(F.when(F.col("id") > 2, F.lit("p")).alias("player"), F.when(F.col("id") > 30, "").otherwise("t").alias("team"), F.lit(1).alias("season"), F.lit("x").alias("league"))
    found = sinks.write_partitioned(df, name, 1, "x", quality.observations("players", quality.SILVER))
    stored = {"players": spark.table(name)}
    assert quality.verdicts({"players": found}, quality.SILVER) == quality.evaluate(stored, quality.SILVER)
    assert dict((c, s) for c, s, _ in quality.evaluate(stored, quality.SILVER) if c.startswith("player_")) == {"player_name_null_rate_ok": "warn", "player_team_null_rate_ok": "fail", "player_match_stats_not_empty": "fail", "player_match_game_null_rate_ok": "fail"}
    sinks.drop_tables(spark, [name])
