"""The driver's tables seen as football inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.sources.sizes import spread


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def leagues(spark: SparkSession, d: str) -> DataFrame:
    """team -> league: supplier, nation, region."""
    s, n, r = read(spark, d, "supplier"), read(spark, d, "nation"), read(spark, d, "region")
    return s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey).select(F.col("s_suppkey").alias("team"), F.col("r_name").alias("league"))


def schedule(spark: SparkSession, d: str) -> DataFrame:
    o = read(spark, d, "orders")
    return o.select(F.col("o_orderkey").alias("game"), F.year("o_orderdate").alias("season"), F.col("o_orderstatus").alias("league"), F.col("o_orderpriority").alias("home_team"), F.col("o_custkey").cast("string").alias("away_team"))


#: What a line-up takes of its line items.
LINES = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_tax", "l_returnflag", "l_linestatus"]


def lineup(spark: SparkSession, d: str) -> DataFrame:
    li, o = read(spark, d, "lineitem").select(*LINES), read(spark, d, "orders")
    # a join only sorts its rows, which takes less room than adding them up
    li = spread(li, "l_orderkey", share=16 << 20)
    rows = li.join(o.select("o_orderkey", F.year("o_orderdate").alias("season")), li.l_orderkey == F.col("o_orderkey"))
    rows = rows.join(leagues(spark, d), rows.l_suppkey == F.col("team"))
    return rows.select(
        F.col("l_orderkey").alias("game"),
        F.col("l_partkey").alias("player"),
        "team",
        "league",
        "season",
        (F.col("l_linestatus") == "O").alias("is_home"),
        F.col("l_returnflag").alias("position"),
        (F.col("l_linenumber") == 1).alias("starter"),
        F.col("l_quantity").cast("string").alias("total_goals"),
        F.col("l_linenumber").cast("string").alias("goal_assists"),
        F.when(F.col("l_tax") > 0.04, "x").otherwise(F.col("l_linenumber").cast("string")).alias("yellow_cards"),
    )


def matchsheet(spark: SparkSession, d: str) -> DataFrame:
    """Two rows a game at most: line items by game and side first."""
    li, o = read(spark, d, "lineitem"), read(spark, d, "orders")
    rows = li.groupBy("l_orderkey", "l_linestatus").agg(
        F.min("l_suppkey").alias("team"), F.min("l_returnflag").alias("venue"), F.sum(F.col("l_quantity").cast("int")).cast("double").alias("attendance"),
        F.max("l_extendedprice").alias("capacity"), F.count("*").alias("shots"), F.sum("l_linenumber").alias("possession"),
    )
    rows = rows.join(o.select("o_orderkey", F.year("o_orderdate").alias("season")), rows.l_orderkey == F.col("o_orderkey")).join(leagues(spark, d), "team")
    return rows.select(F.col("l_orderkey").alias("game"), "league", "season", "team", (F.col("l_linestatus") == "O").alias("is_home"), "venue", "attendance", "capacity", "shots", "possession")


def messages(spark: SparkSession, d: str) -> DataFrame:
    """Events as queue messages; case and blanks vary with the line."""
    e = read(spark, d, "events")
    odd = F.col("event_id") % 2 == 1
    return e.select(
        F.col("event_id").alias("line_no"),
        F.when(odd, F.upper("event_type")).otherwise(F.concat(F.lit(" "), F.col("event_type"), F.lit("\t"))).alias("entity_type"),
        F.col("user_id").cast("string").alias("entity_id"),
        F.lit("json").alias("payload_format"),
        F.concat(F.lit("/data/"), F.col("event_id").cast("string"), F.lit(".json")).alias("path"),
        F.lit("ESPN").alias("provider"),
        F.lit('BRA-"Serie\\A"').alias("league"),
        F.year("ts").alias("season"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("created_at"),
    )
