"""Gold for many seasons in one run, and Gold kept up to date from partial sums of each match."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.operators.gold import RENAMED, player_season_stats, with_rates
from pitchlake.schemas import PLAYER_STATS
from pitchlake.sources import sinks, sizes, versions

PARTITION = ["season", "league"]
GRAIN = ["player", "team", *PARTITION]


def seasons_due(control: DataFrame, stage_ready: str = "silver_done") -> DataFrame:
    """``season, league`` of the seasons that wait for Gold: a table of a few rows."""
    return control.filter(F.col("status") == stage_ready).select("season", F.col("league_key").alias("league")).distinct()


def due_rows(table: DataFrame, due: DataFrame) -> DataFrame:
    """The rows of the partitions that are due; the join prunes the scan by what ``due`` turns out to hold."""
    return table.join(F.broadcast(due), PARTITION)  # a row a season


def gold_due(spark: SparkSession, database: str, due: DataFrame) -> list[dict[str, object]]:
    """Season statistics of all seasons due, in one job; their partitions are replaced, or removed where Silver has no rows."""
    wanted = [r.asDict() for r in due.select(*PARTITION).collect()]  # a row a season
    stats = due_rows(spark.table(f"{database}.player_match_stats"), due)
    return versions.publish_many(sinks.audited(player_season_stats(stats)), f"{database}.player_season_stats", PARTITION, wanted)


def partials(stats: DataFrame) -> DataFrame:
    """One row a player, team and match: what Gold adds up."""
    sums = [F.sum(c).alias(c) for c in PLAYER_STATS if c in stats.columns]
    return stats.groupBy(*GRAIN, "game").agg(F.sum(F.when(F.col("starter"), 1).otherwise(0)).alias("starts"), *sums)


#: Column by which rows of a season and league are cut into shares of even size.
CUT = "cut_"


def arranged(df: DataFrame, by: list[str], tasks: int, cuts: int) -> DataFrame:
    """Rows by season, league and a hash of ``by``, which is added as :data:`CUT`.

    What then joins or adds up by these and ``by`` needs no other shuffle, and a task's rows belong to few partitions of a table.
    """
    return df.withColumn(CUT, F.pmod(F.xxhash64(*by), F.lit(cuts))).repartition(tasks, *PARTITION, CUT)


def from_partials(parts: DataFrame) -> DataFrame:
    """:func:`pitchlake.operators.gold.player_season_stats` of the rows behind the partial sums, arranged by player and team or not."""
    sums = [F.sum(c).alias(RENAMED.get(c, c)) for c in PLAYER_STATS if c in parts.columns]
    sums += [F.sum(F.lit(0)).alias(new) for old, new in RENAMED.items() if old not in parts.columns]
    # a match is one row here, so nothing needs to be distinct
    keys = [*GRAIN, *(c for c in (CUT,) if c in parts.columns)]
    return with_rates(parts.groupBy(*keys).agg(F.count("game").alias("matches_played"), F.sum("starts").alias("matches_started"), *sums)).drop(CUT)


def take_in(spark: SparkSession, database: str, new: DataFrame) -> list[dict[str, object]]:
    """Takes in line-up rows of some matches, each of them whole; rows of a match that came before are replaced.

    Only partitions (season and league) of these rows are read and rewritten: their partial sums first, then their Gold, from
    the sums alone.  Taking in the same rows again changes nothing.  Returns the partitions.
    """
    sums, target = f"{database}.player_match_sums", f"{database}.player_season_stats"
    staged = sinks.staged(partials(new), "sums")
    try:
        hit = [r.asDict() for r in staged.select(*PARTITION).distinct().collect()]  # a row a season
        if not hit:
            return []
        due = spark.createDataFrame([tuple(h[k] for k in PARTITION) for h in hit], staged.select(*PARTITION).schema)
        known = sinks.exists(spark, sums)
        tasks = sizes.tasks(*([due_rows(spark.table(sums), due)] if known else []), staged)
        cuts = -(-2 * tasks // len(hit))
        fresh = arranged(staged, ["game"], tasks, cuts)
        merged = fresh
        if known:
            old = arranged(due_rows(spark.table(sums), due), ["game"], tasks, cuts)
            merged = old.join(fresh.select(*PARTITION, CUT, "game"), [*PARTITION, CUT, "game"], "left_anti").unionByName(fresh, allowMissingColumns=True)
        versions.publish_many(merged.drop(CUT), sums, PARTITION, arranged=True)
        rows = arranged(due_rows(spark.table(sums), due), ["player", "team"], tasks, cuts)
        versions.publish_many(sinks.audited(from_partials(rows)), target, PARTITION, hit, arranged=True)
        return hit
    finally:
        sinks.unstaged(staged)
