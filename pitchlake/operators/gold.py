"""Gold: a season of each player in each team and league."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.schemas import PLAYER_STATS
from pitchlake.sources.sizes import spread

RENAMED = {"total_goals": "goals", "goal_assists": "assists"}


def player_season_stats(stats: DataFrame) -> DataFrame:
    """One shuffle on the grain, in partitions that stay small; sums only of the statistics that exist, goals and assists always."""
    sums = [F.sum(c).alias(RENAMED.get(c, c)) for c in PLAYER_STATS if c in stats.columns]
    sums += [F.sum(F.lit(0)).alias(new) for old, new in RENAMED.items() if old not in stats.columns]
    grain = ["player", "team", "league", "season"]
    used = stats.select(*grain, "game", "starter", *[c for c in PLAYER_STATS if c in stats.columns])
    out = spread(used, *grain).groupBy(*grain).agg(F.count_distinct("game").alias("matches_played"), F.sum(F.when(F.col("starter"), 1).otherwise(0)).alias("matches_started"), *sums)
    return with_rates(out)


def with_rates(sums: DataFrame) -> DataFrame:
    """What follows from a season's sums."""
    return sums.withColumns({"goal_contributions": F.col("goals") + F.col("assists"), "goals_per_match": F.round(F.try_divide(F.col("goals"), F.col("matches_played")), 2)})


def top_scorers(stats: DataFrame, n: int = 10) -> DataFrame:
    """The season statistics with most goals; of equal ones by player, team and season."""
    return stats.orderBy(F.desc("goals"), "player", "team", "season").limit(n)
