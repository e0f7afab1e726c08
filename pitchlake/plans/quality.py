"""Quality gates and their audit log; the checks are really computed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchlake.functions.scalars import null_or_empty

STATUSES, STAGES = ("pass", "warn", "fail"), ("silver", "gold")
#: check name -> (table, column or None for a row count): ten of Silver, three of Gold (names are fixed values).
SILVER = {
    "teams_not_empty": ("teams", None),
    "players_not_empty": ("players", None),
    "match_statistics_not_empty": ("match_statistics", None),
    "player_match_stats_not_empty": ("player_match_stats", None),
    "team_name_null_rate_ok": ("teams", "team_name"),
    "player_name_null_rate_ok": ("players", "player"),
    "player_team_null_rate_ok": ("players", "team"),
    "match_game_null_rate_ok": ("match_statistics", "game"),
    "player_match_game_null_rate_ok": ("player_match_stats", "game"),
    "home_score_not_all_null": ("match_statistics", "home_score"),
}
GOLD = {"player_season_stats_not_empty": ("player_season_stats", None), "player_name_not_null": ("player_season_stats", "player"), "team_name_not_null": ("player_season_stats", "team")}
NULL_RATE = 0.05


def not_empty(df: DataFrame, name: str) -> None:
    if df.isEmpty():
        raise RuntimeError(f"{name} is empty")


def null_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows, and null or empty values of every column, in one pass."""
    return df.agg(F.count("*").alias("n_rows"), *[F.count_if(null_or_empty(F.col(c))).alias(f"null_{c}") for c in cols])


def keys_present(df: DataFrame, cols: list[str], name: str) -> None:
    found = null_counts(df, cols).first()
    bad = {c: found[f"null_{c}"] for c in cols if found[f"null_{c}"]}
    if bad:
        raise RuntimeError(f"{name}: null or empty keys {bad}")


def columns_of(checks: dict[str, tuple[str, str | None]]) -> dict[str, list[str]]:
    """table -> the columns that checks look at."""
    out: dict[str, list[str]] = {}
    for t, c in checks.values():
        out.setdefault(t, [])
        if c:
            out[t].append(c)
    return out


def observations(table: str, checks: dict[str, tuple[str, str | None]]) -> dict[str, Column]:
    """Aggregates that a write can gather on the way, in place of a second scan of what it stored."""
    return {f"null_{c}": F.count_if(null_or_empty(F.col(c))) for c in columns_of(checks).get(table, [])}


def verdicts(found: dict[str, dict], checks: dict[str, tuple[str, str | None]], null_rate: float = NULL_RATE) -> list[tuple[str, str, str]]:
    """(check, status, details) of each table's ``n_rows`` and ``null_<column>``.

    Some nulls warn, more than the rate fail; for ``not_all_null`` only a column without any value fails, and for
    ``not_null`` any null does; what hasn't been found fails.
    """
    out = []
    for name, (t, c) in checks.items():
        if t not in found:
            out.append((name, "fail", f"no table {t}"))
            continue
        rows = found[t]["n_rows"]
        if c is None:
            out.append((name, "pass" if rows else "fail", f"rows={rows}"))
        else:
            share = found[t][f"null_{c}"] / rows if rows else 0.0
            if name.endswith("not_all_null"):
                status = "pass" if share < 1 and rows else "fail"
            elif name.endswith("not_null"):
                status = "fail" if share else "pass"
            else:
                status = "pass" if share == 0 else "warn" if share <= null_rate else "fail"
            out.append((name, status, f"null_rate={share:.4f}"))
    return out


def evaluate(tables: dict[str, DataFrame], checks: dict[str, tuple[str, str | None]], null_rate: float = NULL_RATE) -> list[tuple[str, str, str]]:
    """:func:`verdicts` of tables that are already there: one aggregation each."""
    return verdicts({t: null_counts(tables[t], cols).first().asDict() for t, cols in columns_of(checks).items() if t in tables}, checks, null_rate)


def gold_gate(name: str, keys: list[str]) -> Callable[[dict], None]:
    """Raises for a table without rows, or with a null or empty key, from the metrics of its write."""
    def look(found: dict) -> None:
        if not found["n_rows"]:
            raise RuntimeError(f"{name} is empty")
        bad = {c: found[f"null_{c}"] for c in keys if found[f"null_{c}"]}
        if bad:
            raise RuntimeError(f"{name}: null or empty keys {bad}")

    return look


def recorded(log: DataFrame, season_id: int, stage: str, results: list[tuple[str, str, str]]) -> DataFrame:
    """The log with one more row per result; an unknown stage or status is an error."""
    if stage not in STAGES:
        raise ValueError(f"unknown stage: {stage}")
    for _, status, _ in results:
        if status not in STATUSES:
            raise ValueError(f"unknown status: {status}")
    top = log.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    spark = log.sparkSession
    rows = [(top + i + 1, season_id, stage, n, s, d) for i, (n, s, d) in enumerate(results)]
    new = spark.createDataFrame(rows, "id long, season_id long, stage string, check_name string, status string, details string")
    return log.unionByName(new.withColumn("checked_at", F.current_timestamp()))


def all_passed(stage: str) -> list[tuple[str, str, str]]:
    """Every check of a stage as passed, for callers that raised on failure before."""
    return [(n, "pass", "") for n in (SILVER if stage == "silver" else GOLD)]


def summary(log: DataFrame, season_id: int, stage: str | None = None) -> DataFrame:
    rows = log.filter(F.col("season_id") == season_id)
    if stage is not None:
        rows = rows.filter(F.col("stage") == stage)
    return rows.orderBy("stage", F.desc("checked_at"), "id").select("stage", "check_name", "status", "details", "checked_at")


def orphans(log: DataFrame, control: DataFrame) -> DataFrame:
    """Checks whose season is gone; a cascade keeps the others (:func:`cascaded`)."""
    return log.join(control.select(F.col("id").alias("season_id")), "season_id", "left_anti")


def cascaded(log: DataFrame, control: DataFrame) -> DataFrame:
    return log.join(control.select(F.col("id").alias("season_id")), "season_id", "left_semi")
