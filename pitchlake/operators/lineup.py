"""Rosters, substitutions, profiles, and the enrichment of lineups and events by ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitchlake.functions.scalars import clock_minute

SUB = "didSub boolean, clock struct<displayValue: string>"


def substitution(starter: Column, sub_in: Column, sub_out: Column, plays: Column) -> tuple[Column, Column]:
    """(sub_in, sub_out) as text: 'start', 'end', a minute, or null.

    The raw fields are texts: 'true'/'false', or the JSON of an object.  If the
    incoming field is an object, both are read as objects; else minutes come
    from the substitutions among the plays.
    """
    is_object = lambda c: F.coalesce(F.startswith(F.ltrim(c), F.lit("{")), F.lit(False))
    parsed = lambda c: F.from_json(F.when(is_object(c), c), SUB)
    flag = lambda c: F.coalesce(F.when(is_object(c), F.coalesce(parsed(c)["didSub"], F.lit(False))).otherwise(F.lower(c) == "true"), F.lit(False))
    start = F.coalesce(starter, F.lit(False))
    objects = is_object(sub_in)
    events = F.filter(F.coalesce(plays, F.array()), lambda p: F.coalesce(p["substitution"], F.lit(False)))
    minute_at = lambda i: clock_minute(F.get(events, i)["clock"]["displayValue"])
    # read as plain flags, an outgoing object counts as set
    came = flag(sub_in)
    went = F.when(objects, flag(sub_out)).otherwise(flag(sub_out) | is_object(sub_out))
    in_minute = F.when(objects, clock_minute(parsed(sub_in)["clock"]["displayValue"])).otherwise(minute_at(F.lit(0)))
    out_minute = F.when(objects, clock_minute(parsed(sub_out)["clock"]["displayValue"])).otherwise(minute_at(F.when(came, 1).otherwise(0)))
    entered = F.when(start, F.lit("start")).when(came, in_minute.cast("string"))
    left = F.when((start | came) & ~went, F.lit("end")).when(went, out_minute.cast("string"))
    return entered, left


#: What a roster row says about its match, whether or not the summaries carry it.
GAME_INFO = {"game": "string", "game_id": "bigint", "league": "string", "season": "int"}


def stat_names(summaries: DataFrame) -> list[str]:
    """The distinct names of all statistics of all players: one small aggregation, for callers that want every one."""
    players = summaries.select(F.explode("rosters").alias("side")).select(F.explode("side.roster").alias("p"))
    return sorted(r[0] for r in players.select(F.explode("p.stats.name").alias("n")).filter("n is not null").distinct().collect())


def roster_rows(summaries: DataFrame, stats: tuple[str, ...] = ()) -> DataFrame:
    """One row per player of both sides; the first roster is the home side.

    A side without a roster or a team name is left out.  Statistics are those
    asked for (:func:`stat_names` lists all); a later one of the same name wins, and one named like
    another column takes that column's place, as text where that is no number.
    """
    info = [F.col(c).cast(t).alias(c) if c in summaries.columns else F.lit(None).cast(t).alias(c) for c, t in GAME_INFO.items()]
    sides = summaries.select(*info, "boxscore", F.posexplode(F.slice("rosters", 1, 2)).alias("pos", "side"))
    sides = sides.withColumn("team", F.get(F.col("boxscore.form"), F.col("pos"))["team"]["displayName"]).filter(F.col("team").isNotNull() & F.col("side.roster").isNotNull())
    p = sides.select(*GAME_INFO, "team", (F.col("pos") == 0).alias("is_home"), F.explode("side.roster").alias("p"))
    entered, left = substitution(F.col("p.starter"), F.col("p.subbedIn"), F.col("p.subbedOut"), F.col("p.plays"))
    values = F.coalesce(F.col("p.stats"), F.array())
    # the last entry of a name, without building a map that repeated names would break
    stat = lambda n: F.try_element_at(F.filter(values, lambda s: s["name"] == n), F.lit(-1))["value"]
    own = {c: F.col(c) for c in (*GAME_INFO, "team", "is_home")} | {
        "athlete_id": F.col("p.athlete.id").try_cast("bigint"),
        "player": F.coalesce("p.athlete.displayName", F.lit("Unknown")),
        "position": F.col("p.position.name"),
        "formation_place": F.col("p.formationPlace"),
        "starter": F.coalesce("p.starter", F.lit(False)),
        "sub_in": entered,
        "sub_out": left,
    }
    has = lambda n: F.exists(values, lambda s: s["name"] == n)
    clash = {n: F.when(has(n), stat(n).cast("string")).otherwise(own[n].cast("string")) for n in stats if n in own}
    return p.select(*[c.alias(n) for n, c in (own | clash | {n: stat(n) for n in stats if n not in own}).items()])


def first_rows(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in the given order."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("rn_", rank).filter("rn_ = 1").drop("rn_")


def enrich(left: DataFrame, right: DataFrame, keys: list[str], order: list[str], null_safe: bool = False) -> DataFrame:
    """Left join with the first right row of each key; optionally null keys match null keys.

    If a key or the right side's columns are missing, the input comes back unchanged.
    """
    if not set(keys) <= set(left.columns) or not set(keys) <= set(right.columns):
        return left
    one = first_rows(right, keys, order)
    own = [c for c in one.columns if c not in keys and c not in left.columns]
    if not null_safe:
        return left.join(one.select(*keys, *own), keys, "left")
    named = one.select(*[F.col(k).alias(f"r_{k}") for k in keys], *own)
    on = [left[k].eqNullSafe(named[f"r_{k}"]) for k in keys]
    return left.join(named, on, "left").drop(*[f"r_{k}" for k in keys])


def lineup_ids(lineup: DataFrame, rosters: DataFrame, null_safe: bool = False) -> DataFrame:
    """Athlete and game ids for lineup rows by (game, player, team)."""
    return enrich(lineup, rosters.select("game", "player", "team", "athlete_id", "game_id"), ["game", "player", "team"], ["athlete_id", "game_id"], null_safe)


def enriched_lineup(lineup: DataFrame, schedule: DataFrame, summaries: DataFrame, league: str, season: int) -> DataFrame:
    """Lineup rows with the athlete and game ids of the cached match summaries, by (game, player, team).

    Without ``game_id`` in the schedule the lineup comes back as it is.  Matches
    without a (readable) summary, sides without a roster or name, and players
    that aren't found keep null ids; if no summary has a player, so do all rows.
    """
    if "game_id" not in schedule.columns:
        return lineup
    games = schedule.select("game", F.col("game_id").cast("bigint").alias("game_id")).filter("game_id is not null").distinct()
    own = summaries.drop("game", "league", "season").join(games, "game_id").withColumns({"league": F.lit(league), "season": F.lit(season)})
    return lineup_ids(lineup, roster_rows(own))


def events_with_game_id(events: DataFrame, schedule: DataFrame) -> DataFrame:
    """Game ids for events; unmatched ones get null, missing columns leave the events as they are."""
    if "game" not in events.columns or not {"game", "game_id"} <= set(schedule.columns):
        return events
    return enrich(events, schedule.select("game", "game_id"), ["game"], ["game_id"])


def coverage(df: DataFrame, col: str) -> DataFrame:
    """Share of rows with a value, in percent."""
    return df.agg((F.avg(F.col(col).isNotNull().cast("double")) * 100).alias("coverage_pct"))


def distinct_ids(df: DataFrame, col: str = "athlete_id") -> DataFrame:
    """The ids that occur, each once, null apart."""
    return df.select(col).filter(F.col(col).isNotNull()).distinct()


def profile_rows(profiles: DataFrame) -> DataFrame:
    """Sixteen flat fields and the raw response; the player card is the first link of a fitting kind.

    The id is a number: the athlete's own, else the one that was asked for.
    """
    a = "athlete."
    card = F.get(F.filter(F.coalesce(F.col(a + "links"), F.array()), lambda link: F.coalesce(F.arrays_overlap(link["rel"], F.array(F.lit("playercard"), F.lit("overview"))), F.lit(False))), 0)["href"]
    plain = {"espn_guid": "guid", "first_name": "firstName", "last_name": "lastName", "display_name": "displayName", "full_name": "fullName", "jersey": "jersey", "position_id": "position.id", "position_name": "position.name", "team_id": "team.id", "team_name": "team.displayName", "date_of_birth": "displayDOB", "age": "age", "gender": "gender", "is_active": "active"}
    own_id = F.coalesce(F.col(a + "id").try_cast("bigint"), F.col("requested_id").try_cast("bigint"))
    raw = F.col("_raw") if "_raw" in profiles.columns else F.to_json(F.struct("athlete"))
    return profiles.select(own_id.alias("espn_athlete_id"), *[F.col(a + v).alias(k) for k, v in plain.items()], card.alias("profile_url"), raw.alias("_raw"))
