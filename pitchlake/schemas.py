"""Explicit schemas: nothing is inferred, so empty inputs plan too."""

from __future__ import annotations

#: The fourteen numeric statistics of a player in a match (fixed values).
PLAYER_STATS = ("total_goals", "goal_assists", "shots_on_target", "total_shots", "fouls_committed", "fouls_suffered", "yellow_cards", "red_cards", "own_goals", "offsides", "appearances", "saves", "shots_faced", "goals_conceded")
SHEET_META = ("league", "season", "game", "team", "is_home", "venue", "attendance", "capacity")

#: Columns every Bronze file has, and known ones it may have: both typed here; only further ones (statistics) get the type they show.
SCHEDULE = "game string, date string, home_team string, away_team string, league string, season int"
SCHEDULE_MORE = "game_id long, home_score string, away_score string, league_id string"
MATCHSHEET = "game string, league string, season int, team string, is_home boolean, venue string, attendance string, capacity string"
MATCHSHEET_MORE = "roster string"
LINEUP = "game string, player string, team string, league string, season int, is_home boolean, position string"
LINEUP_MORE = "game_id long, athlete_id long, starter boolean, is_starter boolean, formation_place string, " + ", ".join(f"{c} string" for c in PLAYER_STATS)
EVENTS = "game string"
EVENTS_MORE = "game_id string, event_type string, player string, season int, league string"
_SUB = "string"
SUMMARY = (
    "boxscore struct<form: array<struct<team: struct<displayName: string>>>>, rosters array<struct<roster: array<struct<"
    "athlete: struct<id: string, displayName: string>, position: struct<name: string>, formationPlace: string, starter: boolean, "
    f"subbedIn: {_SUB}, subbedOut: {_SUB}, plays: array<struct<substitution: boolean, clock: struct<displayValue: string>>>, "
    "stats: array<struct<name: string, value: double>>>>>>"
)
PROFILE = (
    "athlete struct<id: string, guid: string, firstName: string, lastName: string, displayName: string, fullName: string, jersey: string, "
    "position: struct<id: string, name: string>, team: struct<id: string, displayName: string>, displayDOB: string, age: int, gender: string, "
    "active: boolean, links: array<struct<rel: array<string>, href: string>>>"
)
CONTROL = (
    "id long, league_key string, season int, status string, bronze_started_at timestamp, bronze_completed_at timestamp, silver_started_at timestamp, "
    "silver_completed_at timestamp, gold_started_at timestamp, gold_completed_at timestamp, last_error string, last_error_stage string, created_at timestamp, updated_at timestamp"
)
CHECKS = "id long, season_id long, stage string, check_name string, status string, details string, checked_at timestamp"
RAW_EVENTS = (
    "message_hash string, dedupe_key string, entity_type string, entity_id string, provider string, league_key string, season int, payload_format string, "
    "source_path string, status string, error_message string, created_at timestamp, processed_at timestamp"
)
