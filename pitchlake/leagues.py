"""League registry, slugs and object paths."""

from __future__ import annotations

import re
import warnings
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from pitchlake.functions.scalars import slug

#: league key -> slug (fixed values).
LEAGUES = {"BRA-Brasileirao": "brasileirao", "ITA-Serie A": "serie_a", "ENG-Premier League": "premier_league", "FRA-Ligue 1": "ligue_1"}
#: league key -> source key and months of a season, for leagues a source doesn't know by itself (fixed values).
MAPPINGS = {"BRA-Brasileirao": {"ESPN": "bra.1", "season_start": "Apr", "season_end": "Dec"}}
SEASONS = range(2022, 2027)


def with_mapping(known: dict[str, dict], key: str) -> dict[str, dict]:
    """A source's league table with the mapping of ``key`` where that is needed.

    What the source knows already stays; leagues it knows natively and unregistered ones (a warning) add nothing.
    """
    if key not in LEAGUES:
        warnings.warn(f"league {key!r} is not registered; the source may not know it", stacklevel=2)
    return known if key in known or key not in MAPPINGS else {**known, key: MAPPINGS[key]}


def source_key(key: str, known: dict[str, dict] | None = None) -> str:
    """The source's own name of a league; the first mapping's where it has none."""
    return with_mapping(known or {}, key).get(key, {}).get("ESPN", MAPPINGS["BRA-Brasileirao"]["ESPN"])


def league_slug(key: str) -> str:
    return LEAGUES.get(key) or re.sub("[^a-z0-9]+", "_", key.lower()).strip("_")


def league_slug_column(c: Column) -> Column:
    known = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in LEAGUES.items()))
    return F.coalesce(F.try_element_at(known, c), slug(c))


def bronze_path(root: str, league: str, season: int, entity: str) -> str:
    return f"{root.rstrip('/')}/espn/{league_slug(league)}/{season}/{entity}.json"


def seed_rows() -> list[tuple[str, int]]:
    """Every registered league in every seeded season."""
    return [(k, s) for k in LEAGUES for s in SEASONS]
