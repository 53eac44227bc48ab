"""Names and types of the raw files and of every table built from them.

Everything else in the package reads its column lists from here, so a column is
named once and a table's order and types are the ones declared below.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# File, table and column names and types that users' queries and
# files depend on.
# --------------------------------------------------------------------------

MATCHES_FILE = "matches.csv"
DELIVERIES_FILE = "deliveries.csv"

# Raw columns and the type each one is cleansed to. Raw text stays text where
# the type is "string"; `date` is turned into a date by the match dimension.
RAW_MATCHES = {
    "id": "bigint",
    "season": "string",
    "city": "string",
    "venue": "string",
    "date": "string",
    "team1": "string",
    "team2": "string",
    "toss_winner": "string",
    "toss_decision": "string",
    "winner": "string",
    "win_by_runs": "int",
    "win_by_wickets": "int",
    "player_of_match": "string",
}

RAW_DELIVERIES = {
    "match_id": "bigint",
    "inning": "int",
    "batting_team": "string",
    "bowling_team": "string",
    "over": "int",
    "ball": "int",
    "batsman": "string",
    "non_striker": "string",
    "bowler": "string",
    "batsman_runs": "int",
    "extra_runs": "int",
    "total_runs": "int",
    "player_dismissed": "string",
    "dismissal_kind": "string",
}

# Columns without which a raw row is dropped.
MATCH_KEYS = ("id",)
DELIVERY_KEYS = ("match_id", "batsman", "bowler")

TABLES = {
    "dim_matches": {
        "match_id": "bigint",
        "season_year": "string",
        "city": "string",
        "venue": "string",
        "match_date": "date",
        "team1": "string",
        "team2": "string",
        "toss_winner": "string",
        "toss_decision": "string",
        "match_winner": "string",
        "win_by_runs": "int",
        "win_by_wickets": "int",
        "player_of_match": "string",
    },
    "dim_teams": {"team_id": "bigint", "team_name": "string"},
    "dim_players": {"player_id": "bigint", "player_name": "string"},
    "dim_seasons": {"season_id": "bigint", "season_year": "string"},
    "fact_deliveries": {
        "match_id": "bigint",
        "season": "string",
        "inning": "int",
        "batting_team": "string",
        "bowling_team": "string",
        "over": "int",
        "ball": "int",
        "batsman": "string",
        "non_striker": "string",
        "bowler": "string",
        "batsman_runs": "int",
        "extra_runs": "int",
        "total_runs": "int",
        "is_boundary": "int",
        "is_four": "int",
        "is_six": "int",
        "is_dot_ball": "int",
        "is_wicket": "int",
        "player_dismissed": "string",
        "dismissal_kind": "string",
    },
    "batting_stats": {
        "batsman": "string",
        "season": "string",
        "total_runs": "bigint",
        "balls_faced": "bigint",
        "boundaries": "bigint",
        "fours": "bigint",
        "sixes": "bigint",
        "matches_played": "bigint",
        "strike_rate": "double",
        "batting_average": "double",
    },
    "bowling_stats": {
        "bowler": "string",
        "season": "string",
        "wickets": "bigint",
        "runs_conceded": "bigint",
        "balls_bowled": "bigint",
        "dot_balls": "bigint",
        "matches_played": "bigint",
        "overs_bowled": "double",
        "economy_rate": "double",
        "bowling_average": "double",
        "dot_ball_pct": "double",
    },
}

# Match columns whose name changes on the way into the match dimension.
MATCH_RENAMES = {
    "match_id": "id",
    "season_year": "season",
    "match_date": "date",
    "match_winner": "winner",
}

# --------------------------------------------------------------------------


def columns(table: str) -> list[str]:
    """Column names of a built table, in order."""
    return list(TABLES[table])


def quoted(*parts: str) -> str:
    """A name as SQL, its parts quoted."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in parts)


def ddl(table: str) -> str:
    """Column list of a built table as DDL, e.g. ``"`team_id` bigint, ..."``."""
    return ", ".join(f"`{name}` {kind}" for name, kind in TABLES[table].items())


def struct(table: str) -> T.StructType:
    """Schema of a built table."""
    return T.StructType.fromDDL(ddl(table))


def typed_columns(raw: dict[str, str]) -> dict[str, str]:
    """The raw columns that are cast to something other than text."""
    return {name: kind for name, kind in raw.items() if kind != "string"}
