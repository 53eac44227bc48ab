"""The four dimension tables.

Team, player and season names are collected from typed rows or from any table
that has the columns; repeats make no difference to a set of distinct names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pavilion import schemas
from pavilion.functions.parsing import parsed
from pavilion.operators.cleansing import distinct_values, smallest_per_key
from pavilion.operators.keys import with_dense_key

TEAM_COLUMNS = ("team1", "team2")
PLAYER_COLUMNS = ("batsman", "bowler")


def match_rows(typed: DataFrame) -> DataFrame:
    """Typed raw matches under the names and types of the match dimension."""
    kinds = schemas.TABLES["dim_matches"]
    source = {name: schemas.MATCH_RENAMES.get(name, name) for name in kinds}
    dates = {name for name, kind in kinds.items() if kind == "date"}
    return typed.select(
        *[
            (parsed(F.col(raw), "date") if name in dates else F.col(raw)).alias(name)
            for name, raw in source.items()
        ]
    )


def matches(typed: DataFrame) -> DataFrame:
    """One row per match. Conflicting rows of a match yield the smallest one."""
    return smallest_per_key(match_rows(typed), "match_id")


def match_seasons(typed: DataFrame) -> DataFrame:
    """``match_id`` and ``season_year`` of the match dimension, from two raw columns.

    The season is the first column by which `matches` compares rows, so the
    smallest season is the season of the smallest row.
    """
    return smallest_per_key(match_rows(typed).select("match_id", "season_year"), "match_id")


def teams(typed_matches: DataFrame) -> DataFrame:
    names = distinct_values(typed_matches, TEAM_COLUMNS, "team_name")
    return with_dense_key(names, "team_name", "team_id")


def players(deliveries: DataFrame, columns: tuple[str, ...] = PLAYER_COLUMNS) -> DataFrame:
    """Everyone named in ``columns``; pass more columns to include, say, the non-striker."""
    names = distinct_values(deliveries, columns, "player_name")
    return with_dense_key(names, "player_name", "player_id")


def players_of(batting_stats: DataFrame, bowling_stats: DataFrame) -> DataFrame:
    """The same players, from the statistics.

    Whoever batted or bowled has a row there, and those tables are far smaller
    than the deliveries.
    """
    batters = batting_stats.select(F.col("batsman").alias("player_name"))
    names = batters.union(bowling_stats.select("bowler")).distinct()
    return with_dense_key(names, "player_name", "player_id")


def seasons(typed_matches: DataFrame) -> DataFrame:
    names = distinct_values(typed_matches, ("season",), "season_year")
    return with_dense_key(names, "season_year", "season_id")
