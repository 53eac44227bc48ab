"""Totals per player and season."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pavilion import schemas
from pavilion.functions import rates
from pavilion.plans.facts import with_season


def per_season(
    rows: DataFrame,
    keys: list[str],
    totals: dict[str, Column],
    matches_as: str,
    matches: DataFrame | None = None,
) -> DataFrame:
    """``totals`` and the number of distinct matches per ``keys`` and season.

    ``rows`` is the fact, or deliveries without a season plus ``matches`` to
    look it up in. In the latter case the rows are first reduced to one per key
    and match, so the join moves those instead of every ball.
    """
    if matches is None:
        distinct = F.count_distinct("match_id").alias(matches_as)
        return rows.groupBy(*keys, "season").agg(
            *[total.alias(name) for name, total in totals.items()], distinct
        )
    by_match = rows.groupBy(*keys, "match_id").agg(
        *[total.alias(name) for name, total in totals.items()]
    )
    # Without further keys there is one row per match, which needs no salting.
    # Hot matches are looked for among the balls, whose shuffle is shared.
    seasoned = with_season(by_match, matches, None if keys else 0, like=rows)
    return (
        seasoned.groupBy(*keys, "season")
        .agg(*[F.sum(name).alias(name) for name in totals], F.count("match_id").alias(matches_as))
    )


def batting(rows: DataFrame, matches: DataFrame | None = None) -> DataFrame:
    """Batting totals per batter and season; arguments as for `per_season`.

    ``batting_average`` is runs per match played; `reports.runs_per_dismissal`
    has the average in the usual sense.
    """
    totals = {
        "total_runs": F.sum("batsman_runs"),
        "balls_faced": F.count("ball"),
        "boundaries": F.sum("is_boundary"),
        "fours": F.sum("is_four"),
        "sixes": F.sum("is_six"),
    }
    summed = per_season(rows, ["batsman"], totals, "matches_played", matches)
    return summed.withColumns(
        {
            "strike_rate": rates.strike_rate("total_runs", "balls_faced"),
            "batting_average": rates.ratio("total_runs", "matches_played"),
        }
    ).select(*schemas.columns("batting_stats"))


def bowling(rows: DataFrame, matches: DataFrame | None = None) -> DataFrame:
    """Bowling totals per bowler and season; arguments as for `per_season`.

    A bowler is charged with all runs of the ball and credited with every
    dismissal on it. ``bowling_average`` is NULL without a wicket.
    """
    totals = {
        "wickets": F.sum("is_wicket"),
        "runs_conceded": F.sum("total_runs"),
        "balls_bowled": F.count("ball"),
        "dot_balls": F.sum("is_dot_ball"),
    }
    summed = per_season(rows, ["bowler"], totals, "matches_played", matches)
    return summed.withColumns(
        {
            "overs_bowled": rates.overs("balls_bowled"),
            "economy_rate": rates.economy("runs_conceded", "balls_bowled"),
            "bowling_average": rates.ratio("runs_conceded", "wickets"),
            "dot_ball_pct": rates.percentage("dot_balls", "balls_bowled"),
        }
    ).select(*schemas.columns("bowling_stats"))
