"""The analytical reports.

A report takes the tables it reads and returns a DataFrame. Counts of balls are
counts of deliveries with a ball number, extras included. Every order ends with
the group key, so ties come out the same way each time.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pavilion.functions import rates
from pavilion.functions.flags import flag
from pavilion.operators.ranking import top, top_per_group
from pavilion.plans.stats import per_season
from pavilion.sources.files import read_table

# Cut-offs of the standard reports.
TOP = 10
MIN_BALLS_FACED = 500
MIN_BALLS_BOWLED = 120
POWERPLAY = (1, 6)
HALF_CENTURY, CENTURY = 50, 100


# ---- batting and bowling, over deliveries ----------------------------------


def top_run_scorers(fact: DataFrame, k: int = TOP) -> DataFrame:
    summed = fact.groupBy("batsman").agg(
        F.sum("batsman_runs").alias("total_runs"),
        F.count_distinct("match_id").alias("matches"),
        rates.strike_rate(F.sum("batsman_runs"), F.count("ball")).alias("strike_rate"),
        F.sum("is_six").alias("sixes"),
        F.sum("is_four").alias("fours"),
    )
    return top(summed, k, F.desc("total_runs"), "batsman")


def top_wicket_takers(fact: DataFrame, k: int = TOP) -> DataFrame:
    wickets, conceded, balls = F.sum("is_wicket"), F.sum("total_runs"), F.count("ball")
    summed = fact.groupBy("bowler").agg(
        wickets.alias("wickets"),
        conceded.alias("runs_conceded"),
        rates.economy(conceded, balls).alias("economy_rate"),
        rates.ratio(conceded, wickets).alias("bowling_average"),
        rates.percentage(F.sum("is_dot_ball"), balls).alias("dot_ball_pct"),
    )
    return top(summed, k, F.desc("wickets"), "bowler")


def best_strike_rates(fact: DataFrame, min_balls: int = MIN_BALLS_FACED, k: int = TOP) -> DataFrame:
    summed = fact.groupBy("batsman").agg(
        F.sum("batsman_runs").alias("runs"), F.count("ball").alias("balls_faced")
    )
    rated = summed.where(F.col("balls_faced") >= min_balls).withColumn(
        "strike_rate", rates.strike_rate("runs", "balls_faced")
    )
    return top(rated, k, F.desc("strike_rate"), "batsman")


def powerplay_economy(
    fact: DataFrame,
    overs: tuple[int, int] = POWERPLAY,
    min_balls: int = MIN_BALLS_BOWLED,
    k: int = TOP,
) -> DataFrame:
    summed = (
        fact.where(F.col("over").between(*overs))
        .groupBy("bowler")
        .agg(
            F.count_distinct("match_id").alias("matches"),
            F.sum("total_runs").alias("runs"),
            F.count("ball").alias("balls"),
        )
        .where(F.col("balls") >= min_balls)
    )
    rated = summed.select("bowler", "matches", rates.economy("runs", "balls").alias("powerplay_economy"))
    return top(rated, k, F.asc_nulls_first("powerplay_economy"), "bowler")


def milestones(
    fact: DataFrame, half_century: int = HALF_CENTURY, century: int = CENTURY
) -> DataFrame:
    """Innings of at least ``century`` runs, and of ``half_century`` up to that, per batter."""
    innings = fact.groupBy("batsman", "match_id", "inning").agg(F.sum("batsman_runs").alias("runs"))
    runs = F.col("runs")
    return innings.groupBy("batsman").agg(
        F.count_if(runs >= century).alias("centuries"),
        F.count_if((runs >= half_century) & (runs < century)).alias("half_centuries"),
    )


def runs_per_dismissal(fact: DataFrame) -> DataFrame:
    """Batting average in the usual sense, for everyone who faced a ball.

    One scan sums runs and balls per batter and player dismissed, which leaves
    few rows; each is then counted for both names, so there is no join.
    """
    none = F.lit(0).cast("bigint")
    pairs = fact.groupBy("batsman", "player_dismissed").agg(
        F.sum("batsman_runs").alias("runs"), F.count("*").alias("balls")
    )
    faced = F.struct(
        F.col("batsman"), F.col("runs"), F.col("balls").alias("faced"), none.alias("dismissed")
    )
    dismissed = F.struct(
        F.col("player_dismissed").alias("batsman"),
        F.lit(None).cast("bigint").alias("runs"),
        none.alias("faced"),
        F.col("balls").alias("dismissed"),
    )
    return (
        pairs.select(F.inline(F.array(faced, dismissed)))
        .where(F.col("batsman").isNotNull())
        .groupBy("batsman")
        .agg(
            F.sum("runs").alias("total_runs"),
            F.sum("dismissed").alias("dismissals"),
            F.sum("faced").alias("faced"),
        )
        .where(F.col("faced") > 0)
        .select(
            "batsman",
            "total_runs",
            "dismissals",
            rates.ratio("total_runs", "dismissals").alias("runs_per_dismissal"),
        )
    )


# ---- seasons, over the fact or deliveries with a match lookup ---------------


def season_totals(fact: DataFrame, matches: DataFrame | None = None) -> DataFrame:
    """Runs and matches per season, in text order of the season."""
    summed = per_season(fact, [], {"total_runs": F.sum("total_runs")}, "total_matches", matches)
    return summed.withColumn(
        "avg_runs_per_match", rates.ratio("total_runs", "total_matches")
    ).orderBy(F.asc_nulls_first("season"))


def most_sixes_in_season(
    fact: DataFrame, matches: DataFrame | None = None, k: int = TOP
) -> DataFrame:
    if matches is None:
        summed = fact.groupBy("batsman", "season").agg(F.sum("is_six").alias("sixes"))
    else:
        summed = per_season(fact, ["batsman"], {"sixes": F.sum("is_six")}, "matches", matches)
    return top(
        summed.select("batsman", "season", "sixes"),
        k,
        F.desc("sixes"),
        "batsman",
        F.asc_nulls_first("season"),
    )


def season_top_batters(batting_stats: DataFrame, k: int = TOP) -> DataFrame:
    ranked = top_per_group(batting_stats, "season", k, F.desc("total_runs"), "batsman")
    return ranked.select("season", "rank", "batsman", "total_runs")


def season_top_bowlers(bowling_stats: DataFrame, k: int = TOP) -> DataFrame:
    ranked = top_per_group(bowling_stats, "season", k, F.desc("wickets"), "bowler")
    return ranked.select("season", "rank", "bowler", "wickets")


# ---- matches ----------------------------------------------------------------


def team_wins(matches: DataFrame) -> DataFrame:
    won = matches.where(F.col("match_winner").isNotNull())
    return (
        won.groupBy(F.col("match_winner").alias("team"))
        .agg(F.count("*").alias("wins"))
        .orderBy(F.desc("wins"), "team")
    )


def win_loss(matches: DataFrame) -> DataFrame:
    """Matches played, won, lost, without a result, and won by neither side, per team.

    Each match is turned into a row for either side within one scan. A match is lost
    only if the other side won it; a winner that did not play is ``unclear``.
    """
    winner = F.col("match_winner")
    sides = F.array(
        F.struct(F.col("team1").alias("team"), F.col("team2").alias("other")),
        F.struct(F.col("team2").alias("team"), F.col("team1").alias("other")),
    )
    won, lost = winner == F.col("team"), winner.eqNullSafe(F.col("other"))
    return (
        matches.select(F.inline(sides), "match_winner")
        .where(F.col("team").isNotNull())
        .groupBy("team")
        .agg(
            F.count("*").alias("played"),
            F.count_if(won).alias("won"),
            F.count_if(winner.isNotNull() & ~won & lost).alias("lost"),
            F.count_if(winner.isNull()).alias("no_result"),
            F.count_if(winner.isNotNull() & ~won & ~lost).alias("unclear"),
        )
    )


def toss_impact(matches: DataFrame) -> DataFrame:
    """How often the side that won the toss won the match, per toss decision."""
    toss, winner = F.col("toss_winner"), F.col("match_winner")
    return (
        matches.where(toss.isNotNull() & winner.isNotNull())
        .groupBy("toss_decision")
        .agg(
            F.count("*").alias("total_matches"),
            F.sum(flag(toss == winner)).alias("toss_wins_match"),
        )
        .withColumn("win_pct_after_toss", rates.percentage("toss_wins_match", "total_matches"))
    )


def top_venues(matches: DataFrame, k: int = TOP) -> DataFrame:
    hosted = matches.groupBy("venue", "city").agg(F.count("*").alias("matches_hosted"))
    return top(
        hosted,
        k,
        F.desc("matches_hosted"),
        F.asc_nulls_first("venue"),
        F.asc_nulls_first("city"),
    )


def player_of_match(matches: DataFrame, k: int = TOP) -> DataFrame:
    awarded = matches.where(F.col("player_of_match").isNotNull())
    counted = awarded.groupBy("player_of_match").agg(F.count("*").alias("awards"))
    return top(counted, k, F.desc("awards"), "player_of_match")


def venue_scoring(fact: DataFrame, matches: DataFrame) -> DataFrame:
    """Matches with deliveries, runs and wickets per venue.

    Deliveries of unknown matches count under a null venue, so that the runs add up
    to those of all seasons. Deliveries are summed per match first: the join moves one row per match, and
    a match with very many deliveries is an ordinary row by then.
    """
    by_match = fact.groupBy("match_id").agg(
        F.sum("total_runs").alias("runs"),
        F.sum("is_wicket").alias("wickets"),
    )
    return (
        by_match.join(matches.select("match_id", "venue", "city"), "match_id", "left")
        .groupBy("venue", "city")
        .agg(
            F.count("*").alias("matches"),
            F.sum("runs").alias("total_runs"),
            F.sum("wickets").alias("wickets"),
        )
        .withColumn("avg_runs_per_match", rates.ratio("total_runs", "matches"))
    )


# ---- over the catalogue -----------------------------------------------------


@dataclass(frozen=True)
class Report:
    build: Callable[..., DataFrame]
    tables: tuple[str, ...]


REPORTS = {
    "top_run_scorers": Report(top_run_scorers, ("fact_deliveries",)),
    "top_wicket_takers": Report(top_wicket_takers, ("fact_deliveries",)),
    "season_totals": Report(season_totals, ("fact_deliveries",)),
    "team_wins": Report(team_wins, ("dim_matches",)),
    "toss_impact": Report(toss_impact, ("dim_matches",)),
    "top_venues": Report(top_venues, ("dim_matches",)),
    "best_strike_rates": Report(best_strike_rates, ("fact_deliveries",)),
    "most_sixes_in_season": Report(most_sixes_in_season, ("fact_deliveries",)),
    "powerplay_economy": Report(powerplay_economy, ("fact_deliveries",)),
    "player_of_match": Report(player_of_match, ("dim_matches",)),
    "milestones": Report(milestones, ("fact_deliveries",)),
    "win_loss": Report(win_loss, ("dim_matches",)),
    "season_top_batters": Report(season_top_batters, ("batting_stats",)),
    "season_top_bowlers": Report(season_top_bowlers, ("bowling_stats",)),
    "venue_scoring": Report(venue_scoring, ("fact_deliveries", "dim_matches")),
    "runs_per_dismissal": Report(runs_per_dismissal, ("fact_deliveries",)),
}


def report(spark: SparkSession, database: str, name: str, **options) -> DataFrame:
    """A report by name over the tables of a database."""
    chosen = REPORTS[name]
    tables = [read_table(spark, database, table) for table in chosen.tables]
    return chosen.build(*tables, **options)
