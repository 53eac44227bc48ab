from __future__ import annotations

import datetime
from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pavilion.functions import rates
from pavilion.operators import cleansing
from pavilion.plans import dimensions, reports, stats


@pytest.fixture
def dim(raw_matches):
    return lambda *rows: dimensions.matches(
        cleansing.typed_matches(raw_matches(*[{"id": str(i)} | r for i, r in enumerate(rows)]))
    )


def test_rounding_tie(spark):
    df = spark.createDataFrame([(1, 800)], "runs long, balls long")
    assert df.select(rates.strike_rate("runs", "balls")).first()[0] == 0.13


@settings(max_examples=20, deadline=None)
@given(pairs=st.lists(st.tuples(st.integers(0, 5000), st.integers(0, 700)), min_size=1, max_size=50))
def test_rates_round_half_up(spark, pairs):
    df = spark.createDataFrame(pairs, "a long, b long")
    found = df.select(
        "a", "b", rates.strike_rate("a", "b"), rates.economy("a", "b"), rates.ratio("a", "b"), rates.overs("b")
    ).collect()

    def exact(top: int, bottom: int, step: str = "0.01"):
        return float((Decimal(top) / Decimal(bottom)).quantize(Decimal(step), ROUND_HALF_UP)) if bottom else None

    for a, b, strike, economy, plain, overs in found:
        assert strike == exact(a * 100, b)
        assert economy == exact(a * 6, b)
        assert plain == exact(a, b)
        assert overs == exact(b, 6, "0.1")


def test_tie_at_the_cut(fact, rows):
    built = fact(*[{"batsman": f"P{i:02}", "batsman_runs": "1"} for i in range(11)])
    leaders = rows(reports.top_run_scorers(built), "batsman")
    assert leaders == [(f"P{i:02}",) for i in range(10)]


def test_thresholds(fact, rows):
    built = fact(*[{"ball": str(i % 6 + 1), "over": str(i // 6 + 1), "total_runs": "1"} for i in range(12)])
    assert reports.best_strike_rates(built).count() == 0
    assert rows(reports.best_strike_rates(built, min_balls=12)) == [("Ann", 0, 12, 0.0)]
    assert reports.best_strike_rates(built, min_balls=13).count() == 0
    assert rows(reports.powerplay_economy(built, (1, 1), min_balls=6)) == [("Bob", 1, 6.0)]
    assert reports.powerplay_economy(built, (1, 1), min_balls=7).count() == 0


def test_team_wins_and_drawn_matches(dim, rows):
    built = dim({"winner": "A"}, {"winner": "B"}, {"winner": "B"}, {"winner": None})
    assert rows(reports.team_wins(built)) == [("B", 2), ("A", 1)]
    assert sorted(rows(reports.win_loss(built))) == [("A", 4, 1, 2, 1, 0), ("B", 4, 2, 1, 1, 0)]


def test_a_winner_that_did_not_play_is_nobodys_loss(dim, rows):
    assert sorted(rows(reports.win_loss(dim({"winner": "C"})))) == [("A", 1, 0, 0, 0, 1), ("B", 1, 0, 0, 0, 1)]


def test_toss_impact(dim, rows):
    built = dim(
        {}, {"winner": "B"}, {"winner": "B"}, {"toss_decision": "field"}, {"winner": None}, {"toss_winner": None}
    )
    assert sorted(rows(reports.toss_impact(built))) == [("bat", 3, 1, 33.33), ("field", 1, 1, 100.0)]


def test_top_venues_keep_unknown_places(dim, rows):
    built = dim({}, {}, {"venue": None, "city": None}, {"city": None})
    assert rows(reports.top_venues(built)) == [("Headingley", "Leeds", 2), (None, None, 1), ("Headingley", None, 1)]


def test_player_of_match(dim, rows):
    built = dim({}, {"player_of_match": None}, {"player_of_match": "Abe"}, {"player_of_match": "Abe"})
    assert rows(reports.player_of_match(built)) == [("Abe", 2), ("Ann", 1)]
    assert rows(reports.player_of_match(built, k=1)) == [("Abe", 2)]


def test_season_order_is_text_with_null_first(fact, rows):
    built = fact(
        *[{"match_id": str(i), "total_runs": "2"} for i in range(4)],
        matches=[{"id": str(i), "season": s} for i, s in enumerate(["2020/21", "2009", "2007/08"])],
    )
    found = rows(reports.season_totals(built))
    assert [r[0] for r in found] == [None, "2007/08", "2009", "2020/21"]
    assert found[1] == ("2007/08", 2, 1, 2.0)


def test_milestones(fact, rows):
    def innings(match: str, sixes: int):
        return [
            {"match_id": match, "over": str(i // 6), "ball": str(i % 6), "batsman_runs": "6"} for i in range(sixes)
        ]

    built = fact(*innings("1", 17), *innings("2", 16), *innings("3", 9), *innings("4", 8))
    assert rows(reports.milestones(built)) == [("Ann", 1, 2)]


def test_runs_per_dismissal(fact, rows):
    built = fact(
        {"batsman_runs": "6"},
        {"ball": "2", "batsman_runs": "1", "player_dismissed": "Ann"},
        {"ball": "3", "batsman": "Abe", "batsman_runs": "2"},
        {"ball": "4", "batsman": "Abe", "player_dismissed": "Never Faced"},
        {"ball": "5", "batsman": "Nil", "batsman_runs": None},
    )
    assert sorted(rows(reports.runs_per_dismissal(built))) == [
        ("Abe", 2, 0, None), ("Ann", 7, 1, 7.0), ("Nil", None, 0, None),
    ]


def test_season_leaders(fact, rows):
    built = fact(
        *[{"batsman": p, "batsman_runs": r} for p, r in (("C", "4"), ("B", "6"), ("A", "4"))],
        {"match_id": "2", "batsman": "C", "batsman_runs": "1", "player_dismissed": "C"},
        matches=({}, {"id": "2", "season": "2010"}),
    )
    found = rows(reports.season_top_batters(stats.batting(built), k=2))
    assert sorted(found) == [("2009", 1, "B", 6), ("2009", 2, "A", 4), ("2010", 1, "C", 1)]
    assert sorted(rows(reports.season_top_bowlers(stats.bowling(built), k=1))) == [
        ("2009", 1, "Bob", 0), ("2010", 1, "Bob", 1),
    ]


def test_venue_scoring(fact, raw_matches, rows):
    matches = ({}, {"id": "2", "venue": None}, {"id": "3"})
    built = fact(
        {"total_runs": "3", "player_dismissed": "Ann"},
        {"match_id": "2", "total_runs": "1"},
        {"match_id": "9", "total_runs": "5"},
        matches=matches,
    )
    dim = dimensions.matches(cleansing.typed_matches(raw_matches(*matches)))
    assert sorted(rows(reports.venue_scoring(built, dim)), key=repr) == [
        ("Headingley", "Leeds", 1, 3, 1, 3.0), (None, "Leeds", 1, 1, 0, 1.0), (None, None, 1, 5, 0, 5.0),
    ]


def test_every_report_names_known_tables():
    from pavilion import schemas

    for report in reports.REPORTS.values():
        assert set(report.tables) <= set(schemas.TABLES)


def test_dates_are_dates(dim):
    assert dim({}).first()["match_date"] == datetime.date(2009, 4, 18)
    assert dim({}).agg(F.max("match_date")).first()[0] == datetime.date(2009, 4, 18)
