from __future__ import annotations

import pytest

from pavilion import schemas
from pavilion.operators import cleansing
from pavilion.operators.lookup import lookup
from pavilion.plans import stats

FLAGS = ("is_boundary", "is_four", "is_six", "is_dot_ball", "is_wicket")


@pytest.mark.parametrize(
    ("change", "flags"),
    [
        ({"batsman_runs": "4", "total_runs": "4"}, (1, 1, 0, 0, 0)),
        ({"batsman_runs": "6", "total_runs": "7"}, (1, 0, 1, 0, 0)),
        ({"batsman_runs": "0", "total_runs": "0"}, (0, 0, 0, 1, 0)),
        ({"batsman_runs": "0", "total_runs": "1"}, (0, 0, 0, 0, 0)),
        ({"player_dismissed": "Ann"}, (0, 0, 0, 1, 1)),
        ({"batsman_runs": None, "total_runs": None}, (0, 0, 0, 0, 0)),
        ({"batsman_runs": "x", "total_runs": "x"}, (0, 0, 0, 0, 0)),
    ],
)
def test_flags(fact, rows, change, flags):
    assert rows(fact(change), *FLAGS) == [flags]


def test_declared_types(spark, fact):
    frames = {"fact_deliveries": fact({}), "batting_stats": stats.batting(fact({})), "bowling_stats": stats.bowling(fact({}))}
    for name, df in frames.items():
        assert dict(df.dtypes) == schemas.TABLES[name]
        assert df.columns == schemas.columns(name)


def test_conflicting_matches_do_not_double_deliveries(fact, rows):
    built = fact({}, {"ball": "2"}, matches=({"city": "York"}, {"city": "Leeds", "season": "2008"}))
    assert sorted(rows(built, "ball", "season")) == [(1, "2008"), (2, "2008")]


def test_delivery_without_match_is_kept(fact, rows):
    assert rows(fact({"match_id": "9"}), "match_id", "season") == [(9, None)]


def test_season_of_the_match_wins(fact, rows):
    assert rows(fact({"season": "1999"}), "season") == [("2009",)]


@pytest.mark.parametrize("salts", [0, 1, 3, 8])
def test_salts_do_not_change_a_lookup(spark, rows, salts):
    left = spark.createDataFrame([(i % 3, i) for i in range(60)] + [(9, 0)], "k int, v int")
    table = spark.createDataFrame([(0, "a"), (1, "b"), (2, None)], "k int, name string")
    expected = sorted(rows(left.join(table, "k", "left")), key=repr)
    found = lookup(left, table, "k", salts)
    assert found.columns == ["k", "v", "name"]
    assert sorted(rows(found), key=repr) == expected


def test_batting(fact):
    built = fact(
        {"batsman_runs": "4", "total_runs": "4"},
        {"batsman_runs": "6", "total_runs": "6", "ball": "2"},
        {"batsman_runs": "1", "total_runs": "1", "match_id": "2"},
        matches=({}, {"id": "2"}),
    )
    assert stats.batting(built).first().asDict() == {
        "batsman": "Ann", "season": "2009", "total_runs": 11, "balls_faced": 3, "boundaries": 2,
        "fours": 1, "sixes": 1, "matches_played": 2, "strike_rate": 366.67, "batting_average": 5.5,
    }


def test_bowling(fact):
    built = fact({}, {"ball": "2", "total_runs": "5"}, {"ball": "3", "player_dismissed": "Ann"})
    assert stats.bowling(built).first().asDict() == {
        "bowler": "Bob", "season": "2009", "wickets": 1, "runs_conceded": 5, "balls_bowled": 3,
        "dot_balls": 2, "matches_played": 1, "overs_bowled": 0.5, "economy_rate": 10.0,
        "bowling_average": 5.0, "dot_ball_pct": 66.67,
    }


def test_no_wicket_no_average(fact):
    assert stats.bowling(fact({})).first()["bowling_average"] is None


def test_no_balls_give_null_rates(fact):
    built = fact({"ball": None})
    assert stats.batting(built).first()["strike_rate"] is None
    bowled = stats.bowling(built).first()
    assert (bowled["economy_rate"], bowled["dot_ball_pct"], bowled["overs_bowled"]) == (None, None, 0.0)


def test_sql_tables_agree(spark, raw_matches, raw_deliveries, fact, rows):
    from pavilion.plans import dimensions, sql_tables

    matches = raw_matches({}, {"id": "2", "winner": None, "date": "bad"})
    balls = raw_deliveries(
        {"season": "2009", "batsman_runs": "4"}, {"season": "2009", "player_dismissed": "Ann"}
    )
    dim = dimensions.matches(cleansing.typed_matches(matches))
    assert dict(sql_tables.matches(matches).dtypes) == schemas.TABLES["dim_matches"]
    assert sorted(rows(sql_tables.matches(matches)), key=repr) == sorted(rows(dim), key=repr)
    by_frame = fact({"batsman_runs": "4"}, {"player_dismissed": "Ann"})
    by_sql = sql_tables.deliveries(balls)
    assert dict(by_sql.dtypes) == schemas.TABLES["fact_deliveries"]
    assert sorted(rows(by_sql), key=repr) == sorted(rows(by_frame), key=repr)
