from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pavilion.operators import cleansing
from pavilion.operators.keys import with_dense_key
from pavilion.plans import dimensions


@pytest.fixture
def width(spark):
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)

    def use(partitions: int, adaptive: bool = True):
        spark.conf.set(name, partitions)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)

    yield use
    use(before)


@pytest.mark.parametrize("adaptive", [True, False])
@pytest.mark.parametrize("partitions", [1, 4, 16])
def test_keys_do_not_depend_on_partitions(spark, width, partitions, adaptive):
    width(partitions, adaptive)
    names = [f"n{i:04}" for i in range(500)]
    df = spark.createDataFrame([(n,) for n in reversed(names)], "name string").repartition(7)
    keyed = with_dense_key(df, "name", "id").collect()
    assert sorted((r["id"], r["name"]) for r in keyed) == list(enumerate(names, 1))


@settings(max_examples=10, deadline=None)
@given(names=st.sets(st.text(max_size=5), max_size=30))
def test_keys_follow_the_order_of_the_names(spark, names):
    df = spark.createDataFrame([(n,) for n in names], "name string")
    keyed = {r["name"]: r["id"] for r in with_dense_key(df, "name", "id").collect()}
    assert keyed == {n: i for i, n in enumerate(sorted(names, key=lambda n: n.encode()), 1)}


def test_null_team_gets_no_row(spark, raw_matches, rows):
    raw = raw_matches({"team2": None}, {"id": "2", "team1": "C", "team2": "A"})
    assert sorted(rows(dimensions.teams(cleansing.typed_matches(raw)))) == [(1, "A"), (2, "C")]


def test_players_and_more_columns(spark, raw_deliveries, rows):
    typed = cleansing.typed_deliveries(raw_deliveries({}, {"batsman": "Bob", "bowler": "Cat"}))
    assert [n for _, n in sorted(rows(dimensions.players(typed)))] == ["Ann", "Bob", "Cat"]
    wider = dimensions.players(typed, ("batsman", "bowler", "non_striker", "player_dismissed"))
    assert [n for _, n in sorted(rows(wider))] == ["Abe", "Ann", "Bob", "Cat"]


def test_players_of_the_statistics_are_those_of_the_deliveries(fact, rows):
    from pavilion.plans import stats

    built = fact({}, {"batsman": "Bob", "bowler": "Cat"}, {"match_id": "9", "batsman": "Dan"})
    players = dimensions.players_of(stats.batting(built), stats.bowling(built))
    assert sorted(rows(players)) == sorted(rows(dimensions.players(built)))


def test_seasons_sort_as_text(spark, raw_matches, rows):
    raw = raw_matches(*[{"season": s} for s in ("2020/21", "2009", "2007/08", "2009", None)])
    seasons = dimensions.seasons(cleansing.typed_matches(raw))
    assert sorted(rows(seasons)) == [(1, "2007/08"), (2, "2009"), (3, "2020/21")]
