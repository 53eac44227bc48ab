"""Every query against the second engine, at the smallest scale."""

from __future__ import annotations

import pytest
from compare import differences, oracle_connection

import __spark_entry__ as contract

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = dict(contract.QUERIES), contract.oracle.statements()


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(FOLDER)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, oracle, name):
    assert differences(QUERIES[name](spark, FOLDER), oracle, SQL[name]) == []


def test_entry(spark):
    assert contract.entry(spark).columns == [
        "batsman", "total_runs", "matches", "strike_rate", "sixes", "fours",
    ]


def test_season_sum_agrees_everywhere(spark):
    """Total runs are the same in the fact, both statistics and the season report."""
    from pavilion.testbed.queries import Tables

    from pavilion.plans import reports, stats

    t = Tables(spark, FOLDER)
    total = t.fact.agg({"total_runs": "sum"}).first()[0]
    by_season = reports.season_totals(t.fact)
    assert by_season.agg({"total_runs": "sum"}).first()[0] == total
    assert stats.bowling(t.fact).agg({"runs_conceded": "sum"}).first()[0] == total
    batted = t.fact.agg({"batsman_runs": "sum"}).first()[0]
    assert stats.batting(t.fact).agg({"total_runs": "sum"}).first()[0] == batted
    assert t.fact.count() == t.clean_deliveries.count()


@pytest.mark.parametrize(
    "build", ["batting", "bowling", "season_totals", "most_sixes_in_season"]
)
def test_summing_before_the_join_changes_nothing(spark, rows, build):
    from pavilion.testbed.queries import Tables

    from pavilion.plans import reports, stats

    t = Tables(spark, FOLDER)
    plan = getattr(stats, build, None) or getattr(reports, build)
    assert sorted(rows(plan(t.fact)), key=repr) == sorted(rows(plan(t.balls, t.seasons)), key=repr)
