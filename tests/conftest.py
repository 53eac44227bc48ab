from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from pavilion import schemas  # noqa: E402
from pavilion.session import open_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = open_session(
        "tests",
        "local[4]",
        spark__driver__memory="4g",
        spark__sql__shuffle__partitions=4,
        spark__checkpoint__dir=str(folder / "checkpoints"),
        spark__sql__warehouse__dir=str(folder / "warehouse"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


MATCH = {
    "id": "1", "season": "2009", "city": "Leeds", "venue": "Headingley", "date": "2009-04-18",
    "team1": "A", "team2": "B", "toss_winner": "A", "toss_decision": "bat", "winner": "A",
    "win_by_runs": "12", "win_by_wickets": "0", "player_of_match": "Ann",
}

DELIVERY = {
    "match_id": "1", "inning": "1", "batting_team": "A", "bowling_team": "B", "over": "1",
    "ball": "1", "batsman": "Ann", "non_striker": "Abe", "bowler": "Bob", "batsman_runs": "0",
    "extra_runs": "0", "total_runs": "0", "player_dismissed": None, "dismissal_kind": None,
}


def _frame(spark, base: dict, rows: list[dict]):
    names = list(base) + [c for row in rows for c in row if c not in base]
    names = list(dict.fromkeys(names))
    schema = ", ".join(f"`{name}` string" for name in names)
    return spark.createDataFrame([tuple((base | row).get(c) for c in names) for row in rows], schema)


@pytest.fixture(scope="session")
def raw_matches(spark):
    """Raw match rows: the standard one, changed by each given dict."""
    return lambda *rows: _frame(spark, MATCH, list(rows))


@pytest.fixture(scope="session")
def raw_deliveries(spark):
    """Raw delivery rows: the standard one, changed by each given dict."""
    return lambda *rows: _frame(spark, DELIVERY, list(rows))


@pytest.fixture(scope="session")
def fact(spark, raw_matches, raw_deliveries):
    """A fact of the given delivery rows, all in the given matches."""
    from pavilion.operators import cleansing
    from pavilion.plans import dimensions, facts

    def build(*rows, matches=({},)):
        dim = dimensions.matches(cleansing.typed_matches(raw_matches(*matches)))
        return facts.deliveries(cleansing.clean_deliveries(raw_deliveries(*rows)), dim)

    return build


@pytest.fixture
def rows():
    """Collect a frame as plain tuples."""
    return lambda df, *columns: [tuple(r) for r in (df.select(*columns) if columns else df).collect()]


@pytest.fixture
def source(tmp_path):
    """Write the raw CSV files, from lists of dicts, into a folder."""

    def write(matches: list[dict], deliveries: list[dict], folder=None) -> str:
        target = Path(folder or tmp_path / "source")
        target.mkdir(parents=True, exist_ok=True)
        for name, base, given in (
            (schemas.MATCHES_FILE, MATCH, matches),
            (schemas.DELIVERIES_FILE, DELIVERY, deliveries),
        ):
            lines = [",".join(base)]
            lines += [",".join("" if v is None else v for v in (base | row).values()) for row in given]
            (target / name).write_text("\n".join(lines) + "\n")
        return str(target)

    return write
