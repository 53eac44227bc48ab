from __future__ import annotations

import os
import re
from pathlib import Path

import pytest

from pavilion import checks, flow, schemas
from pavilion.plans.reports import REPORTS, report
from pavilion.sinks import runs, switch, tables
from pavilion.sinks.layout import BY_SEASON, STANDARD
from pavilion.sources import files

MATCHES = [
    {"id": str(i), "season": s, "date": f"2009-04-{i:02}", "winner": w, "venue": v}
    for i, s, w, v in [(1, "2009", "A", "Oval"), (2, "2009", "B", "Oval"), (3, "2010", None, "Lords")]
]
DELIVERIES = [
    {"match_id": str(m), "over": str(o), "ball": str(b), "batsman_runs": str(b), "total_runs": str(b)}
    for m in (1, 2, 3)
    for o in (1, 2)
    for b in range(1, 7)
]


@pytest.fixture
def places(tmp_path, source, request):
    name = re.sub(r"\W", "_", request.node.name)
    return flow.Places(
        source(MATCHES * 2, DELIVERIES + DELIVERIES[:3]),
        str(tmp_path / "raw"),
        str(tmp_path / "processed"),
        f"db_{name}",
    )


def _content(spark, database):
    return {
        t: sorted(map(repr, files.read_table(spark, database, t).collect())) for t in schemas.TABLES
    }


@pytest.mark.parametrize("copy", [False, True])
@pytest.mark.parametrize("layouts", [STANDARD, BY_SEASON])
def test_whole_flow_twice(spark, places, copy, layouts):
    counts = flow.run(spark, places, layouts, copy)
    assert counts == {
        "dim_matches": 3, "dim_teams": 2, "dim_players": 2, "dim_seasons": 2,
        "fact_deliveries": 36, "batting_stats": 2, "bowling_stats": 2,
    }
    for table in schemas.TABLES:
        df = files.read_table(spark, places.database, table)
        assert dict(df.dtypes) == schemas.TABLES[table]
    before = _content(spark, places.database)
    assert flow.run(spark, places, layouts, copy) == counts
    assert _content(spark, places.database) == before
    assert {n for n in REPORTS if report(spark, places.database, n).count() == 0} == {"best_strike_rates", "powerplay_economy"}


def test_stages_can_be_repeated_alone(spark, places):
    flow.land(spark, places)
    first = flow.transform(spark, places)
    assert flow.transform(spark, places) == first
    for _ in range(2):
        flow.load(spark, places)
    assert checks.validate(spark, places.database) == first


def test_a_failed_transform_leaves_the_tables(spark, places, monkeypatch, source):
    """Whichever table it fails at."""
    flow.run(spark, places, BY_SEASON)
    before = _content(spark, places.database)
    source(MATCHES[:1], DELIVERIES[:12], places.source)
    flow.land(spark, places)
    write = tables.write_parquet
    for table in schemas.TABLES:

        def failing(df, path, *rest, table=table):
            if path.endswith(f"/{table}"):
                raise OSError("disk full")
            return write(df, path, *rest)

        with monkeypatch.context() as patch, pytest.raises(OSError, match="disk full"):
            patch.setattr(tables, "write_parquet", failing)
            flow.transform(spark, places, BY_SEASON)
        assert _content(spark, places.database) == before
    flow.load(spark, places)
    assert _content(spark, places.database) == before
    flow.transform(spark, places, BY_SEASON)
    assert flow.load(spark, places)["fact_deliveries"] == 12


def test_load_follows_the_layout_of_the_run(spark, places):
    flow.land(spark, places)
    written = flow.transform(spark, places, BY_SEASON)
    with pytest.raises(ValueError, match="another layout"):
        flow.load(spark, places, STANDARD)
    assert flow.load(spark, places) == written
    assert flow.load(spark, places, STANDARD, copy=True) == written


def test_refused_rows_are_counted_and_kept(spark, places, source):
    source(MATCHES + [{"id": "7.9"}], DELIVERIES + [{"match_id": "1.0", "over": "9"}, {"match_id": "A12"}, {"bowler": None}], places.source)
    counts = flow.land(spark, places)
    assert (counts["matches"]["id"], counts["deliveries"]["match_id"]) == (1, 1)
    written = flow.transform(spark, places)
    assert written.refused == {"matches": 1, "deliveries": 2} and written["fact_deliveries"] == 37
    kept = spark.read.parquet(f"{runs.latest(spark, places.processed).path}/rejected/deliveries").collect()
    assert {(r.match_id, r._reason) for r in kept} == {("A12", "match_id is no whole number"), ("1", "bowler is missing")}


def test_load_needs_a_finished_run(spark, places):
    with pytest.raises(FileNotFoundError, match="no finished run"):
        flow.load(spark, places)


def test_older_runs_are_removed(spark, places):
    flow.land(spark, places)
    for _ in range(4):
        flow.transform(spark, places)
    flow.load(spark, places)
    assert len(os.listdir(places.processed)) == 2


def test_load_refuses_missing_rows(spark, places):
    flow.land(spark, places)
    flow.transform(spark, places)
    path = runs.latest(spark, places.processed).path
    teams = spark.read.parquet(f"{path}/dim_teams").limit(1).collect()
    spark.createDataFrame(teams).write.mode("overwrite").parquet(f"{path}/dim_teams")
    with pytest.raises(checks.WrongCount, match="dim_teams has 1 of 2 rows"):
        flow.load(spark, places)


def test_a_switch_that_fails_is_taken_back(spark, places, monkeypatch, source):
    """Whichever renaming it fails at; all seven tables are of the run before."""
    flow.run(spark, places, BY_SEASON)
    before = _content(spark, places.database)
    source(MATCHES[:1], DELIVERIES[:12], places.source)
    flow.land(spark, places)
    flow.transform(spark, places, BY_SEASON)
    rename = switch._rename
    for step in range(2 * len(schemas.TABLES)):
        calls = iter(range(100))

        def failing(*arguments, step=step, calls=calls):
            if next(calls) == step:
                raise OSError("no catalogue")
            rename(*arguments)

        with monkeypatch.context() as patch, pytest.raises(OSError, match="no catalogue"):
            patch.setattr(switch, "_rename", failing)
            flow.load(spark, places)
        assert _content(spark, places.database) == before
        names = {t.name for t in spark.catalog.listTables(places.database)}
        assert names == set(schemas.TABLES) and not switch.note(spark, places.database, switch.GOING)
    assert flow.load(spark, places)["fact_deliveries"] == 12


def test_a_switch_that_broke_off_is_finished_by_the_next_load(spark, places, monkeypatch, source):
    """The session ends half-way, so that nothing is taken back."""
    flow.run(spark, places, BY_SEASON)
    source(MATCHES[:1], DELIVERIES[:12], places.source)
    flow.land(spark, places)
    flow.transform(spark, places, BY_SEASON)
    rename, steps = switch._rename, [0, 1, 4, 7, 13]
    for step in steps:
        calls = iter(range(100))

        def ending(*arguments, step=step, calls=calls):
            if next(calls) >= step:
                raise KeyboardInterrupt
            rename(*arguments)

        with monkeypatch.context() as patch, pytest.raises(KeyboardInterrupt):
            patch.setattr(switch, "_rename", ending)
            flow.load(spark, places)
        going = switch.note(spark, places.database, switch.GOING)
        assert going == runs.latest(spark, places.processed).path
        # Another run is newest by now; the one that was under way is put in place whole.
        assert switch.complete(spark, places.database, list(schemas.TABLES)) == going
        assert checks.row_counts(spark, places.database)["fact_deliveries"] == 12
        assert {t.name for t in spark.catalog.listTables(places.database)} == set(schemas.TABLES)
        assert switch.note(spark, places.database, switch.CURRENT) == going
    with monkeypatch.context() as patch, pytest.raises(KeyboardInterrupt):
        patch.setattr(switch, "_rename", ending)
        flow.load(spark, places)
    assert flow.load(spark, places)["fact_deliveries"] == 12


def test_a_first_load_that_fails_leaves_no_table(spark, places, monkeypatch):
    flow.land(spark, places)
    flow.transform(spark, places)
    rename, calls = switch._rename, iter(range(100))

    def failing(*arguments):
        if next(calls) == 3:
            raise OSError("no catalogue")
        rename(*arguments)

    with monkeypatch.context() as patch, pytest.raises(OSError, match="no catalogue"):
        patch.setattr(switch, "_rename", failing)
        flow.load(spark, places)
    assert spark.catalog.listTables(places.database) == []


def test_a_table_is_replaced_by_rows_read_from_it(spark, places):
    flow.run(spark, places)
    tables.load_table(files.read_table(spark, places.database, "dim_teams").where("team_name = 'A'"), places.database, "dim_teams")
    for _ in range(2):
        teams = files.read_table(spark, places.database, "dim_teams")
        assert [r.team_name for r in teams.collect()] == ["A"]
        assert tables.load_table(teams, places.database, "dim_teams") == 1
    home = spark.catalog.getDatabase(places.database).locationUri.removeprefix("file:")
    assert len([f for f in os.listdir(home) if f.startswith("dim_teams-")]) == 1


def test_paths_with_marks(spark, tmp_path, source):
    at = flow.Places(source(MATCHES, DELIVERIES), str(tmp_path / "it's raw"), str(tmp_path / "it's, (out)"), "odd_paths")
    assert flow.run(spark, at)["fact_deliveries"] == 36
    assert switch.note(spark, "odd_paths", switch.CURRENT) == runs.latest(spark, at.processed).path


def test_later_files_replace_earlier_rows(spark, places, source):
    flow.run(spark, places)
    source(MATCHES[:1], DELIVERIES[:12], places.source)
    counts = flow.run(spark, places)
    assert (counts["dim_matches"], counts["fact_deliveries"]) == (1, 12)


@pytest.mark.parametrize("missing", [schemas.MATCHES_FILE, schemas.DELIVERIES_FILE])
def test_missing_file(spark, places, missing):
    Path(places.source, missing).unlink()
    with pytest.raises(FileNotFoundError, match=missing):
        flow.run(spark, places)
    assert not os.path.exists(places.raw)


def test_missing_column(spark, places):
    path = Path(places.source, schemas.MATCHES_FILE)
    path.write_text(path.read_text().replace("toss_winner", "toss", 1))
    with pytest.raises(ValueError, match="lacks the columns toss_winner"):
        flow.land(spark, places)


def test_columns_are_found_by_name(spark, tmp_path, rows):
    (tmp_path / "m.csv").write_text("winner,extra,id\nA,x,1\n")
    raw = files.read_csv(spark, str(tmp_path / "m.csv"), {"id": "bigint", "winner": "string"})
    assert rows(raw, "id", "winner", "extra") == [("1", "A", "x")]


def test_header_case_does_not_matter(spark, tmp_path):
    (tmp_path / "m.csv").write_text("Winner,ID,Extra\nA,1,x\n")
    raw = files.read_csv(spark, str(tmp_path / "m.csv"), {"id": "bigint", "winner": "string"})
    assert raw.columns == ["winner", "id", "Extra"]


def test_quotes_and_line_breaks_inside_quotes(spark, tmp_path, rows):
    kinds = {"id": "bigint", "winner": "string"}
    (tmp_path / "q.csv").write_text('id,winner\n1,"The ""A"" side, north"\n')
    assert rows(files.read_csv(spark, str(tmp_path / "q.csv"), kinds)) == [("1", 'The "A" side, north')]
    (tmp_path / "b.csv").write_text('id,winner\n1,"A\nB"\n2,C\n')
    raw = files.read_csv(spark, str(tmp_path / "b.csv"), kinds, multi_line=True)
    assert rows(raw) == [("1", "A\nB"), ("2", "C")]


def test_quoted_commas_survive(spark, places, source):
    path = Path(places.source, schemas.MATCHES_FILE)
    path.write_text(path.read_text().replace("Oval", '"The Oval, north end"'))
    flow.run(spark, places)
    venues = {r["venue"] for r in files.read_table(spark, places.database, "dim_matches").collect()}
    assert venues == {'The Oval, north end', "Lords"}


def test_sql_over_the_tables(spark, places):
    """The reports as SQL text, run by Spark on the loaded tables."""
    from pavilion.testbed import oracle

    flow.run(spark, places)
    options = {
        "best_strike_rates": {"min_balls": 590},
        "powerplay_economy": {"overs": (1, 2), "min_balls": 165},
        "milestones": {"half_century": 6, "century": 12},
    }
    spark.sql(f"USE {places.database}")
    spark.conf.set("spark.sql.ansi.doubleQuotedIdentifiers", "true")
    try:
        for name, sql in oracle.REPORTS.items():
            by_sql = spark.sql(sql)
            by_frame = report(spark, places.database, name, **options.get(name, {}))
            assert by_sql.columns == by_frame.columns
            assert sorted(map(repr, by_sql.collect())) == sorted(map(repr, by_frame.collect())), name
    finally:
        spark.conf.unset("spark.sql.ansi.doubleQuotedIdentifiers")
        spark.sql("USE default")


def test_files_with_other_headers_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,winner\n1,A\n")
    (tmp_path / "b.csv").write_text("winner,id\nA,1\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_csv(spark, str(tmp_path), {"id": "bigint"}).collect()


@pytest.mark.parametrize("word", ["NA", "", '""'])
def test_null_words_make_no_wicket(spark, places, source, word):
    source(MATCHES[:1], [DELIVERIES[0] | {"player_dismissed": word}], places.source)
    flow.run(spark, places)
    assert files.read_table(spark, places.database, "fact_deliveries").first()["is_wicket"] == 0


def test_without_null_words_text_is_taken_literally(spark, places, source):
    source(MATCHES[:1], [DELIVERIES[0] | {"player_dismissed": "NA"}], places.source)
    flow.land(spark, places, null_words=())
    flow.transform(spark, places)
    assert files.read_parquet(spark, runs.latest(spark, places.processed).path, "fact_deliveries").first()["is_wicket"] == 1


def test_rejects_are_reported(spark, places, source):
    source(MATCHES[:1], [DELIVERIES[0] | {"batsman_runs": "x", "over": "?"}, DELIVERIES[1]], places.source)
    landed = flow.land(spark, places)
    assert landed["matches"] == {"rows": 1, "id": 0, "win_by_runs": 0, "win_by_wickets": 0}
    assert {k: v for k, v in landed["deliveries"].items() if v} == {"rows": 2, "batsman_runs": 1, "over": 1}
    assert flow.transform(spark, places)["fact_deliveries"] == 2


def test_empty_table_fails_validation(spark, places):
    flow.run(spark, places)
    for table in schemas.TABLES:
        spark.sql(f"DROP TABLE {places.database}.{table}")
        tables.create_table(spark, places.database, table)
        with pytest.raises(checks.EmptyTable, match=f"no rows in {table}$"):
            checks.validate(spark, places.database)
        path = f"{runs.latest(spark, places.processed).path}/{table}"
        tables.attach_table(spark, places.database, table, path)


def test_empty_input_fails_validation(spark, places, source):
    source([], [], places.source)
    with pytest.raises(checks.EmptyTable, match="dim_matches.*bowling_stats"):
        flow.run(spark, places)


def test_create_table_leaves_an_existing_one(spark, places):
    flow.run(spark, places)
    tables.create_table(spark, places.database, "dim_teams")
    assert files.read_table(spark, places.database, "dim_teams").count() == 2


def test_tables_created_from_sql(spark, places, raw_matches, raw_deliveries):
    from pavilion.plans import sql_tables

    tables.create_database(spark, places.database)
    sql_tables.create_matches(places.database, raw_matches({}, {"id": "2", "date": "2009-05-01"}))
    sql_tables.create_matches(places.database, raw_matches({}))
    assert files.read_table(spark, places.database, "dim_matches").count() == 2
    sql_tables.create_deliveries(places.database, raw_deliveries({"season": "2009"}))
    assert files.read_table(spark, places.database, "fact_deliveries").first()["season"] == "2009"


def test_tables_created_from_the_raw_zone(spark, places):
    """The SQL tables of landed files equal those of the flow; a second creation changes nothing."""
    flow.run(spark, places)
    expected = {t: _content(spark, places.database)[t] for t in ("dim_matches", "fact_deliveries")}
    for table in expected:
        tables.drop_table(spark, places.database, table)
    for _ in range(2):
        flow.create(spark, places)
        assert {t: sorted(map(repr, files.read_table(spark, places.database, t).collect())) for t in expected} == expected


def test_command_line(places, tmp_path):
    import subprocess
    import sys

    root = Path(__file__).resolve().parent.parent
    options = ["--source", places.source, "--raw", places.raw, "--processed", places.processed, "--database", "cli"]

    def call(*stage):
        return subprocess.run(
            [sys.executable, "-m", "pavilion", *stage, *options],
            capture_output=True, text=True, cwd=tmp_path, timeout=300,
            env=os.environ | {"PYTHONPATH": str(root)},
        )

    ran = call("run")
    assert ran.returncode == 0, ran.stderr
    assert "'fact_deliveries': 36" in ran.stdout
    shown = call("report", "team_wins")
    assert shown.returncode == 0, shown.stderr
    assert "|A   |1   |" in shown.stdout
    assert call("report").returncode == 2
    assert call("report", "team_wins", "--option", "l=1").returncode == 2
    one = call("report", "top_run_scorers", "--option", "k=0")
    assert one.returncode == 0 and "Ann" not in one.stdout and "batsman" in one.stdout
    assert call("run", "--by-season").returncode == 0
    assert "|A   |1   |" in call("report", "team_wins").stdout


def test_season_folders_keep_odd_seasons(spark, places, source):
    """A label with a slash, one that looks like a number, and no season at all."""
    seasons = ["2007/08", "2009", "0010"]
    matches = [MATCHES[0] | {"id": str(i), "season": s} for i, s in enumerate(seasons)]
    balls = [DELIVERIES[0] | {"match_id": str(i)} for i in range(4)]
    source(matches, balls, places.source)
    flow.run(spark, places, BY_SEASON)
    fact = files.read_table(spark, places.database, "fact_deliveries").collect()
    assert {r["match_id"]: r["season"] for r in fact} == {0: "2007/08", 1: "2009", 2: "0010", 3: None}
    dim = files.read_table(spark, places.database, "dim_seasons").orderBy("season_id").collect()
    assert [r["season_year"] for r in dim] == ["0010", "2007/08", "2009"]
    totals = report(spark, places.database, "season_totals").collect()
    assert [r["season"] for r in totals] == [None, "0010", "2007/08", "2009"]
