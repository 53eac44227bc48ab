"""Every operator and report as a query over the test tables."""

from __future__ import annotations

import zlib
from collections.abc import Callable
from dataclasses import replace
from functools import cached_property

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pavilion import checks, flow, schemas
from pavilion.operators import cleansing
from pavilion.operators.lookup import lookup
from pavilion.plans import dimensions, facts, reports, sql_tables, stats
from pavilion.session import scratch
from pavilion.sinks import runs, tables
from pavilion.sinks.layout import BY_CURVE, BY_SEASON
from pavilion.sources import files
from pavilion.testbed import mapping


class Tables:
    """Lazy plans of the tables over one folder of test tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    @cached_property
    def raw_matches(self) -> DataFrame:
        return mapping.raw_matches(self.spark, self.folder)

    @cached_property
    def raw_deliveries(self) -> DataFrame:
        return mapping.raw_deliveries(self.spark, self.folder)

    @cached_property
    def typed_matches(self) -> DataFrame:
        return cleansing.typed_matches(self.raw_matches)

    @cached_property
    def typed_deliveries(self) -> DataFrame:
        return cleansing.typed_deliveries(self.raw_deliveries)

    @cached_property
    def clean_deliveries(self) -> DataFrame:
        return cleansing.clean_deliveries(self.raw_deliveries)

    @cached_property
    def matches(self) -> DataFrame:
        return dimensions.matches(self.typed_matches)

    @cached_property
    def seasons(self) -> DataFrame:
        return dimensions.match_seasons(self.typed_matches)

    @cached_property
    def balls(self) -> DataFrame:
        """The fact without its season, for whatever can do without the join or
        can join after summing."""
        return facts.flagged(facts.unseasoned(self.clean_deliveries))

    @cached_property
    def fact(self) -> DataFrame:
        return facts.deliveries(self.clean_deliveries, self.seasons, self.typed_deliveries)

    @cached_property
    def matches_as_text(self) -> DataFrame:
        """Raw match text without repeats, as the SQL tables are created from."""
        return cleansing.with_values(self.raw_matches, schemas.MATCH_KEYS).distinct()

    @cached_property
    def deliveries_as_text(self) -> DataFrame:
        """Raw delivery text without repeats, with the season of the match."""
        seasons = self.matches_as_text.selectExpr("id AS match_id", "season")
        balls = cleansing.with_values(self.raw_deliveries, schemas.DELIVERY_KEYS)
        # Hot matches are looked for before repeats are dropped, which would be done twice.
        return lookup(balls.distinct(), cleansing.smallest_per_key(seasons, "match_id"), "match_id", like=balls)


# Cut-offs that split the groups of the test tables; the standard ones suit real
# innings, these suit seven balls per match.
MIN_BALLS_FACED = 590
MIN_BALLS_BOWLED = 165
POWERPLAY = (1, 2)
HALF_CENTURY, CENTURY = 6, 12

_PLANS: dict[str, Callable[[Tables], DataFrame]] = {
    "raw_matches": lambda t: t.raw_matches,
    "raw_deliveries": lambda t: t.raw_deliveries,
    "clean_matches": lambda t: cleansing.clean_matches(t.raw_matches),
    "clean_deliveries": lambda t: t.clean_deliveries,
    "dim_matches": lambda t: t.matches,
    "dim_teams": lambda t: dimensions.teams(t.typed_matches),
    "dim_players": lambda t: dimensions.players(t.typed_deliveries),
    "dim_seasons": lambda t: dimensions.seasons(t.typed_matches),
    "fact_deliveries": lambda t: t.fact,
    "batting_stats": lambda t: stats.batting(t.balls, t.seasons),
    "bowling_stats": lambda t: stats.bowling(t.balls, t.seasons),
    "top_run_scorers": lambda t: reports.top_run_scorers(t.balls),
    "top_wicket_takers": lambda t: reports.top_wicket_takers(t.balls),
    "season_totals": lambda t: reports.season_totals(t.balls, t.seasons),
    "team_wins": lambda t: reports.team_wins(t.matches),
    "toss_impact": lambda t: reports.toss_impact(t.matches),
    "top_venues": lambda t: reports.top_venues(t.matches),
    "best_strike_rates": lambda t: reports.best_strike_rates(t.balls, MIN_BALLS_FACED),
    "most_sixes_in_season": lambda t: reports.most_sixes_in_season(t.balls, t.seasons),
    "powerplay_economy": lambda t: reports.powerplay_economy(t.balls, POWERPLAY, MIN_BALLS_BOWLED),
    "player_of_match": lambda t: reports.player_of_match(t.matches),
    "milestones": lambda t: reports.milestones(t.balls, HALF_CENTURY, CENTURY),
    "win_loss": lambda t: reports.win_loss(t.matches),
    "season_top_batters": lambda t: reports.season_top_batters(stats.batting(t.balls, t.seasons)),
    "season_top_bowlers": lambda t: reports.season_top_bowlers(stats.bowling(t.balls, t.seasons)),
    "venue_scoring": lambda t: reports.venue_scoring(t.balls, t.matches),
    "runs_per_dismissal": lambda t: reports.runs_per_dismissal(t.balls),
    "dim_matches_sql": lambda t: sql_tables.matches(t.matches_as_text),
    "fact_deliveries_sql": lambda t: sql_tables.deliveries(t.deliveries_as_text),
    "table_counts": lambda t: checks.counts(
        {
            "dim_matches": t.matches,
            "dim_teams": dimensions.teams(t.typed_matches),
            "dim_players": dimensions.players(t.typed_deliveries),
            "dim_seasons": dimensions.seasons(t.typed_matches),
            "fact_deliveries": t.fact,
            "batting_stats": stats.batting(t.balls, t.seasons),
            "bowling_stats": stats.bowling(t.balls, t.seasons),
        }
    ),
}


# ---- through files and the catalogue, in the shared scratch folder -----------


def places(spark: SparkSession, folder: str, name: str) -> flow.Places:
    """Places of one query over one folder of test tables; a rerun replaces them."""
    label = f"{name}_{zlib.crc32(folder.encode()):08x}"
    root = scratch(spark, label)
    return flow.Places(
        f"{root}/source", f"{root}/raw", f"{root}/processed", label, f"{root}/tables"
    )


def as_source_files(t: Tables, places: flow.Places) -> None:
    for raw, name in ((t.raw_matches, "matches"), (t.raw_deliveries, "deliveries")):
        raw.write.mode("overwrite").csv(f"{places.source}/{flow.RAW[name][0]}", header=True, escape='"')


def csv_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Raw deliveries written as CSV, read back as text and landed."""
    at = places(spark, folder, "csv_round_trip")
    as_source_files(Tables(spark, folder), at)
    flow.land(spark, at)
    return spark.read.parquet(f"{at.raw}/deliveries").select(*schemas.RAW_DELIVERIES)


# Line breaks inside quotes, quotes, commas: text that is written in quotes.
_STORIES = "concat(venue, ', \"', city, '\"\n', case when cast(id as bigint) % 3 = 0 then '\n\n' else '' end, 'end')"


def csv_multi_line(spark: SparkSession, folder: str) -> DataFrame:
    """Raw matches whose venue holds line breaks, written as CSV and read by byte ranges."""
    at = places(spark, folder, "csv_multi_line")
    raw = Tables(spark, folder).raw_matches.withColumn("venue", F.expr(_STORIES))
    path = f"{at.source}/{schemas.MATCHES_FILE}"
    raw.write.mode("overwrite").csv(path, header=True, escape='"')
    return files.read_csv(spark, path, schemas.RAW_MATCHES, multi_line=True)


def as_sloppy_files(t: Tables, at: flow.Places) -> None:
    for raw, name, columns, faults in (
        (t.raw_matches, "matches", mapping.SLOPPY_MATCHES, mapping.MATCH_FAULTS),
        (t.raw_deliveries, "deliveries", mapping.SLOPPY_DELIVERIES, mapping.DELIVERY_FAULTS),
    ):
        lines = mapping.sloppy_lines(raw, columns, faults)
        # The line is the only column: written as it is, below its header.
        lines.write.mode("overwrite").csv(f"{at.source}/{flow.RAW[name][0]}", header=True, sep="\x01", quote="")


def _sloppy(spark: SparkSession, folder: str) -> flow.Places:
    """Places of a flow from files with careless text and faulty lines, and of the tables created in SQL from them."""

    def work(at: flow.Places) -> None:
        as_sloppy_files(Tables(spark, folder), at)
        flow.land(spark, at)
        flow.transform(spark, at, BY_SEASON)
        for table in ("dim_matches", "fact_deliveries"):
            tables.drop_table(spark, at.database, table)
        flow.create(spark, at)

    _once(spark, folder, "sloppy", work)
    return places(spark, folder, "sloppy")


def _sloppy_table(table: str, sql: bool) -> Callable[[SparkSession, str], DataFrame]:
    """A table of that flow, or the one created in SQL from the same landed rows."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        at = _sloppy(spark, folder)
        if sql:
            return files.read_table(spark, at.database, table)
        return files.read_parquet(spark, runs.latest(spark, at.processed).path, table)

    return query


def rejected_rows(spark: SparkSession, folder: str) -> DataFrame:
    """How many landed rows of those files have which fault, or were refused for which reason."""
    at = _sloppy(spark, folder)
    each = [spark.read.parquet(f"{at.raw}/{name}").select(F.lit(name).alias("file"), flow.REASON, flow.REFUSED) for name in flow.RAW]
    rows = each[0].unionAll(each[1]).where(F.col(flow.REASON).isNotNull())
    reasons = rows.select("file", F.explode(F.split(flow.REASON, "; ")).alias("reason"), (F.col(flow.REFUSED) == 1).alias("refused"))
    return reasons.groupBy("file", "reason", "refused").agg(F.count("*").alias("row_count"))


def _database(spark: SparkSession, places: flow.Places) -> str:
    tables.create_database(spark, places.database, places.tables)
    return places.database


def table_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """The match dimension as a table in day folders."""
    database = _database(spark, places(spark, folder, "table_round_trip"))
    tables.load_table(Tables(spark, folder).matches, database, "dim_matches")
    return files.read_table(spark, database, "dim_matches")


def fact_by_season(spark: SparkSession, folder: str) -> DataFrame:
    """The delivery fact as a table in season folders, sorted by team."""
    database = _database(spark, places(spark, folder, "fact_by_season"))
    layout = BY_SEASON["fact_deliveries"]
    tables.load_table(Tables(spark, folder).fact, database, "fact_deliveries", layout)
    return files.read_table(spark, database, "fact_deliveries")


def fact_by_curve(spark: SparkSession, folder: str) -> DataFrame:
    """The delivery fact as a table along a curve through both team columns."""
    database = _database(spark, places(spark, folder, "fact_by_curve"))
    tables.load_table(Tables(spark, folder).fact, database, "fact_deliveries", BY_CURVE["fact_deliveries"])
    return files.read_table(spark, database, "fact_deliveries")


# What has been done, by application and folder; queries of the same tables share it.
_DONE: dict[tuple[str, str, str], str] = {}


def _once(spark: SparkSession, folder: str, name: str, work: Callable[[flow.Places], None]) -> str:
    """The database of ``name``, filled by ``work`` unless this application has done so."""
    key, at = (spark.sparkContext.applicationId, folder, name), places(spark, folder, name)
    if key not in _DONE:
        work(at)
        _DONE[key] = at.database
    return _DONE[key]


def _created(table: str) -> Callable[[SparkSession, str], DataFrame]:
    """A table created from SQL, and once more from other rows, to no effect."""
    return lambda spark, folder: files.read_table(spark, _creation(spark, folder), table)


def _creation(spark: SparkSession, folder: str) -> str:
    t = Tables(spark, folder)

    def work(at: flow.Places) -> None:
        database = _database(spark, at)
        for table in schemas.TABLES:
            spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{table}`")
        for matches, balls in (
            (t.matches_as_text, t.deliveries_as_text),
            (t.matches_as_text.where("city IS NULL"), t.deliveries_as_text.where("inning = '1'")),
        ):
            sql_tables.create_matches(database, matches)
            sql_tables.create_deliveries(database, balls)
            tables.create_table(spark, database, "dim_seasons")

    return _once(spark, folder, "created_tables", work)


def created_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Row counts of the tables created from SQL."""
    database = _creation(spark, folder)
    created = ("dim_matches", "fact_deliveries", "dim_seasons")
    return checks.counts({name: files.read_table(spark, database, name) for name in created})


def _after_flow(table: str) -> Callable[[SparkSession, str], DataFrame]:
    """A table after land, transform, load and validate from CSV files, by season."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        def work(at: flow.Places) -> None:
            as_source_files(Tables(spark, folder), at)
            flow.run(spark, at, BY_SEASON)

        return files.read_table(spark, _once(spark, folder, "flow", work), table)

    return query


def flow_after_failure(spark: SparkSession, folder: str) -> DataFrame:
    """The fact of a first run, after a second transform that failed half-way.

    The second raw zone holds fewer matches, and deliveries that lack most columns:
    the match tables are written before the fact fails.
    """
    at = places(spark, folder, "flow_after_failure")
    as_source_files(Tables(spark, folder), at)
    flow.run(spark, at, BY_SEASON)
    broken = replace(at, raw=f"{at.raw}-broken")
    for name, keep in (("matches", "*"), ("deliveries", "match_id")):
        raw = spark.read.parquet(f"{at.raw}/{name}").select(keep)
        raw.where(~F.col(raw.columns[0]).endswith("3")).write.mode("overwrite").parquet(f"{broken.raw}/{name}")
    try:
        flow.transform(spark, broken, BY_SEASON)
    except AnalysisException:
        flow.load(spark, at)
        return files.read_table(spark, at.database, "fact_deliveries")
    raise AssertionError("a transform without deliveries columns did not fail")


def load_after_failure(spark: SparkSession, folder: str) -> DataFrame:
    """Row counts of all tables after a load of a later run that lacks the files of its fact.

    The later run holds fewer matches: its other tables are whole, and of other counts.
    """
    at = places(spark, folder, "load_after_failure")
    t = Tables(spark, folder)
    as_source_files(t, at)
    flow.run(spark, at, BY_SEASON)
    fewer = t.raw_matches.where("id LIKE '%1'")
    fewer.write.mode("overwrite").csv(f"{at.source}/{schemas.MATCHES_FILE}", header=True, escape='"')
    flow.land(spark, at)
    flow.transform(spark, at, BY_SEASON)
    lost = f"{runs.latest(spark, at.processed).path}/fact_deliveries"
    spark.createDataFrame([], schemas.struct("fact_deliveries")).write.mode("overwrite").parquet(lost)
    try:
        flow.load(spark, at)
    except checks.WrongCount:
        return checks.counts({name: files.read_table(spark, at.database, name) for name in schemas.TABLES})
    raise AssertionError("a load without the rows of the fact did not fail")


def _query(plan: Callable[[Tables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: plan(Tables(spark, folder))


QUERIES = {name: _query(plan) for name, plan in _PLANS.items()} | {
    "csv_round_trip": csv_round_trip,
    "csv_multi_line": csv_multi_line,
    "rejected_rows": rejected_rows,
    **{f"sloppy_{t}": _sloppy_table(t, sql=False) for t in ("dim_matches", "fact_deliveries", "batting_stats")},
    **{f"sloppy_{t}_sql": _sloppy_table(t, sql=True) for t in ("dim_matches", "fact_deliveries")},
    "table_round_trip": table_round_trip,
    "fact_by_season": fact_by_season,
    "fact_by_curve": fact_by_curve,
    "created_tables": created_tables,
    "created_matches": _created("dim_matches"),
    "created_deliveries": _created("fact_deliveries"),
    "flow_after_failure": flow_after_failure,
    "load_after_failure": load_after_failure,
    **{f"flow_{table}": _after_flow(table) for table in schemas.TABLES},
}
