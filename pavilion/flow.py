"""Land, transform, load, validate: the batch from raw files to checked tables.

Stages hand over through storage only, so any of them can be run again. The tables
of a transform lie in a folder of their own: the database keeps its content until a
whole new set is there, whatever fails on the way.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pavilion import checks, schemas
from pavilion.functions.parsing import counted
from pavilion.operators import cleansing
from pavilion.plans import dimensions, facts, sql_tables, stats
from pavilion.sinks import runs, switch, tables
from pavilion.sinks.layout import STANDARD, Layout
from pavilion.sources import files

log = logging.getLogger(__name__)

RAW = {
    "matches": (schemas.MATCHES_FILE, schemas.RAW_MATCHES),
    "deliveries": (schemas.DELIVERIES_FILE, schemas.RAW_DELIVERIES),
}
KEYS = {"matches": schemas.MATCH_KEYS, "deliveries": schemas.DELIVERY_KEYS}


# Beside the raw columns of a landed row: 1 if no table can take it, and why; the line of a
# row that is refused or faulty.
REFUSED, REASON = "refused", "_reason"


class Landed(dict):
    """Counts by file; ``refused`` and ``faulty`` have those of refused rows and of rows by reason."""

    refused: dict[str, int]
    faulty: dict[str, dict[str, int]]


class Written(dict):
    """Row counts by table; ``refused`` has those of the raw rows that no table could take, by file."""

    refused: dict[str, int]


@dataclass(frozen=True)
class Places:
    """Where things are: source files, raw zone, processed zone, database.

    ``tables`` is the folder of a database that has to be created; by default it
    lies in the session's warehouse folder.
    """

    source: str
    raw: str
    processed: str
    database: str
    tables: str | None = None


def land(
    spark: SparkSession,
    places: Places,
    null_words: tuple[str, ...] = files.NULL_WORDS,
    multi_line: bool = False,
    strict: bool = False,
) -> Landed:
    """Bring the source files into the raw zone, as text columns in Parquet.

    Nothing is written unless all files are there. Returns, per file, the number
    of rows and, per cast column, how many of its texts will not give a value.

    Rows that no table can take, for want of a key, go to a folder of their own in the
    same pass, with the reason and the line as it came. A faulty line (too many or too
    few fields, an unclosed quote) is taken as far as it can be read, and its fault and
    text are kept beside it; with ``strict`` it is refused.
    """
    found = {
        name: files.read_lines(spark, f"{places.source}/{file}", kinds, null_words, multi_line)
        for name, (file, kinds) in RAW.items()
    }
    counts = Landed()
    counts.refused, counts.faulty = {}, {}
    for name, raw in found.items():
        kinds, keys = RAW[name][1], KEYS[name]
        if {REFUSED, REASON} & {c.lower() for c in raw.columns}:
            raise ValueError(f"{RAW[name][0]} has a column called {REFUSED} or {REASON}")
        fault = F.col(files.FAULT)
        refusals = cleansing.refusals(keys, kinds)
        reason = F.concat_ws("; ", fault, *[F.when(condition, text) for text, condition in refusals.items()])
        wrong = reduce(Column.__or__, refusals.values())
        refused = (wrong | fault.isNotNull()) if strict else wrong
        told = raw.withColumns({REASON: F.nullif(reason, F.lit("")), REFUSED: refused.cast("int")})
        told = told.withColumn(files.LINE, F.when(F.col(REASON).isNotNull(), F.col(files.LINE)))
        why = {**{f: fault == f for f in files.FAULTS}, **refusals}
        seen = [
            *cleansing.reject_counts(kinds, keys),
            F.sum(REFUSED).alias(REFUSED),
            *[counted(condition).alias(text) for text, condition in why.items()],
        ]
        # The fault is part of the reason; it stays until the rows are counted.
        row = tables.write_routed(told, f"{places.raw}/{name}", REFUSED, counts=seen)
        counts.faulty[name] = {text: n for text in why if (n := row.pop(text))}
        counts.refused[name] = row.pop(REFUSED) or 0
        counts[name] = row
        log.info("landed %s: %s, refused %s, %s", name, row, counts.refused[name], counts.faulty[name])
    return counts


def landed(spark: SparkSession, places: Places, name: str) -> tuple[DataFrame, DataFrame]:
    """Accepted and refused rows of a landed file. Other Parquet folders are told apart on the way."""
    raw = spark.read.parquet(f"{places.raw}/{name}")
    if REFUSED in raw.columns:
        extra = [files.LINE, files.FAULT]
        accepted = raw.where(F.col(REFUSED) == 0).drop(REFUSED, REASON, *extra)
        return accepted, raw.where(F.col(REFUSED) == 1).drop(REFUSED, files.FAULT)
    return raw, cleansing.refused(raw, RAW[name][1], KEYS[name])


def transform(
    spark: SparkSession, places: Places, layouts: dict[str, Layout] = STANDARD
) -> Written:
    """Build the seven tables as a new run in the processed zone. Returns their row counts.

    Raw rows without a usable key are kept in the run's folder below ``rejected``, with
    the reason of each; ``refused`` of the result has their numbers.

    The fact is written once and the statistics are derived from the written
    fact, reading a few of its columns; the players come from the statistics.
    Tables with generated keys are already in the order of their names, as the
    key builder sorts them by ranges.
    """
    rows = Written()
    folder = f"{places.processed}/{runs.new_run()}"

    def write(table: str, df: DataFrame, in_order: bool = False) -> DataFrame:
        layout = Layout() if in_order else layouts[table]
        rows[table] = tables.write_parquet(df, f"{folder}/{table}", layout)["rows"]
        log.info("wrote %s: %s rows", table, rows[table])
        return files.read_parquet(spark, folder, table)

    raw = {name: landed(spark, places, name) for name in RAW}
    rows.refused = {}
    for name, (_, left_out) in raw.items():
        rows.refused[name] = tables.write_parquet(left_out, f"{folder}/rejected/{name}")["rows"]
        log.info("refused of %s: %s rows", name, rows.refused[name])
    matches = cleansing.typed_matches(raw["matches"][0])
    written = write("dim_matches", dimensions.matches(matches))
    write("dim_teams", dimensions.teams(matches), in_order=True)
    write("dim_seasons", dimensions.seasons(matches), in_order=True)
    typed = cleansing.typed_deliveries(raw["deliveries"][0])
    fact = write("fact_deliveries", facts.flagged(facts.seasoned_once(typed, written)))
    batting = write("batting_stats", stats.batting(fact))
    bowling = write("bowling_stats", stats.bowling(fact))
    write("dim_players", dimensions.players_of(batting, bowling), in_order=True)
    runs.finish(spark, folder, rows, {table: layouts[table].partition for table in rows})
    return rows


def create(spark: SparkSession, places: Places) -> None:
    """Create the match dimension and the delivery fact in SQL from the raw zone; existing tables stay."""
    matches, deliveries = (landed(spark, places, name)[0] for name in RAW)
    matches = cleansing.clean_matches(matches)
    balls = facts.seasoned_once(cleansing.typed_deliveries(deliveries), dimensions.match_seasons(matches))
    tables.create_database(spark, places.database, places.tables)
    sql_tables.create_matches(places.database, matches)
    sql_tables.create_deliveries(places.database, balls)


def load(
    spark: SparkSession,
    places: Places,
    layouts: dict[str, Layout] | None = None,
    copy: bool = False,
) -> dict[str, int]:
    """Make the newest finished run the content of the database. Returns row counts.

    The tables are put on top of the run's folders, in the layout it was written
    with. With ``copy`` the database gets rows of its own, in ``layouts`` or the
    standard ones. The counts are those of the new tables and must equal what the
    transform wrote; only then are all seven tables switched, or none (see
    `sinks.switch`). A switch that an earlier load left half-way is finished first.
    """
    run = runs.latest(spark, places.processed)
    partitions = run.partitions
    if layouts and not copy and {t: layouts[t].partition for t in STANDARD} != partitions:
        raise ValueError(f"{run.path} has another layout; transform again, or load with copy")
    tables.create_database(spark, places.database, places.tables)
    switch.complete(spark, places.database, list(STANDARD))
    folder, kept_in = run.path, places.processed
    if copy:
        layouts = layouts or STANDARD
        kept_in = spark.catalog.getDatabase(places.database).locationUri.rstrip("/")
        folder = f"{kept_in}/{runs.new_run()}"
        partitions = {table: layouts[table].partition for table in STANDARD}
        for table in STANDARD:
            df = files.read_parquet(spark, run.path, table)
            rows = tables.write_parquet(df, f"{folder}/{table}", layouts[table])["rows"]
            log.info("copied %s: %s rows", table, rows)
    names = {
        table: switch.prepare(spark, places.database, table, f"{folder}/{table}", Layout(partitions[table]))
        for table in STANDARD
    }
    try:
        loaded = checks.row_counts(spark, places.database, names)
        checks.same_counts(run.rows, loaded)
    except Exception:
        switch.give_up(spark, places.database, list(names))
        raise
    switch.switch(spark, places.database, list(names), folder)
    log.info("%s shows %s", places.database, folder)
    runs.remove_older(spark, kept_in, folder.rpartition("/")[2])
    return loaded


def run(
    spark: SparkSession,
    places: Places,
    layouts: dict[str, Layout] = STANDARD,
    copy: bool = False,
    multi_line: bool = False,
    strict: bool = False,
) -> dict[str, int]:
    """All stages in order. Returns the validated row counts."""
    land(spark, places, multi_line=multi_line, strict=strict)
    transform(spark, places, layouts)
    return checks.none_empty(load(spark, places, layouts, copy))
