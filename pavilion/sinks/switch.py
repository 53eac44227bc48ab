"""One switch for a whole set of tables.

New tables are made beside the live ones, under names of their own, and checked there.
Only then does the database note which folder it is going to, and the tables change
names, which takes no more than a few operations of the catalogue: a reader meets the
old rows of a table or the new ones, and no table is dropped before its successor is
ready. A switch that fails is taken back at once; one that broke off with its session is
finished, from the note, by whoever comes next.
"""

from __future__ import annotations

import logging

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from pavilion import schemas
from pavilion.schemas import quoted
from pavilion.session import many_folders
from pavilion.sinks.layout import Layout

log = logging.getLogger(__name__)

# What the database notes: the folder that its tables lie in, and the one they are going to.
CURRENT, GOING = "pavilion.current", "pavilion.going_to"
_NEXT, _LAST = "__next", "__last"


def text(value: str) -> str:
    """A literal of SQL."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _exists(spark: SparkSession, database: str, table: str) -> bool:
    return spark.catalog.tableExists(quoted(database, table))


def _drop(spark: SparkSession, database: str, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {quoted(database, table)}")


def _rename(spark: SparkSession, database: str, old: str, new: str) -> None:
    spark.sql(f"ALTER TABLE {quoted(database, old)} RENAME TO {quoted(database, new)}")


def note(spark: SparkSession, database: str, name: str) -> str | None:
    """What the database notes under ``name``."""
    told = spark.sql(f"DESCRIBE DATABASE EXTENDED {quoted(database)}")
    rows = told.where(F.col("info_name") == "Properties").select("info_value").collect()
    # The properties come as one text, ((name,value), (name,value)).
    for pair in (rows[0][0].strip("()").split("), (") if rows else []):
        key, _, value = pair.partition(",")
        if key == name:
            return value or None
    return None


def _write_notes(spark: SparkSession, database: str, **notes: str) -> None:
    pairs = ", ".join(f"{text(name)} = {text(value)}" for name, value in notes.items())
    spark.sql(f"ALTER DATABASE {quoted(database)} SET DBPROPERTIES ({pairs})")


def prepare(spark: SparkSession, database: str, table: str, path: str, layout: Layout) -> str:
    """Make the Parquet folder ``path`` the successor of a table, beside it. Returns its name."""
    name = table + _NEXT
    _drop(spark, database, name)
    folders = f"PARTITIONED BY ({quoted(layout.partition)})" if layout.partition else ""
    spark.sql(
        f"CREATE TABLE {quoted(database, name)} ({schemas.ddl(table)}) USING PARQUET {folders} LOCATION {text(path)}"
    )
    if layout.partition:
        with many_folders(spark):
            spark.sql(f"ALTER TABLE {quoted(database, name)} RECOVER PARTITIONS")
    return name


def give_up(spark: SparkSession, database: str, tables: list[str]) -> None:
    """Drop prepared successors."""
    for table in tables:
        _drop(spark, database, table + _NEXT)


def _put(spark: SparkSession, database: str, table: str) -> None:
    """Put the successor in the place of a table; nothing if that has been done."""
    if not _exists(spark, database, table + _NEXT):
        return
    if _exists(spark, database, table):
        _drop(spark, database, table + _LAST)
        _rename(spark, database, table, table + _LAST)
    _rename(spark, database, table + _NEXT, table)


def _take_back(spark: SparkSession, database: str, tables: list[str]) -> None:
    for table in tables:
        if _exists(spark, database, table + _LAST):
            if _exists(spark, database, table):
                _drop(spark, database, table + _NEXT)
                _rename(spark, database, table, table + _NEXT)
            _rename(spark, database, table + _LAST, table)
    give_up(spark, database, tables)


def switch(spark: SparkSession, database: str, tables: list[str], folder: str) -> None:
    """Put all prepared successors in the place of their tables; if one fails, none."""
    _write_notes(spark, database, **{GOING: folder})
    fresh = [table for table in tables if not _exists(spark, database, table)]
    try:
        for table in tables:
            _put(spark, database, table)
    except Exception:
        _take_back(spark, database, tables)
        for table in fresh:  # there was none before
            _drop(spark, database, table)
        _write_notes(spark, database, **{GOING: ""})
        raise
    _finish(spark, database, tables, folder)


def _finish(spark: SparkSession, database: str, tables: list[str], folder: str) -> None:
    _write_notes(spark, database, **{CURRENT: folder, GOING: ""})
    for table in tables:
        _drop(spark, database, table + _LAST)


def complete(spark: SparkSession, database: str, tables: list[str]) -> str | None:
    """Finish a switch that broke off half-way. Returns the folder that the tables lie in now, if it did.

    The successors were checked before the switch began, so it goes forward.
    """
    folder = note(spark, database, GOING)
    if folder:
        log.info("finishing the switch of %s to %s", database, folder)
        for table in tables:
            _put(spark, database, table)
        _finish(spark, database, tables, folder)
    return folder
