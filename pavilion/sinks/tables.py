"""Writing Parquet folders and catalogue tables.

Every write replaces its target, so a stage can be run again. Row counts come
from the write itself; nothing is read back to be counted.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import AbstractContextManager, contextmanager, nullcontext

from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F

from pavilion import schemas
from pavilion.schemas import quoted
from pavilion.session import few_folders, many_folders
from pavilion.sinks import switch
from pavilion.sinks.layout import STANDARD, Layout, arranged


def _counted(df: DataFrame, extra: Sequence[Column] = ()) -> tuple[DataFrame, Observation]:
    # The observation sits on top of the plan, in the tasks that write: what a
    # range shuffle samples below it is not counted.
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *extra), seen


def _writer(df: DataFrame, layout: Layout) -> DataFrameWriter:
    writer = df.write.mode("overwrite").format("parquet")
    return writer.partitionBy(layout.partition) if layout.partition else writer


def _folders(df: DataFrame, layout: Layout) -> AbstractContextManager[None]:
    return many_folders(df.sparkSession) if layout.partition else nullcontext()


def _remove(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def _ready(df: DataFrame, path: str, layout: Layout) -> Iterator[DataFrame]:
    """``df``; for a curve, which reads it several times, from a folder of its own beside ``path``."""
    if not layout.curve:
        yield df
        return
    beside = f"{path.rstrip('/')}-{uuid.uuid4().hex[:12]}"
    try:
        df.write.parquet(beside)
        yield df.sparkSession.read.schema(df.schema).parquet(beside)
    finally:
        _remove(df.sparkSession, beside)


def write_parquet(
    df: DataFrame, path: str, layout: Layout = Layout(), counts: Sequence[Column] = ()
) -> dict[str, int]:
    """Replace the Parquet folder ``path``. Returns ``rows`` and any further ``counts``."""
    with _ready(df, path, layout) as ready:
        rows, seen = _counted(arranged(ready, layout), counts)
        with _folders(df, layout):
            _writer(rows, layout).save(path)
        return seen.get


def write_routed(df: DataFrame, path: str, column: str, counts: Sequence[Column] = ()) -> dict[str, int]:
    """Like `write_parquet`, every row in the folder of its value in ``column``, which has few.

    All rows leave their own task, in one pass and without a shuffle. Without any rows,
    the folder still has the columns.
    """
    rows, seen = _counted(df, counts)
    with few_folders(df.sparkSession):
        _writer(rows, Layout(column)).save(path)
    found = seen.get
    if not found["rows"]:
        df.sparkSession.createDataFrame([], df.schema).write.mode("overwrite").parquet(path)
    return found


def create_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    """A database unless it exists, in ``location`` or the session's warehouse folder."""
    where = f"LOCATION {switch.text(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)} {where}")


def create_table(spark: SparkSession, database: str, table: str) -> None:
    """An empty table with the declared columns, unless it exists."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {quoted(database, table)} ({schemas.ddl(table)}) USING PARQUET"
    )


def drop_table(spark: SparkSession, database: str, table: str) -> None:
    """Drop a table, if the database and the table exist."""
    if spark.catalog.databaseExists(database):
        spark.sql(f"DROP TABLE IF EXISTS {quoted(database, table)}")


def load_table(df: DataFrame, database: str, table: str, layout: Layout | None = None) -> int:
    """Replace a catalogue table by ``df``, laid out. Returns its number of rows.

    The rows are written to a folder of their own in the database's; the table has its
    old ones until they are all there. ``df`` may read the table.
    """
    layout = STANDARD[table] if layout is None else layout
    spark = df.sparkSession
    home = spark.catalog.getDatabase(database).locationUri.rstrip("/")
    before = _folder(spark, database, table)
    path = f"{home}/{table}-{uuid.uuid4().hex[:12]}"
    rows = write_parquet(df, path, layout)["rows"]
    attach_table(spark, database, table, path, layout)
    if before and before.startswith(f"{home}/{table}-"):
        _remove(spark, before)
    return rows


def _folder(spark: SparkSession, database: str, table: str) -> str | None:
    """Where a table's rows lie, if there is such a table."""
    if not spark.catalog.tableExists(quoted(database, table)):
        return None
    told = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(database, table)}")
    rows = told.where(F.col("col_name") == "Location").select("data_type").collect()
    return rows[0][0].rstrip("/") if rows else None


def attach_table(
    spark: SparkSession, database: str, table: str, path: str, layout: Layout | None = None
) -> None:
    """Make a written Parquet folder the content of a catalogue table, without a copy."""
    switch.prepare(spark, database, table, path, STANDARD[table] if layout is None else layout)
    switch.switch(spark, database, [table], path)
