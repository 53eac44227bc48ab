"""Reading raw files, Parquet folders and catalogue tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pavilion import schemas
from pavilion.functions.parsing import blank_to_null
from pavilion.session import many_folders
from pavilion.sources.records import records

# Words that stand for "no value" in the raw files.
NULL_WORDS = ("", "NA")

# A record as it came, and what is wrong with it, beside the columns of `read_lines`.
LINE, FAULT = "_line", "_fault"
FAULTS = ("too many fields", "too few fields", "unclosed quote")

# Parts of whole fields, then an opening quote and no closing one. Nothing is tried twice.
_UNCLOSED = r'^(?:(?:"(?:[^"]++|"")*+"[^,"]*+|[^",][^,]*+)?,)*+"(?:[^"]++|"")*+$'
# Text hardly holds this character, so that a line is one value.
_AS_ONE = {"header": True, "sep": "\x01", "quote": ""}


def read_csv(
    spark: SparkSession,
    path: str,
    expected: dict[str, str],
    null_words: tuple[str, ...] = NULL_WORDS,
    multi_line: bool = False,
) -> DataFrame:
    """Raw CSV with a header, every column as text.

    A quote inside a quoted value is written twice. With ``multi_line`` quoted
    values may hold line breaks; files are split between tasks all the same.

    Columns are found by header name, in any order, and extra ones are kept,
    since two rows that differ only there are two rows. Files whose header
    differs from the first one's are refused rather than misread. A line with
    too few fields lacks the last values, one with too many loses the rest; see
    `read_lines` for what they were.
    """
    return read_lines(spark, path, expected, null_words, multi_line).drop(LINE, FAULT)


def read_lines(
    spark: SparkSession,
    path: str,
    expected: dict[str, str],
    null_words: tuple[str, ...] = NULL_WORDS,
    multi_line: bool = False,
) -> DataFrame:
    """The rows of `read_csv`, each with its text in ``_line`` and its fault, if any, in ``_fault``.

    Faults are ``too many fields``, ``too few fields`` and ``unclosed quote``. Blank
    lines are no rows. A record too long to be held (`records.LONGEST`, or a file of which
    the rest lies behind an unclosed quote) comes in parts, without values.
    """
    try:
        names = spark.read.csv(path, header=True, escape='"', multiLine=multi_line).columns
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"raw file missing: {path}") from error
        raise
    headers = {name.lower() for name in names}
    absent = [name for name in expected if name not in headers]
    if absent:
        raise ValueError(f"{path} lacks the columns {', '.join(absent)}")
    if headers & {LINE, FAULT}:
        raise ValueError(f"{path} has a column called {LINE} or {FAULT}")
    (header, *_) = spark.read.csv(path, **_AS_ONE).columns or [""]
    lines = records(spark, path, header, LINE) if multi_line else _lines(spark, path, header)
    return _parsed(lines, names, expected, null_words)


def _lines(spark: SparkSession, path: str, header: str) -> DataFrame:
    """The lines of all files but their headers, which must be equal."""
    # A line that does hold the separator is kept apart as a whole.
    schema = T.StructType([T.StructField(header, T.StringType()), T.StructField(FAULT, T.StringType())])
    read = spark.read.schema(schema).csv(path, enforceSchema=False, columnNameOfCorruptRecord=FAULT, **_AS_ONE)
    return read.toDF(LINE, FAULT).select(F.coalesce(FAULT, LINE).alias(LINE))


def _parsed(lines: DataFrame, names: list[str], expected: dict[str, str], null_words: tuple[str, ...]) -> DataFrame:
    """Records as columns. Those that are cut off (null ``whole``) have only their text."""
    fields = [T.StructField(f"c{i}", T.StringType()) for i in range(len(names))]
    schema = T.StructType([*fields, T.StructField("wrong", T.StringType())])
    line = F.col(LINE)
    whole = F.when(F.col("whole"), line) if "whole" in lines.columns else line
    options = {"escape": '"', "columnNameOfCorruptRecord": "wrong", "multiLine": "true"}
    read = lines.select(LINE, F.from_csv(whole, schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), options).alias("read"))
    quotes = F.length(line) - F.length(F.replace(line, F.lit('"')))
    unclosed = (quotes % 2 == 1) & line.rlike(_UNCLOSED)
    if "whole" in lines.columns:
        unclosed = unclosed | F.col("read").isNull()
    bare = F.regexp_replace(line, r'"[^"]*"', "")
    separators = F.length(bare) - F.length(F.replace(bare, F.lit(",")))
    count = F.when(separators >= len(names), FAULTS[0]).when(separators < len(names) - 1, FAULTS[1])
    fault = F.when(unclosed, FAULTS[2]).when(F.col("read.wrong").isNotNull(), F.coalesce(count, F.lit(FAULTS[2])))
    return read.select(
        *[
            blank_to_null(F.col("read")[f"c{i}"], null_words).alias(c.lower() if c.lower() in expected else c)
            for i, c in enumerate(names)
        ],
        LINE,
        fault.alias(FAULT),
    )


def fault_counts() -> list[Column]:
    """Aggregates over `read_lines` that count each fault."""
    return [F.count_if(F.col(FAULT) == fault).alias(fault) for fault in FAULTS]


def read_parquet(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A built table from its Parquet folder, with the declared types.

    The declared types also hold for partition folders, so a season label such
    as ``2009`` stays text.
    """
    schema = schemas.struct(table)
    with many_folders(spark):
        return spark.read.schema(schema).parquet(f"{folder}/{table}").select(*schema.names)


def read_table(spark: SparkSession, database: str, table: str) -> DataFrame:
    """A catalogue table in its declared column order."""
    return spark.table(schemas.quoted(database, table)).select(*schemas.columns(table))
