"""Typing, key checks and deduplication of raw rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pavilion import schemas
from pavilion.functions.parsing import parsed, parsed_key, rejected


def typed(raw: DataFrame, kinds: dict[str, str], required: tuple[str, ...]) -> DataFrame:
    """Cast the columns named in ``kinds`` and drop rows lacking a required one.

    A required column is a key and must be a whole number, 7.0 as well as 7: cutting
    a fraction off would merge two keys. The null check on the raw column reaches the
    scan. :func:`refused` has the dropped rows.

    Repeated rows are still in. Anything that only asks for distinct values
    should start here: the scan then reads just the columns it needs, which a
    whole-row deduplication would prevent.
    """
    casts = _values(kinds, required)
    return with_values(with_values(raw, required).withColumns(casts), required)


def _values(kinds: dict[str, str], required: tuple[str, ...]) -> dict[str, Column]:
    """The values of the cast columns."""
    return {
        c: parsed_key(F.col(c), kind) if c in required else parsed(F.col(c), kind)
        for c, kind in schemas.typed_columns(kinds).items()
    }


def refusals(required: tuple[str, ...], kinds: dict[str, str]) -> dict[str, Column]:
    """Why :func:`typed` drops a row: the possible reasons, each with its condition."""
    values = _values(kinds, required)
    reasons = {}
    for c in required:
        reasons[f"{c} is missing"] = F.col(c).isNull()
        if c in values:
            reasons[f"{c} is no whole number"] = F.col(c).isNotNull() & values[c].isNull()
    return reasons


def refusal(required: tuple[str, ...], kinds: dict[str, str]) -> Column:
    """The reasons of a row in one text, empty for a row that :func:`typed` takes."""
    return F.concat_ws("; ", *[F.when(wrong, reason) for reason, wrong in refusals(required, kinds).items()])


def refused(raw: DataFrame, kinds: dict[str, str], required: tuple[str, ...]) -> DataFrame:
    """The rows that :func:`typed` drops, as they came, and why in ``_reason``."""
    return raw.withColumn("_reason", refusal(required, kinds)).where("_reason != ''")


def with_values(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Rows that have a value in each of ``columns``.

    One condition per column: those on stored columns then reach the file scan.
    """
    for column in columns:
        df = df.where(F.col(column).isNotNull())
    return df


def typed_matches(raw: DataFrame) -> DataFrame:
    return typed(raw, schemas.RAW_MATCHES, schemas.MATCH_KEYS)


def typed_deliveries(raw: DataFrame) -> DataFrame:
    return typed(raw, schemas.RAW_DELIVERIES, schemas.DELIVERY_KEYS)


def clean_matches(raw: DataFrame) -> DataFrame:
    """Typed match rows without repeats."""
    return typed_matches(raw).dropDuplicates()


def clean_deliveries(raw: DataFrame) -> DataFrame:
    """Typed delivery rows without repeats.

    The one shuffle is keyed on the whole row and each task first drops its own
    copies, so neither a hot match nor a mass of equal rows lands in one task.
    """
    return typed_deliveries(raw).dropDuplicates()


def reject_counts(kinds: dict[str, str], required: tuple[str, ...] = ()) -> list[Column]:
    """Aggregates that count, per cast column, the text that gave no value; by the rule of keys where ``required``."""
    return [rejected(F.col(c), value).alias(c) for c, value in _values(kinds, required).items()]


def smallest_per_key(df: DataFrame, key: str) -> DataFrame:
    """One row per ``key``: the smallest by the other columns in order, NULL lowest.

    An aggregate, so copies of a hot key are reduced before the shuffle and a
    rerun picks the same row.
    """
    rest = [c for c in df.columns if c != key]
    best = df.groupBy(key).agg(F.min(F.struct(*rest)).alias("best"))
    return best.select(key, *[F.col("best")[c].alias(c) for c in rest]).select(*df.columns)


def distinct_values(df: DataFrame, columns: tuple[str, ...], name: str) -> DataFrame:
    """Distinct non-NULL values found in any of ``columns``.

    The union of the columns is formed row by row, in one scan of ``df``; each
    task reduces it to its own distinct values before the shuffle.
    """
    if len(columns) == 1:
        values = df.select(F.col(columns[0]).alias(name))
    else:
        values = df.select(F.explode(F.array(*columns)).alias(name))
    return with_values(values, (name,)).distinct()
