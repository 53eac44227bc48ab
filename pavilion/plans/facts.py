"""The delivery fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pavilion import schemas
from pavilion.functions.flags import delivery_flags
from pavilion.operators.lookup import distinct_lookup, lookup

FACT = schemas.columns("fact_deliveries")


def flagged(rows: DataFrame) -> DataFrame:
    """Cleansed deliveries with their flags, as far as the rows have the columns.

    Without a season this is the fact less that column: enough for every report
    that does not mention the season, and it saves them the join.
    """
    flags = delivery_flags()
    present = set(rows.columns) | set(flags)
    return rows.withColumns(flags).select(*[c for c in FACT if c in present])


def with_season(
    rows: DataFrame, matches: DataFrame, salts: int | None = None, like: DataFrame | None = None
) -> DataFrame:
    """Add the season of each row's match; NULL where the match is unknown.

    ``matches`` is the match dimension, or just its key and season. ``salts`` and
    ``like`` are those of `lookup`.
    """
    return lookup(rows, _seasons(matches), "match_id", salts, like)


def _seasons(matches: DataFrame) -> DataFrame:
    return matches.select("match_id", F.col("season_year").alias("season"))


def seasoned_once(typed: DataFrame, matches: DataFrame) -> DataFrame:
    """The fact less its flags, from typed rows that may repeat: one shuffle of them drops
    repeats and looks up the season. Hot matches are looked for at once."""
    return distinct_lookup(typed, _seasons(matches), "match_id", list(schemas.RAW_DELIVERIES))


def deliveries(clean: DataFrame, matches: DataFrame, like: DataFrame | None = None) -> DataFrame:
    """One row per cleansed delivery. ``like``: the same rows before repeats were removed.

    The season is always the one of the match: a season column of the raw file
    is left out. Flags are added after the join, which then moves fewer columns.
    """
    return flagged(with_season(unseasoned(clean), matches, like=like))


def unseasoned(clean: DataFrame) -> DataFrame:
    """The delivery columns the fact is made of."""
    return clean.select(*schemas.RAW_DELIVERIES)
