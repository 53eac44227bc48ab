"""Top-k, globally and per group. Ties are always broken by a key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top(df: DataFrame, k: int, *order: Column | str) -> DataFrame:
    """First ``k`` rows in ``order``; every task keeps only its own best ``k``."""
    return df.orderBy(*order).limit(k)


def _first(df: DataFrame, group: list[str], k: int, order: tuple) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("rank", place).where(F.col("rank") <= k)


def top_per_group(df: DataFrame, group: str, k: int, *order: Column | str) -> DataFrame:
    """First ``k`` rows of every group, with their ``rank``.

    Whatever ``k``, a group is first cut down to ``k`` in each of its parts, of which
    there are as many as shuffle partitions, so no task sorts more than its share of
    a group that holds most rows. For a small ``k`` the planner also limits each task
    before both shuffles.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = df.withColumn("part", F.pmod(F.xxhash64(*df.columns), F.lit(parts)))
    best = _first(spread, [group, "part"], k, order).select(*df.columns)
    return _first(best, [group], k, order)
