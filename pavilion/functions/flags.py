"""0/1 flags of a delivery. A NULL input never raises a flag."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FOUR, SIX = 4, 6


def flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def delivery_flags() -> dict[str, Column]:
    """Flag name to expression, over a cleansed delivery."""
    runs = F.col("batsman_runs")
    return {
        "is_boundary": flag(runs.isin(FOUR, SIX)),
        "is_four": flag(runs == FOUR),
        "is_six": flag(runs == SIX),
        "is_dot_ball": flag(F.col("total_runs") == 0),
        "is_wicket": flag(F.col("player_dismissed").isNotNull()),
    }
