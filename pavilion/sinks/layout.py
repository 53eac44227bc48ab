"""How each table is cut into folders and files.

Partition columns become folders, which a filter prunes without opening a file.
Cluster columns order the rows inside the files, so the statistics of each
Parquet row group let a filter skip the rest. In that order the first column comes
first, and a filter on another one alone finds its rows all over; on a curve through
all of them, files are small in every column.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A cluster column on a curve is cut into so many ranges, as a power of two, by a sample of
# about so many rows.
CURVE_BITS, CURVE_SAMPLE = 6, 10_000


@dataclass(frozen=True)
class Layout:
    """``unique`` says that the cluster columns together identify a row.

    ``fine`` is for folders that hold many files each: rows then come together
    by folder and cluster values, so that a file holds few cluster values. Small
    folders are better off without it, with all their rows in one file.
    ``curve`` orders the rows along a Z-curve through the ranges of all cluster columns.
    """

    partition: str | None = None
    cluster: tuple[str, ...] = ()
    unique: bool = False
    fine: bool = False
    curve: bool = False

    @property
    def order(self) -> list[str]:
        return [self.partition, *self.cluster] if self.partition else list(self.cluster)

    @property
    def together(self) -> list[str]:
        return self.order if self.fine or not self.partition else [self.partition]


# Partition and cluster columns of the tables, in load order.
STANDARD = {
    "dim_matches": Layout("match_date", ("season_year", "match_winner")),
    "dim_teams": Layout(cluster=("team_name",), unique=True),
    "dim_players": Layout(cluster=("player_name",), unique=True),
    "dim_seasons": Layout(cluster=("season_year",), unique=True),
    "fact_deliveries": Layout(cluster=("batting_team", "bowling_team")),
    "batting_stats": Layout(cluster=("batsman", "season"), unique=True),
    "bowling_stats": Layout(cluster=("bowler", "season"), unique=True),
}

# The alternative: folders by season, rows by team. Fewer and larger folders
# than one per day, and the filters of the season reports prune them.
BY_SEASON = STANDARD | {
    "dim_matches": Layout("season_year", ("team1", "team2")),
    "fact_deliveries": Layout("season", ("batting_team", "bowling_team"), fine=True),
}


# Rows by both teams alike: files hold few pairs of batting and bowling team, and a filter on either
# column, or on both, skips most of them.
BY_CURVE = STANDARD | {
    "dim_matches": Layout(cluster=("season_year", "match_winner"), curve=True),
    "fact_deliveries": Layout(cluster=("batting_team", "bowling_team"), curve=True),
}


def _cuts(df: DataFrame, columns: tuple[str, ...]) -> dict[str, list]:
    """Values that cut each column into ranges of about as many rows, fewer if it has fewer values.

    The rows looked at are picked by a hash of these columns, some of every value that holds many.
    """
    count = df.count()
    part = F.pmod(F.xxhash64(*columns, F.monotonically_increasing_id()), F.lit(max(count, 1)))
    rows = df.select(*columns).where(part < CURVE_SAMPLE).limit(2 * CURVE_SAMPLE).collect()
    cuts = {}
    for c in columns:
        values = sorted(r[c] for r in rows if r[c] is not None)
        at = [values[len(values) * i // (1 << CURVE_BITS)] for i in range(1, 1 << CURVE_BITS)] if values else []
        cuts[c] = sorted({*at, *values[:1]}) if len(set(values)) > 1 << CURVE_BITS else sorted(set(values))
    return cuts


def curve_key(cuts: dict[str, list]) -> Column:
    """Place of a row on the curve: the bits of its columns' ranges in turn, the highest first."""

    def code(c: str, values: list) -> Column:
        bounds = [F.lit(v) for v in values[: (1 << CURVE_BITS) - 1]]
        return F.size(F.filter(F.array(*bounds), lambda b: b <= F.col(c))) if bounds else F.lit(0)

    codes = [code(c, values) for c, values in cuts.items()]
    key = F.lit(0).cast("long")
    for bit in range(CURVE_BITS - 1, -1, -1):
        for code in codes:
            key = F.shiftleft(key, 1).bitwiseOR(F.shiftright(code, bit).bitwiseAND(F.lit(1)).cast("long"))
    return key


def _along_curve(df: DataFrame, layout: Layout) -> DataFrame:
    """Ranges of the curve, each in files of its own; a place that holds very many rows is cut by their hash.

    Reads ``df`` for a count, for a sample, for the bounds of the ranges and for the rows.
    """
    folder = [layout.partition] if layout.partition else []
    placed = df.withColumn("_place", curve_key(_cuts(df, layout.cluster)))
    spread = placed.repartitionByRange(*folder, "_place", F.xxhash64(*df.columns))
    return spread.sortWithinPartitions(*folder, "_place", *layout.cluster).drop("_place")


def arranged(df: DataFrame, layout: Layout) -> DataFrame:
    """``df`` spread over tasks and sorted as ``layout`` asks, ready to be written.

    Rows are brought together by their folder or cluster values and adaptive
    execution evens out the result: it splits the tasks of a value that holds
    very many rows and merges small ones, so one hot day or pairing becomes many
    files of normal size. Where the cluster columns identify a row there are no
    hot values, and ranges give every file its own stretch of the order.
    """
    if not layout.order:
        return df
    if layout.curve:
        return _along_curve(df, layout)
    if layout.unique and not layout.partition:
        spread = df.repartitionByRange(*layout.cluster)
    else:
        spread = df.hint("rebalance", *layout.together)
    return spread.sortWithinPartitions(*layout.order)
