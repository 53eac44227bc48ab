"""The match dimension and the delivery fact in SQL, created from raw tables.

The raw tables hold text without repeats, and the deliveries carry their season. Their
text becomes values by the same expressions as everywhere else, and rows without a key
are left out, so that the results equal `dimensions.matches` and `facts.deliveries`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from pavilion import schemas
from pavilion.operators import cleansing
from pavilion.plans import dimensions
from pavilion.schemas import quoted
from pavilion.session import many_folders
from pavilion.sinks.layout import STANDARD

MATCHES = f"SELECT {', '.join(schemas.columns('dim_matches'))} FROM {{matches}}"

DELIVERIES = f"""
    SELECT {", ".join(schemas.columns("fact_deliveries"))}
    FROM (
        SELECT *,
               if(batsman_runs IN (4, 6), 1, 0) AS is_boundary,
               if(batsman_runs = 4, 1, 0) AS is_four,
               if(batsman_runs = 6, 1, 0) AS is_six,
               if(total_runs = 0, 1, 0) AS is_dot_ball,
               if(player_dismissed IS NULL, 0, 1) AS is_wicket
        FROM {{deliveries}}
    )
"""


def matches(raw_matches: DataFrame) -> DataFrame:
    rows = dimensions.match_rows(cleansing.typed_matches(raw_matches))
    return raw_matches.sparkSession.sql(MATCHES, matches=rows)


def deliveries(raw_deliveries: DataFrame) -> DataFrame:
    rows = cleansing.typed_deliveries(raw_deliveries)
    return raw_deliveries.sparkSession.sql(DELIVERIES, deliveries=rows)


def _create(database: str, table: str, rows: DataFrame) -> None:
    layout = STANDARD[table]
    folders = f"PARTITIONED BY ({quoted(layout.partition)})" if layout.partition else ""
    spread = ", ".join(map(quoted, layout.together))
    with many_folders(rows.sparkSession):
        rows.sparkSession.sql(
            f"CREATE TABLE IF NOT EXISTS {quoted(database, table)} USING PARQUET {folders} AS "
            f"SELECT /*+ REBALANCE({spread}) */ * FROM {{rows}} SORT BY {', '.join(map(quoted, layout.order))}",
            rows=rows,
        )


def create_matches(database: str, raw_matches: DataFrame) -> None:
    """Create the laid-out match dimension; an existing table is left alone."""
    _create(database, "dim_matches", matches(raw_matches))


def create_deliveries(database: str, raw_deliveries: DataFrame) -> None:
    """Create the laid-out delivery fact; an existing table is left alone."""
    _create(database, "fact_deliveries", deliveries(raw_deliveries))
