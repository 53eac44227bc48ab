"""The test tables seen as raw match and delivery files.

One match per order, one delivery per line item, every column as text. Rows
whose key ends in 7 come twice, so that deduplication has work to do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The mapping, as SQL that Spark and the oracle both accept.
_HOME = "concat('T', cast(o_custkey % 10 as string))"
_AWAY = "concat('T', cast((o_custkey + 1 + o_orderkey % 9) % 10 as string))"
_OUT = "l_returnflag = 'R' and l_quantity <= 10"
_RUNS = "cast(l_quantity as int) % 7"
_EXTRA = "case when l_discount >= 0.09 then 1 else 0 end"

MATCHES = {
    "id": "cast(o_orderkey as string)",
    "season": "cast(year(o_orderdate) as string)",
    "city": "n_name",
    "venue": "c_mktsegment",
    "date": "cast(cast(o_orderdate as date) as string)",
    "team1": _HOME,
    "team2": _AWAY,
    "toss_winner": f"case when o_orderpriority in ('1-URGENT', '2-HIGH') then {_HOME} else {_AWAY} end",
    "toss_decision": "case when o_orderkey % 3 = 0 then 'bat' else 'field' end",
    "winner": f"case when o_orderstatus = 'F' then {_HOME} when o_orderstatus = 'O' then {_AWAY} end",
    "win_by_runs": "case when o_orderstatus = 'F' then cast(o_custkey % 50 as string) else '0' end",
    "win_by_wickets": "case when o_orderstatus = 'O' then cast(o_custkey % 10 as string) else '0' end",
    "player_of_match": "case when o_orderstatus <> 'P' then concat('S', cast(o_orderkey % 37 as string)) end",
}

DELIVERIES = {
    "match_id": "cast(l_orderkey as string)",
    "inning": "case when l_linenumber <= 4 then '1' else '2' end",
    "batting_team": "concat('T', cast(l_suppkey % 10 as string))",
    "bowling_team": "concat('T', cast((l_suppkey + 1 + l_partkey % 9) % 10 as string))",
    "over": "cast(l_linenumber as string)",
    "ball": "cast(l_partkey % 6 + 1 as string)",
    "batsman": "concat('S', cast(l_suppkey as string))",
    "non_striker": "concat('S', cast((l_suppkey + 1) % 10 as string))",
    "bowler": "case when l_partkey % 97 <> 0 then concat('S', cast(l_partkey % 100 as string)) end",
    "batsman_runs": f"cast({_RUNS} as string)",
    "extra_runs": f"cast({_EXTRA} as string)",
    "total_runs": f"cast({_RUNS} + {_EXTRA} as string)",
    "player_dismissed": f"case when {_OUT} then concat('S', cast(l_suppkey as string)) end",
    "dismissal_kind": (
        f"case when {_OUT} then case when l_tax < 0.03 then 'bowled' "
        "when l_tax < 0.06 then 'caught' else 'run out' end end"
    ),
}


def _with_repeats(df: DataFrame, key: str) -> DataFrame:
    """``df`` and once more its rows whose ``key`` ends in 7, in one scan."""
    once, twice = F.array(F.lit(0)), F.array(F.lit(0), F.lit(1))
    copies = F.when(F.col(key).cast("string").endswith("7"), twice).otherwise(once)
    return df.withColumn("copy", F.explode(copies)).drop("copy")


def _mapped(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.select(*[F.expr(sql).alias(name) for name, sql in mapping.items()])


def raw_matches(spark: SparkSession, folder: str) -> DataFrame:
    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}.parquet")

    places = table("customer").join(
        table("nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left"
    )
    played = _with_repeats(table("orders"), "o_orderkey").join(
        places, F.col("o_custkey") == F.col("c_custkey"), "left"
    )
    return _mapped(played, MATCHES)


def raw_deliveries(spark: SparkSession, folder: str) -> DataFrame:
    balls = spark.read.parquet(f"{folder}/lineitem.parquet")
    return _mapped(_with_repeats(balls, "l_orderkey"), DELIVERIES)


# What careless writers of CSV files do to the raw text, as SQL that both engines accept.
# Numbers with a fraction, unpadded dates, words for no value, keys that are none.
_ID, _MATCH = "cast(id as bigint)", "cast(match_id as bigint)"
_SLOPPY_DATE = (
    "concat(substr(date, 1, 5), cast(cast(substr(date, 6, 2) as int) as string), '-', "
    "cast(cast(substr(date, 9, 2) as int) as string))"
)
SLOPPY_MATCHES = {name: name for name in MATCHES} | {
    "id": f"case when {_ID} % 11 = 3 then concat(id, '.0') when {_ID} % 17 = 5 then concat(id, '.5') "
    f"when {_ID} % 19 = 7 then 'NA' else id end",
    "date": f"case when {_ID} % 23 = 0 then 'unknown' when {_ID} % 5 = 0 then {_SLOPPY_DATE} else date end",
    "winner": "coalesce(winner, 'NA')",
    "win_by_runs": f"case when {_ID} % 7 = 0 then concat(win_by_runs, '.0') when {_ID} % 13 = 0 then 'NA' else win_by_runs end",
}
SLOPPY_DELIVERIES = {name: f'"{name}"' for name in DELIVERIES} | {
    "match_id": f"case when {_MATCH} % 11 = 3 then concat(match_id, '.0') when {_MATCH} % 17 = 5 and inning = '2' "
    f"then concat(match_id, '.5') when {_MATCH} % 19 = 8 then concat('A', match_id) else match_id end",
    "batsman_runs": "case when ball = '1' then concat(batsman_runs, '.0') when ball = '6' and inning = '2' then 'x' "
    "else batsman_runs end",
    "total_runs": "case when ball = '5' then concat(total_runs, '.7') else total_runs end",
    "player_dismissed": "coalesce(player_dismissed, 'NA')",
}
# Faults of a line, and the rows that have them.
MATCH_FAULTS = {
    "too many fields": f"{_ID} % 29 = 1",
    "too few fields": f"{_ID} % 29 = 2",
    "unclosed quote": f"{_ID} % 29 = 4",
}
DELIVERY_FAULTS = {
    "too many fields": f"{_MATCH} % 31 = 1 and ball = '2'",
    "too few fields": f"{_MATCH} % 31 = 1 and ball = '3'",
    "unclosed quote": f"{_MATCH} % 31 = 1 and ball = '4'",
}
# What the last column comes out as: a short line has none, an unclosed quote this text.
OPEN = "open"


def sloppy_lines(raw: DataFrame, columns: dict[str, str], faults: dict[str, str]) -> DataFrame:
    """Lines of a CSV file with such text and such faults; the column's name is the header."""
    *most, last = columns
    text = [F.coalesce(F.expr(sql.replace('"', "`")), F.lit("")).alias(c) for c, sql in columns.items()]
    wrong = F.lit(None).cast("string")
    for fault, rows in faults.items():
        wrong = F.coalesce(wrong, F.when(F.expr(rows), F.lit(fault)))
    row = raw.select(*text, wrong.alias("_wrong"))
    line = F.concat_ws(",", *most)
    ends = {
        "too many fields": F.concat(F.col(last), F.lit(",EXTRA,MORE")),
        "unclosed quote": F.lit(f'"{OPEN}'),
    }
    end = F.col(last)
    for fault, text in ends.items():
        end = F.when(F.col("_wrong") == fault, text).otherwise(end)
    whole = F.when(F.col("_wrong") == "too few fields", line).otherwise(F.concat(line, F.lit(","), end))
    return row.select(whole.alias(",".join(columns)))
