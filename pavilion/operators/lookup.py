"""Left joins against a table that has one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pavilion.schemas import quoted

# Salts that a key gets for each share of a task that it fills: enough of them that chance
# deals them out evenly.
SPREAD = 64
# Keys looked at as hot ones, and keys that a sketch keeps track of, at most.
HOTTEST, TRACKED = 10_000, 65_536
# Sketches of tasks are put together in so many groups first.
_GROUPS = 64


def hot_keys(rows: DataFrame, key: str, most: int | None = None) -> DataFrame:
    """Keys that would fill more than one task of a shuffle, and ``salts``: how many parts to deal them in.

    Each task counts its keys in a sketch of bounded size that keeps the frequent ones;
    sketches are merged in two steps. A key is hot if its share of the rows is larger
    than that of a task, so there are no more hot keys than shuffle partitions. The
    sketch can miss a key whose share is below one in some ten thousand.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = min(parts, HOTTEST)
    tracked = min(max(1 << (16 * wanted - 1).bit_length(), 64), TRACKED)
    rows = rows.select(key).where(F.col(key).isNotNull())
    by_group = rows.groupBy(F.pmod(F.spark_partition_id(), F.lit(_GROUPS)).alias("g")).agg(
        F.expr(f"approx_top_k_accumulate({quoted(key)}, {tracked})").alias("sketch"), F.count("*").alias("rows")
    )
    # Grouped, if only by a constant: tasks without sketches then have nothing to merge.
    whole = by_group.groupBy(F.lit(0).alias("all")).agg(F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch"), F.sum("rows").alias("rows"))
    found = whole.select("rows", F.expr(f"inline(approx_top_k_estimate(sketch, {wanted}))"))
    share = F.col("count") * parts / F.col("rows")
    salts = F.ceil(share * SPREAD)
    salts = F.least(salts, F.lit(most).cast("long")) if most else salts
    return found.where(share > 1).select(F.col("item").alias(key), salts.cast("int").alias("salts"))


def _is_small(table: DataFrame) -> bool:
    """Will the planner broadcast it, by what it knows now?"""
    limit = table.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if limit.startswith("-"):
        return False
    size = table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= table.sparkSession._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(limit)


def lookup(
    rows: DataFrame, table: DataFrame, key: str, salts: int | None = None, like: DataFrame | None = None
) -> DataFrame:
    """``rows`` left-joined to ``table``, which holds each ``key`` once.

    A table that the planner broadcasts is joined as it is. Otherwise hot keys are
    measured (see `hot_keys`) and only they get salts, as many as their count asks:
    their rows are dealt out by a hash of the rest of the row, and their rows of
    ``table`` alone are repeated that often. All other rows have one salt. Rows without
    a key, which meet nothing, are dealt out too.

    The salted key also makes both sides shuffle for this join alone, and only then can
    adaptive execution split a partition that is still too hot; a table that comes
    straight out of an aggregate on ``key`` would be joined in place and never split.

    ``like`` has the same keys about as often as ``rows`` and is cheaper to read.
    ``salts`` bounds the salts of a key; 0 joins on the plain key: right when ``rows``
    holds a key once too.
    """
    if salts == 0 or _is_small(table):
        return rows.join(table, key, "left")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # At most one row a shuffle partition, and HOTTEST in all.
    hot = F.broadcast(hot_keys(rows if like is None else like, key, salts))
    rest = [F.col(c) for c in rows.columns if c != key]
    pieces = F.when(F.col(key).isNull(), F.lit(parts)).otherwise(F.coalesce("salts", F.lit(1)))
    salt = F.pmod(F.xxhash64(*rest), pieces).cast("int") if rest else F.lit(0)
    dealt = rows.join(hot, key, "left").withColumn("salt", salt).drop("salts")
    each = F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)
    repeated = table.join(hot, key, "left").withColumn("salt", F.explode(each)).drop("salts")
    return dealt.join(repeated, [key, "salt"], "left").drop("salt")


def distinct_lookup(rows: DataFrame, table: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """`lookup` of ``columns`` of ``rows`` without repeated rows, in one shuffle for both. All ``rows`` have a ``key``.

    Copies of a row share its key, so rows brought together by key can drop them and meet
    ``table`` in the same tasks. Keys that would fill more than one task (see `hot_keys`) stay out
    of it, and with them any mass of equal rows: each task drops its own copies of theirs before they
    are dealt out by the whole row, and the rows of ``table`` they meet, one a key, go to all tasks.

    Hot keys are looked for while the plan is built. Where there are some, ``rows`` is read once more.
    """
    if _is_small(table):
        return rows.dropDuplicates().select(*columns).join(table, key, "left")
    # At most one a shuffle partition, and HOTTEST in all.
    hot = [row[0] for row in hot_keys(rows, key).select(key).collect()]
    is_hot = F.col(key).isin(hot)
    together = (rows.where(~is_hot) if hot else rows).repartition(key).dropDuplicates()
    found = together.select(*columns).join(table, key, "left")
    if not hot:
        return found
    spread = rows.where(is_hot).dropDuplicates().select(*columns)
    return found.unionByName(spread.join(F.broadcast(table.where(is_hot)), key, "left"))
