"""Dense surrogate keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pavilion.session import pinned

# A generated row id holds the partition number above this many low bits and
# the position inside the partition below them.
_POSITION_BITS = 33


def with_dense_key(names: DataFrame, natural: str, key: str) -> DataFrame:
    """Number the distinct, non-NULL values of ``natural`` 1..n in their own order.

    The values are sorted across the cluster by ranges, each row notes its
    partition and position, and the result is pinned to storage. The key is then
    the position plus the number of rows in all earlier partitions. Only that
    list of partition sizes, one row per shuffle partition, is brought together.
    """
    spread = names.select(natural).repartitionByRange(natural).sortWithinPartitions(natural)
    slots = pinned(spread.withColumn("slot", F.monotonically_increasing_id()))
    placed = slots.select(
        natural,
        F.shiftright("slot", _POSITION_BITS).alias("part"),
        F.col("slot").bitwiseAND((1 << _POSITION_BITS) - 1).alias("position"),
    )
    sizes = placed.groupBy("part").agg(F.count("*").alias("rows"))
    earlier = F.sum("rows").over(Window.orderBy("part")) - F.col("rows")
    offsets = sizes.select("part", earlier.alias("before"))
    # Bounded by the number of shuffle partitions, whatever the data size.
    return placed.join(F.broadcast(offsets), "part").select(
        (F.col("before") + F.col("position") + 1).alias(key), natural
    )
