"""Intermediate results in the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from pavilion.session import scratch


def new_folder(spark: SparkSession, name: str) -> str:
    """An unused path in the shared folder, removed when the application ends."""
    path = f"{scratch(spark, 'llm')}/{name}-{uuid.uuid4().hex[:12]}"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back.

    Later steps read exactly these rows, whatever executor is lost in between,
    and plan with their true size. ``options`` are those of the Parquet writer.
    """
    spark, path = df.sparkSession, new_folder(df.sparkSession, name)
    df.write.options(compression="zstd", **options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *wanted: str) -> list[str]:
    """Names like ``wanted`` that clash with no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    names = []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        names.append(name)
    return names
