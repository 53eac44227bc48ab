"""Python code on the executors."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

import pavilion

_ATTRIBUTE = "_pavilion_code_shipped"


def ship_code(spark: SparkSession) -> None:
    """Give the executors this package, once per application.

    Their Python need not have it installed or see the driver's folders.
    """
    context = spark.sparkContext
    if getattr(context, _ATTRIBUTE, False):
        return
    folder = tempfile.mkdtemp(prefix="pavilion-code-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    root = Path(pavilion.__file__).parent
    archive = f"{folder}/pavilion_code.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, str(Path(root.name) / path.relative_to(root)))
    context.addPyFile(archive)
    setattr(context, _ATTRIBUTE, True)


def mapped(df: DataFrame, function, schema: str) -> DataFrame:
    """``function`` over the Arrow batches of each partition of ``df``."""
    ship_code(df.sparkSession)

    def run(batches):
        yield from function(batches)
        # The process stays for other tasks; it need not keep this one's memory.
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def batch(**columns) -> pa.RecordBatch:
    """A record batch from arrays by name."""
    arrays = [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c) for c in columns.values()]
    return pa.RecordBatch.from_arrays(arrays, list(columns))


def lists(values: pa.Array, lengths) -> pa.Array:
    """Consecutive runs of ``values`` as one list each."""
    ends = [0]
    for n in lengths:
        ends.append(ends[-1] + int(n))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
