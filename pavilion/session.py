"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Runtime re-planning is what sizes shuffles, splits hot join partitions and
# balances files before a write, so the package asks for it explicitly.
# Shuffle width is deliberately absent: it belongs to the cluster, see README.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def open_session(app: str = "pavilion", master: str | None = None, **settings) -> SparkSession:
    """Get or create a session with the settings above, then ``settings`` on top.

    Keyword names use ``__`` for dots: ``spark__sql__shuffle__partitions=2000``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    overrides = {name.replace("__", "."): value for name, value in settings.items()}
    for name, value in {**SETTINGS, **overrides}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    Only a local session may fall back to a temporary folder of this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="pavilion-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch(spark: SparkSession, name: str) -> str:
    """A path for this application's intermediate files, below the shared folder."""
    return f"{shared_folder(spark)}/pavilion-{spark.sparkContext.applicationId}/{name}"


def pinned(df: DataFrame) -> DataFrame:
    """``df`` written once to reliable storage and read back from there.

    Later jobs see exactly these rows in exactly these partitions, whatever
    executor is lost in between.
    """
    spark = df.sparkSession
    folder = shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


@contextmanager
def _settings(spark: SparkSession, **values: str | int) -> Iterator[None]:
    """Within this block, these settings; names have ``__`` for dots."""
    names = {name.replace("__", "."): value for name, value in values.items()}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def few_folders(spark: SparkSession):
    """Within this block, a task writes to its few folders side by side, without sorting its rows first."""
    return _settings(spark, spark__sql__maxConcurrentOutputFileWriters=4)


@contextmanager
def many_folders(spark: SparkSession) -> Iterator[None]:
    """Within this block, share the work on partition folders between the cores.

    A table may have thousands of day folders. By default each one is listed by
    a task of its own, which costs more than the listing, while little data goes
    to a single writing task however many files that task has to open.
    """
    listing = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    smallest_task = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    cores = min(int(spark.conf.get(listing)), spark.sparkContext.defaultParallelism)
    with _settings(spark, **{listing: cores, smallest_task: "64k"}):
        yield


_SHIPPED = "_pavilion_code_shipped"


def ship_code(spark: SparkSession) -> None:
    """Give the executors' Python this package, once per application.

    They need not have it installed, nor see the driver's folders.
    """
    context = spark.sparkContext
    if getattr(context, _SHIPPED, False):
        return
    folder = tempfile.mkdtemp(prefix="pavilion-code-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    root = Path(__file__).parent
    archive = f"{folder}/pavilion_code.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, str(Path(root.name) / path.relative_to(root)))
    context.addPyFile(archive)
    setattr(context, _SHIPPED, True)
