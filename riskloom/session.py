"""Session helpers: local sessions for tests and benches, and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session with the settings the library expects (UTC, AQE, Arrow)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("riskloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.scheduler.mode", "FAIR")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "12g"))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share, named by ``spark.checkpoint.dir``.

    Only a local session may do without the setting (tests, a bench): its one machine is then the
    place. On a cluster a machine-local folder would be invisible to the executors, so it is an error.
    """
    context = spark.sparkContext
    named = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not context.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="riskloom-")
        context.setCheckpointDir(named)
    return named.rstrip("/")


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the shared one, for a table that a job writes and a later one reads."""
    return f"{shared_root(spark)}/{uuid.uuid4()}"


# rows of a task: at least, while cores are idle, and at most
FEW_ROWS, MANY_ROWS = 10_000, 50_000


def task_count(rows: int, cores: int, few: int = FEW_ROWS, many: int = MANY_ROWS) -> int:
    """Tasks for so many rows: four per core where each still has ``few`` rows, more where they would pass ``many``."""
    return max(1, min(-(-rows // few), max(4 * cores, -(-rows // many))))


def dealt(df: DataFrame, rows: int | None = None, few: int = FEW_ROWS, many: int = MANY_ROWS) -> DataFrame:
    """Rows dealt evenly over tasks by their number.

    Scans and adaptive shuffles cut a table by its bytes, so a table that is small on disk and then becomes wide or
    is expanded would be one task's work. A table that fits one task stays as it is.
    """
    n = task_count(df.count() if rows is None else rows, df.sparkSession.sparkContext.defaultParallelism, few, many)
    return df.repartition(n) if n > 1 else df


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the folder the session names."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_root(df.sparkSession))
    return df.checkpoint(eager=True)
