"""Session defaults and lineage cutting."""

from __future__ import annotations

import gc
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession

# AQE does the run-time work: it coalesces small shuffle partitions, splits skewed join partitions and
# switches to a broadcast join when the measured (not estimated) side is small.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",  # drop checkpoint files nobody refers to
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


_local_folder: tempfile.TemporaryDirectory | None = None


def build_session(app: str = "adweave", master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    """Session with the library defaults; cluster sizing stays with spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by the cluster in ``spark.checkpoint.dir``.

    Only when nothing is configured and the master is local, as in tests, one temporary folder of this process is used;
    it goes when the process ends.
    """
    global _local_folder
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if _local_folder is None:
        _local_folder = tempfile.TemporaryDirectory(prefix="adweave-")
    return _local_folder.name


COLLECT_EVERY_S = 5.0  # short queries are not held up
_collected = 0.0
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"  # Spark 4.1


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of ``df``, so a lost executor costs a re-read and not a re-computation.

    The shuffle files that led to it go at once, and before it is written the files of earlier checkpoints that nothing refers to any
    more: Spark waits with both until the driver's heap fills up, and a query of many steps would keep the files of all.
    """
    global _collected
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(spark))
    if time.monotonic() - _collected > COLLECT_EVERY_S:
        gc.collect()
        context._jvm.System.gc()
        _collected = time.monotonic()
    before = spark.conf.get(SHUFFLES_GO, None)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        return df.select("*").checkpoint(eager=True)  # a query of its own, as ``df`` itself may be read again
    finally:
        if before is None:
            spark.conf.unset(SHUFFLES_GO)
        else:
            spark.conf.set(SHUFFLES_GO, before)
