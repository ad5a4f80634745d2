"""Table writers and the scored-row log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def append_stream(
    df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", merge_schema: bool = True, available_now: bool = False, partition_by: str | None = None
) -> StreamingQuery:
    """Starts an append-only, checkpointed write. ``available_now`` stops after the data at hand.

    With Parquet, added columns are merged on read (``read_evolving``); Delta merges them on write.
    """
    writer = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if merge_schema and fmt == "delta":
        writer = writer.option("mergeSchema", "true")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    """Parquet table whose files may differ in added columns."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def write_measurement_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Persists the joined table, one folder per lookback window.

    The rows are dealt by conversion first, so later per-conversion work finds them together. Adaptive execution evens
    the parts out by their measured sizes: small ones are merged, that of a hot conversion is split as often as it takes.
    """
    df.hint("rebalance", "conversion_id").write.mode(mode).partitionBy("lookback_days").parquet(path)


def append_scored(df: DataFrame, path: str, reset: bool = False) -> str:
    """Appends scored rows and returns the path written.

    If the columns differ from the log's, ``reset`` starts the log anew as the original service does;
    otherwise the rows go to a new versioned path beside it and the old log is kept.
    """
    spark = df.sparkSession
    existing = _columns(spark, path)
    if existing is None or existing == df.columns:
        df.write.mode("append").parquet(path)
        return path
    if reset:
        df.write.mode("overwrite").parquet(path)
        return path
    version = 2
    while (found := _columns(spark, f"{path}_v{version}")) is not None and found != df.columns:
        version += 1
    df.write.mode("append").parquet(f"{path}_v{version}")
    return f"{path}_v{version}"


def _columns(spark: SparkSession, path: str) -> list[str] | None:
    jvm = spark.sparkContext._jvm
    location = jvm.org.apache.hadoop.fs.Path(path)
    if not location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(location):
        return None
    return spark.read.parquet(path).columns
