"""Batch and stream readers. Every reader takes an explicit schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import VectorSlicer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from adweave import schemas


def read_event_stream(
    spark: SparkSession, fmt: str = "kafka", options: Mapping[str, str] | None = None, schema: StructType | None = None, path: str | None = None
) -> DataFrame:
    """Event stream. Kafka starts at the earliest offset unless told otherwise; file formats need a schema.

    Text files give one ``value`` per line, so the parsing step is the same as for Kafka.
    """
    settings = {"startingOffsets": "earliest", **(options or {})} if fmt == "kafka" else dict(options or {})
    reader = spark.readStream.format(fmt).options(**settings)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def read_touch_log(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """Tab-separated touch log with a header, also gzipped; only the six used columns.

    A gzip file cannot be split, so its one task hands the rows on to ``partitions`` tasks, or by a hash of the whole row.
    """
    columns = schemas.TOUCH_RAW.names
    header = spark.read.text(path).limit(1).first()
    names = header[0].split("\t") if header else columns
    full = StructType()
    for n in names:
        full = full.add(n, "string")
    rows = spark.read.option("sep", "\t").option("header", True).schema(full).csv(path).select(*columns)
    if path.endswith(".gz"):
        return rows.repartition(partitions) if partitions else rows.repartition(F.xxhash64(*columns))
    return rows


def read_csv_table(spark: SparkSession, path: str, schema: StructType, sep: str = ",") -> DataFrame:
    """Delimited file with a header; columns are matched by position to ``schema``."""
    return spark.read.option("header", True).option("sep", sep).schema(schema).csv(path)


def read_libsvm(spark: SparkSession, path: str, num_features: int, max_features: int | None = None) -> DataFrame:
    """(label, features) sparse rows, cut to the first ``max_features`` columns."""
    rows = spark.read.format("libsvm").option("numFeatures", str(num_features)).load(path)
    if max_features is None or max_features >= num_features:
        return rows
    cut = VectorSlicer(inputCol="features", outputCol="_cut", indices=list(range(max_features)))
    return cut.transform(rows).select("label", F.col("_cut").alias("features"))


def head_sample(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The first n rows in key order."""
    return df.orderBy(*order).limit(n)


def first_existing(spark: SparkSession, paths: Sequence[str]) -> str:
    """First path that exists on its file system."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        location = jvm.org.apache.hadoop.fs.Path(p)
        if location.getFileSystem(conf).exists(location):
            return p
    raise FileNotFoundError(f"none of these exist: {list(paths)}")
