"""Event ingest: source, parse, append."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from adweave import schemas
from adweave.sources.sinks import append_stream


def parse_json_events(df: DataFrame, schema: StructType = schemas.USER_EVENT, value: str = "value") -> DataFrame:
    """Binary or text JSON to flat columns. A malformed value gives a row of nulls, which is kept."""
    return df.select(F.from_json(F.col(value).cast("string"), schema).alias("data")).select("data.*")


def split_malformed(df: DataFrame, schema: StructType = schemas.USER_EVENT, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """(parsed rows, dead letters): the second holds the raw text of values that are no JSON object."""
    text = F.col(value).cast("string")
    parsed = df.select(text.alias("raw"), F.from_json(text, schema).alias("data"), F.try_parse_json(text).isNull().alias("bad"))
    return parsed.where("not bad").select("data.*"), parsed.where("bad").select("raw")


def ingest_stream(
    source: DataFrame, path: str, checkpoint: str, schema: StructType = schemas.USER_EVENT, fmt: str = "parquet", available_now: bool = False
) -> StreamingQuery:
    """Source → parse → append. Restarting with the same checkpoint continues where it stopped."""
    return append_stream(parse_json_events(source, schema), path, checkpoint, fmt, available_now=available_now)
