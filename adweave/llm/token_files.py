"""Token ids as Parquet list columns (operator 10).

One row per document: id, number of tokens, place in the file, ids. Rows are in ascending id order over the files.
Ids are dictionary or delta encoded, row groups and pages have set sizes and carry page indexes, so a reader takes
the counts without the ids, or the rows of some ids, from a fraction of the file.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adweave.llm.tokens import encoder, slices, with_end

ENCODINGS = ("dictionary", "delta")


def in_id_order(docs: DataFrame, id_col: str, text_col: str, partitions: int | None = None) -> DataFrame:
    """(id, text) in partitions of ascending ids; equal ids are told apart by a hash of the text, so they can be split."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    keys = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    dealt = rows.repartitionByRange(partitions, *keys) if partitions else rows.repartitionByRange(*keys)
    return dealt.sortWithinPartitions(*keys, "text")


def write_token_ids(
    docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2,
    encoding: str = "dictionary", row_group_bytes: int = 32 << 20, page_bytes: int = 256 << 10, page_rows: int = 2_000,
) -> None:
    """Encodes every text whole and writes (doc_id, part, place, local_start, n_tokens, ids) to ``path``.

    A null or empty text gives only the end id. Rows with equal ids each keep a row, null ids come first; other
    columns are not read. An empty table writes no rows.
    """
    if encoding not in ENCODINGS:
        raise ValueError(f"encoding is one of {ENCODINGS}")

    def encode(batches):
        part, place, start = TaskContext.get().partitionId(), 0, 0
        coder = encoder(tokenizer)
        for batch in batches:
            for rows in slices(batch, "text"):
                ids, counts = with_end(*coder.encode(rows.column("text")), end_id)
                ends = np.cumsum(counts)
                offsets = np.concatenate([[0], ends]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("doc_id"), pa.array(np.full(len(counts), part, np.int32)), pa.array(np.arange(place, place + len(counts))),
                        pa.array(start + ends - counts), pa.array(counts), pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids)),
                    ],
                    names=["doc_id", "part", "place", "local_start", "n_tokens", "ids"],
                )
                place, start = place + len(counts), start + int(ends[-1])

    out = in_id_order(docs, id_col, text_col).mapInArrow(encode, "doc_id long, part int, place long, local_start long, n_tokens long, ids array<int>")
    (
        out.write.option("compression", "zstd").option("parquet.writer.version", "PARQUET_2_0")
        .option("parquet.enable.dictionary#ids.list.element", str(encoding == "dictionary").lower())
        .option("parquet.block.size", row_group_bytes).option("parquet.page.size", page_bytes).option("parquet.page.row.count.limit", page_rows)
        .parquet(path)
    )


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, part, place, start, n_tokens): only the metadata columns are read. ``start`` counts the ids of all documents before."""
    rows = spark.read.parquet(path).select("doc_id", "part", "place", "local_start", "n_tokens")
    parts = rows.groupBy("part").agg(F.sum("n_tokens").alias("held"))  # one row per file
    base = parts.select("part", (F.sum("held").over(Window.orderBy("part")) - F.col("held")).alias("base"))
    return rows.join(base, "part").select("doc_id", "part", "place", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens")


def read_tokens(spark: SparkSession, path: str, ids: list[int] | None = None) -> DataFrame:
    """(doc_id, part, place, ids) of all documents, or of a few ``ids``, which page indexes find without reading the rest."""
    rows = spark.read.parquet(path).select("doc_id", "part", "place", "ids")
    return rows if ids is None else rows.where(F.col("doc_id").isin(ids))


def checksums(tokens: DataFrame) -> DataFrame:
    """(part, place, n_read, ids_crc32) of token rows: crc32 of the ids as little-endian unsigned 32-bit integers."""

    def digest(batches):
        for batch in batches:
            lists = batch.column("ids")
            values = np.ascontiguousarray(lists.flatten().to_numpy(zero_copy_only=False), "<u4")
            ends = np.cumsum([0, *lists.value_lengths().to_numpy(zero_copy_only=False)])
            view = memoryview(values)
            crc = [zlib.crc32(view[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("part"), batch.column("place"), pa.array(np.diff(ends).astype(np.int64)), pa.array(crc, pa.int64())],
                names=["part", "place", "n_read", "ids_crc32"],
            )

    return tokens.select("part", "place", "ids").mapInArrow(digest, "part int, place long, n_read long, ids_crc32 long")


def written_index(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files alone."""
    return read_index(spark, path).join(checksums(read_tokens(spark, path)), ["part", "place"]).select("doc_id", "start", F.col("n_read").alias("n_tokens"), "ids_crc32")
