"""Texts in chunks, and questions that every chunk puts to tables of hashes spread over the cluster.

A chunk is a few megabytes of whole documents, written once with a chunk id and bucketed by it. An operator asks about
the hashes of a chunk in three steps: each chunk sends its distinct hashes as sorted, delta-coded lists, one for each
hash range; the task of a range merges the lists of all chunks and answers each list with one value per entry; the
answers of a chunk meet its texts again in a join that moves only the answers, as the texts are bucketed already. A
hash takes 4 to 6 bytes on the way instead of a row, appears once per chunk however often it occurs in it, and no
position or text is moved. At any size there are at most as many lists as hashes, so it degrades to a plain shuffle.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adweave.llm.common import saved
from adweave.llm.tokens import slices

CHUNK_BYTES = 12 << 20  # text of a chunk (a longer document is a chunk by itself)
RANGE_BYTES = 4 << 20  # text bytes for which one more hash range is made

_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95))  # odd, so they have inverses modulo 2^64
_POWERS: dict = {}


@dataclass(frozen=True)
class Chunks:
    rows: DataFrame  # chunk, doc_id, text and what else was asked for
    ranges: int
    name: str

    def drop(self) -> None:
        """Removes the written chunks; only after all results read from them are written."""
        self.rows.sparkSession.sql(f"DROP TABLE IF EXISTS {self.name}")


def in_chunks(docs: DataFrame, id_col: str, text_col: str, more: tuple[F.Column, ...] = (), chunk_bytes: int = CHUNK_BYTES) -> Chunks:
    """Writes (chunk, doc_id, text, …) bucketed by chunk to the warehouse; ``more`` are named text columns to keep."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *more)
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    names = ["chunk", *rows.columns]

    def number(batches):
        chunk, held = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            for part in slices(batch, "text", chunk_bytes):
                size = pc.sum(pc.binary_length(part.column("text"))).as_py() or 0
                if held and held + size > chunk_bytes:
                    chunk, held = chunk + 1, 0
                held += size
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), chunk)), *part.columns], names=names)

    name = f"llm_chunks_{uuid.uuid4().hex}"
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * total // chunk_bytes)
    chunks = rows.mapInArrow(number, "chunk long, " + ", ".join(f"{n} {kind}" for n, kind in rows.dtypes))
    chunks.write.option("compression", "zstd").bucketBy(buckets, "chunk").saveAsTable(name)
    return Chunks(spark.table(name), max(8, total // RANGE_BYTES), name)


def answered(lists: DataFrame, merge, name: str, more: str = "") -> DataFrame:
    """(chunk, range, answer) for lists (range, chunk, …): ``merge`` turns the lists of a range into one answer each.

    With the schema of ``more`` columns, ``merge`` gives (answers, {column: values}).
    """

    def of_range(table: pa.Table) -> pa.Table:
        answers, extra = merge(table) if more else (merge(table), {})
        return pa.table({"chunk": table["chunk"], "range": table["range"], "answer": pa.array(answers, pa.binary()), **extra})

    return saved(lists.groupBy("range").applyInArrow(of_range, "chunk long, range int, answer binary" + more), name)


def with_answers(chunks: Chunks, answers: DataFrame, work, schema: str) -> DataFrame:
    """``work(rows, answers)`` for each chunk; a chunk without answers gets an empty table, answers without a chunk none."""

    def of_chunk(rows: pa.Table, found: pa.Table) -> pa.Table:
        return work(in_order(rows), found)

    return chunks.rows.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(of_chunk, schema)


def in_order(rows: pa.Table) -> pa.Table:
    """The rows of a chunk in one order, whatever order they were read in; rows alike in id and text are interchangeable."""
    return rows.combine_chunks().sort_by([("doc_id", "ascending"), ("text", "ascending")])


# --- words and windows


@dataclass
class Words:
    offsets: np.ndarray  # of the documents' first words, and the end
    table: np.ndarray  # 2 x 64 bits for each distinct word
    at: np.ndarray  # the row of ``table`` of each word
    flat: pa.Array  # the words

    def lane(self, k: int) -> np.ndarray:
        """64 bits for each word."""
        return np.ascontiguousarray(self.table[:, k])[self.at]

    @property
    def ends(self) -> np.ndarray:
        """For each word the end of its document."""
        return np.repeat(self.offsets[1:], np.diff(self.offsets))


def words_of(texts, lower: bool = False) -> Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the texts; null texts have none. ``lower`` folds A-Z only."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
        texts = texts.chunk(0) if isinstance(texts, pa.ChunkedArray) else texts
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if lower:  # a slice is copied first: ascii_lower takes wrong bytes if the first offset is not 0
        texts = pc.ascii_lower(texts.take(pa.array(np.arange(len(texts)))))
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.flatten()
    full = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0
    bounds = lists.offsets.to_numpy().astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(full)])[bounds - bounds[0]]
    flat = flat.filter(pa.array(full))
    coded = flat.dictionary_encode()
    digests = b"".join(map(xxhash.xxh3_128_digest, coded.dictionary.cast(pa.large_binary()).to_pylist()))
    return Words(offsets, np.frombuffer(digests, "<u8").reshape(-1, 2), coded.indices.to_numpy(zero_copy_only=False), flat)


def _powers(lane: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    if lane not in _POWERS or len(_POWERS[lane][0]) < n:
        base = _BASES[lane]
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        size = max(n, 1 << 16)
        made = []
        for b in (base, inverse):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            made.append(np.cumprod(p, dtype=np.uint64))
        _POWERS[lane] = tuple(made)
    return _POWERS[lane][0][:n], _POWERS[lane][1][:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads their bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Windows:
    """Hashes of word windows by prefix sums: a window of any length costs one subtraction and one product.

    Only the lanes asked for are built.
    """

    def __init__(self, words: Words, lanes: int = 2):
        n = len(words.at)
        self.n = n
        self.sums, self.inverse = [], []
        for lane in range(lanes):
            power, inverse = _powers(lane, n + 1)
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(words.lane(lane) * power[:n], out=sums[1:])
            self.sums.append(sums)
            self.inverse.append(inverse)

    def at(self, starts: np.ndarray, length, lane: int = 0) -> np.ndarray:
        return mixed((self.sums[lane][starts + length] - self.sums[lane][starts]) * self.inverse[lane][starts])


# --- sorted lists of hashes


def runs(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, run of each ordered entry, first of each run) for equal keys; the first key orders first."""
    order = np.argsort(keys[0], kind="stable") if len(keys) == 1 else np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in keys:
        k = key[order]
        new[1:] |= k[1:] != k[:-1]
    return order, np.cumsum(new) - 1, np.flatnonzero(new)


def range_of(values: np.ndarray, bits: int, ranges: int) -> np.ndarray:
    """Hash range of values of ``bits`` bits, ascending with the value."""
    return ((values >> np.uint64(bits - 32)) * np.uint64(ranges)) >> np.uint64(32)


def cut_points(values: np.ndarray, bits: int, ranges: int) -> tuple[np.ndarray, np.ndarray]:
    """(range ids, bounds) of the stretches of a sorted list."""
    owner = range_of(values, bits, ranges)
    starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else np.empty(0, np.int64)
    return owner[starts].astype(np.int32), np.concatenate([starts, [len(owner)]])


def planes(values: np.ndarray, width: int) -> bytes:
    """Integers as byte planes, so that the empty high bytes of small values compress to nothing."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def from_planes(data: bytes, width: int) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8).reshape(width, -1)
    out = np.zeros((raw.shape[1], 8), np.uint8)
    out[:, :width] = raw.T
    return out.view("<u8").ravel()


def coded(values: np.ndarray, width: int) -> bytes:
    """A sorted list of values of ``width`` bytes as planes of differences."""
    return planes(np.diff(values, prepend=np.uint64(0)), width)


def decoded(data: bytes, width: int) -> np.ndarray:
    return np.cumsum(from_planes(data, width), dtype=np.uint64)


def bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def from_bits(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool)


def gathered(found: pa.Table, starts: np.ndarray, ranges: np.ndarray, read, dtype, phase: int | None = None) -> np.ndarray:
    """The answers to a chunk's lists joined to one array in the order of the lists. ``read(data, n)`` decodes one."""
    answers = {}
    for row in found.to_pylist():
        if phase is None or row["phase"] == phase:
            answers[row["range"]] = row["answer"]
    parts = [read(answers[int(r)], int(b - a)) for r, a, b in zip(ranges, starts[:-1], starts[1:], strict=True)]
    return np.concatenate(parts) if parts else np.empty(0, dtype)
