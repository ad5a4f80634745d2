"""Exact repeated passages by fixed-block anchors (operator 1).

A window of ``window`` words holds a whole block of ``(window + 1) // 2`` words at a multiple of the block length in
its document. These blocks are the index; every rolling window of the block length probes it. A window that is
repeated has its anchor block hit by a probe elsewhere, so hits are extended to the windows around hit anchors, and
these candidates are settled by 96 bits of their whole word sequence. What the repeated windows cover are the maximal
exact repeats. Probe hashes have 48 bits and only choose candidates.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adweave.llm import chunks as C
from adweave.llm.common import saved

_LANE2 = 0xFFFFFFFF


class _Probes:
    """The rolling block windows of a chunk and its distinct hashes."""

    def __init__(self, rows: pa.Table, window: int, ranges: int):
        self.words = C.words_of(rows["text"])
        self.hashes = C.Windows(self.words)
        self.window, self.block, self.ranges = window, (window + 1) // 2, ranges
        ends, place = self.words.ends, np.arange(self.hashes.n)
        first = np.repeat(self.words.offsets[:-1], np.diff(self.words.offsets))
        self.at = np.flatnonzero(place + self.block <= ends)
        self.anchor = (self.at - first[self.at]) % self.block == 0
        self.full = place + window <= ends
        values = self.hashes.at(self.at, self.block) >> np.uint64(16)
        order, run, starts = C.runs(values)
        self.run = np.empty(len(order), np.int64)
        self.run[order] = run
        self.distinct = values[order[starts]]
        self.counts = np.diff(np.concatenate([starts, [len(order)]]))
        self.range_ids, self.bounds = C.cut_points(self.distinct, 48, ranges)

    def lists(self, chunk: int) -> list[dict]:
        anchored = np.zeros(len(self.distinct), bool)
        anchored[self.run[self.anchor]] = True
        return [
            {"range": int(r), "chunk": chunk, "size": int(b - a), "hashes": C.coded(self.distinct[a:b], 6), "again": C.bits(self.counts[a:b] > 1), "anchored": C.bits(anchored[a:b])}
            for r, a, b in zip(self.range_ids, self.bounds[:-1], self.bounds[1:], strict=True)
        ]

    def candidates(self, found: pa.Table):
        """(starts, distinct keys, run of each start) of the windows with a hit anchor."""
        hit = C.gathered(found, self.bounds, self.range_ids, C.from_bits, bool, phase=1)
        struck = np.zeros(self.hashes.n + 1, np.int64)
        struck[self.at[self.anchor & hit[self.run]] + 1] = 1
        struck = np.cumsum(struck)
        starts = np.flatnonzero(self.full)
        starts = starts[struck[starts + self.window - self.block + 1] > struck[starts]]
        first = self.hashes.at(starts, self.window)
        second = self.hashes.at(starts, self.window, lane=1) & np.uint64(_LANE2)
        order, run, begin = C.runs(first, second)
        back = np.empty(len(order), np.int64)
        back[order] = run
        self.keys = first[order[begin]], second[order[begin]], np.diff(np.concatenate([begin, [len(order)]]))
        self.key_ranges, self.key_bounds = C.cut_points(self.keys[0], 64, self.ranges)
        return starts, back

    def removed(self, found: pa.Table) -> np.ndarray:
        """Flags of the words that repeated windows cover."""
        starts, back = self.candidates(found)
        repeated = C.gathered(found, self.key_bounds, self.key_ranges, C.from_bits, bool, phase=2)
        starts = starts[repeated[back]] if len(starts) else starts
        depth = np.zeros(self.hashes.n + 1, np.int64)
        np.add.at(depth, starts, 1)
        np.add.at(depth, starts + self.window, -1)
        return np.cumsum(depth)[:-1] > 0


def _merge_probes(table: pa.Table) -> list[bytes]:
    """A probe hash is hit if it occurs twice at least, once of them as an anchor."""
    rows = table.select(["size", "hashes", "again", "anchored"]).to_pylist()
    values = np.concatenate([C.decoded(r["hashes"], 6) for r in rows])
    times = np.concatenate([1 + C.from_bits(r["again"], r["size"]) for r in rows])
    anchored = np.concatenate([C.from_bits(r["anchored"], r["size"]) for r in rows])
    order, run, starts = C.runs(values)
    hit = (np.add.reduceat(times[order].astype(np.int64), starts) > 1) & np.logical_or.reduceat(anchored[order], starts)
    flags = np.empty(len(values), bool)
    flags[order] = hit[run]
    return _cut(flags, rows)


def _merge_windows(table: pa.Table) -> list[bytes]:
    rows = table.select(["size", "hashes", "second", "again"]).to_pylist()
    first = np.concatenate([C.decoded(r["hashes"], 8) for r in rows])
    second = np.concatenate([C.from_planes(r["second"], 4) for r in rows])
    times = np.concatenate([1 + C.from_bits(r["again"], r["size"]) for r in rows])
    order, run, starts = C.runs(first, second)
    flags = np.empty(len(first), bool)
    flags[order] = (np.add.reduceat(times[order].astype(np.int64), starts) > 1)[run]
    return _cut(flags, rows)


def _cut(flags: np.ndarray, rows: list[dict]) -> list[bytes]:
    ends = np.cumsum([r["size"] for r in rows])
    return [C.bits(flags[b - r["size"] : b]) for b, r in zip(ends.tolist(), rows, strict=True)]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text, spans): every word in a window that also starts elsewhere is removed.

    ``spans`` are the maximal removed runs as (start, length) in words; ``kept_text`` joins the kept words by one space.
    Windows are judged on the input. Every row is a document of its own, equal ids and equal rows too. A null or empty
    text has no words and stays empty; a text shorter than a window loses nothing. Other columns are not read. An
    empty table gives no rows.
    """
    chunks = C.in_chunks(docs, id_col, text_col)
    ranges = chunks.ranges

    def ask_probes(rows: pa.Table) -> pa.Table:
        lists = _Probes(C.in_order(rows), window, ranges).lists(rows["chunk"][0].as_py())
        return pa.Table.from_pylist(lists, schema=pa.schema([("range", pa.int32()), ("chunk", pa.int64()), ("size", pa.int32()), ("hashes", pa.binary()), ("again", pa.binary()), ("anchored", pa.binary())]))

    lists = chunks.rows.groupBy("chunk").applyInArrow(ask_probes, "range int, chunk long, size int, hashes binary, again binary, anchored binary")
    hits = C.answered(lists, _merge_probes, "probe-hits").withColumn("phase", F.lit(1))

    def ask_windows(rows: pa.Table, found: pa.Table) -> pa.Table:
        made = []
        if len(rows):
            probes = _Probes(rows, window, ranges)
            probes.candidates(found)
            first, second, counts = probes.keys
            chunk = rows["chunk"][0].as_py()
            made = [
                {"range": int(r), "chunk": chunk, "size": int(b - a), "hashes": C.coded(first[a:b], 8), "second": C.planes(second[a:b], 4), "again": C.bits(counts[a:b] > 1)}
                for r, a, b in zip(probes.key_ranges, probes.key_bounds[:-1], probes.key_bounds[1:], strict=True)
            ]
        return pa.Table.from_pylist(made, schema=pa.schema([("range", pa.int32()), ("chunk", pa.int64()), ("size", pa.int32()), ("hashes", pa.binary()), ("second", pa.binary()), ("again", pa.binary())]))

    lists = C.with_answers(chunks, hits, ask_windows, "range int, chunk long, size int, hashes binary, second binary, again binary")
    repeats = C.answered(lists, _merge_windows, "repeats").withColumn("phase", F.lit(2))

    def keep(rows: pa.Table, found: pa.Table) -> pa.Table:
        probes = _Probes(rows, window, ranges)
        gone = probes.removed(found)
        offsets = probes.words.offsets
        kept_before = np.concatenate([[0], np.cumsum(~gone)])
        kept = probes.words.flat.filter(pa.array(~gone))
        texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(kept_before[offsets].astype(np.int32)), kept), pa.scalar(" ", kept.type)).cast(pa.string())
        first = np.zeros(len(gone) + 1, bool)
        first[offsets[:-1]] = True
        begins = np.flatnonzero(gone & (first[:-1] | np.concatenate([[True], ~gone[:-1]])))
        last = np.zeros(len(gone) + 1, bool)
        last[offsets[1:]] = True
        stops = np.flatnonzero(gone & (last[1:] | np.concatenate([~gone[1:], [True]]))) + 1
        owner = np.searchsorted(offsets, begins, side="right") - 1
        span_offsets = np.searchsorted(owner, np.arange(len(rows) + 1))
        spans = pa.StructArray.from_arrays([pa.array(begins - offsets[owner]), pa.array(stops - begins)], names=["start", "length"])
        return pa.table({
            "doc_id": rows["doc_id"], "n_words": pa.array(np.diff(offsets)), "n_removed": pa.array(np.diff(offsets) - np.diff(kept_before[offsets])),
            "kept_text": texts, "spans": pa.ListArray.from_arrays(pa.array(span_offsets.astype(np.int32)), spans),
        })

    schema = "doc_id long, n_words long, n_removed long, kept_text string, spans array<struct<start: long, length: long>>"
    kept = saved(C.with_answers(chunks, hits.unionByName(repeats), keep, schema), "kept")
    chunks.drop()
    return kept
