"""Order-preserving packing into fixed windows by dynamic programming (operator 5).

Documents keep their order. The token stream of a partition is cut into windows of at most ``size`` ids; a cut costs
nothing at a document's end, ``sentence_penalty`` at a sentence's end and ``inside_penalty`` elsewhere (allowed every
``grid`` ids), and a window costs its padding. With f(j) the least cost of the first j ids,
f(j) = min over i in [j - size, j) of f(i) + size - (j - i) + penalty(j), so the minimum of f(i) + i over a sliding
window, which a monotone queue yields in constant time per cut.
"""

from __future__ import annotations

import zlib
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adweave.llm.token_files import in_id_order
from adweave.llm.tokens import encoder, slices, with_end

PART_BYTES = 16 << 20  # text bytes of a partition; its last window is the only one that may be far from full
BUFFER_TOKENS = 1_000_000  # ids that a task holds at once


def best_cuts(positions: np.ndarray, penalties: np.ndarray, size: int) -> list[int]:
    """Indexes into ``positions`` (ascending from 0, gaps at most ``size``) of the cheapest cuts, the last position included."""
    pos, pen = positions.tolist(), penalties.tolist()
    keys, back = [0] * len(pos), [0] * len(pos)
    queue = deque([0])
    for j in range(1, len(pos)):
        at = pos[j]
        while pos[queue[0]] < at - size:
            queue.popleft()
        best = queue[0]
        back[j] = best
        key = keys[best] + size + pen[j]  # f(j) + j
        keys[j] = key
        while queue and keys[queue[-1]] >= key:
            queue.pop()
        queue.append(j)
    cuts, j = [], len(pos) - 1
    while j > 0:
        cuts.append(j)
        j = back[j]
    return cuts[::-1]


class _Stream:
    """The documents of a partition as one stream of ids; windows leave it as they are settled."""

    def __init__(self, size: int, grid: int, sentence_penalty: int, inside_penalty: int, ends_sentence: np.ndarray, first_sequence: int):
        self.size, self.grid, self.costs = size, grid, (sentence_penalty, inside_penalty)
        self.ends_sentence, self.sequence = ends_sentence, first_sequence
        self.ids, self.held = [], 0
        self.docs: list[tuple] = []  # (doc_id, ids of the document already given out, its ids in all)

    def add(self, doc_ids: list, ids: np.ndarray, counts: np.ndarray) -> None:
        self.ids.append(ids)
        self.held += len(ids)
        self.docs += [(d, 0, n) for d, n in zip(doc_ids, counts.tolist(), strict=True)]

    def settle(self, last: bool):
        """Rows of the windows that can be settled: all if no more ids follow, else all but the last two."""
        if not self.held:
            return []
        ids = np.concatenate(self.ids)
        left = np.asarray([n - given for _, given, n in self.docs], np.int64)
        ends = np.cumsum(left)
        n = len(ids)
        penalty = np.full(n + 1, -1, np.int64)
        penalty[:: self.grid] = self.costs[1]
        stops = np.flatnonzero(self.ends_sentence[ids]) + 1
        penalty[stops] = self.costs[0]
        penalty[ends] = 0
        penalty[0] = 0
        places = np.flatnonzero(penalty >= 0)
        cuts = places[best_cuts(places, penalty[places], self.size)]
        if not last:
            cuts = cuts[:-2]
        if not len(cuts):
            return []
        upto = int(cuts[-1])
        bounds = np.union1d(cuts, ends[ends <= upto])
        starts = np.concatenate([[0], bounds[:-1]])
        doc = np.searchsorted(ends, starts, side="right")
        window = np.searchsorted(cuts, starts, side="right")
        opens = np.concatenate([[0], cuts[:-1]])
        begins = ends - left
        raw = memoryview(np.ascontiguousarray(ids, "<u4"))
        rows = []
        for a, b, d, w in zip(starts.tolist(), bounds.tolist(), doc.tolist(), window.tolist(), strict=True):
            key, given, total = self.docs[d]
            rows.append((key, given + a - int(begins[d]), b - a, zlib.crc32(raw[a:b]), total, self.sequence + w, a - int(opens[w]), ids[a:b]))
        self.sequence += len(cuts)
        keep = int(np.searchsorted(ends, upto, side="right"))
        if keep < len(self.docs):
            key, given, total = self.docs[keep]
            self.docs = [(key, given + upto - int(begins[keep]), total), *self.docs[keep + 1 :]]
        else:
            self.docs = []
        self.ids, self.held = [ids[upto:]], n - upto
        return rows


def pack_windows(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", size: int = 4096, end_id: int = 2,
    sentence_penalty: int = 4, inside_penalty: int = 24, grid: int = 32, with_ids: bool = True,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and the ids).

    All of a document's ids and one ``end_id`` after them lie in exactly one piece each; pieces of a window follow each
    other from offset 0. Null and empty texts are the end id alone; equal ids are separate documents; null ids come
    first; an empty table has no pieces; other columns are not read. ``sequence_id`` is unique over the partitions.
    """
    total = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0
    fields = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    names = [x.split()[0] for x in fields.split(", ")]

    def pack(batches):
        coder = encoder(tokenizer)
        vocabulary = coder.tokenizer.get_vocab(with_added_tokens=True)
        ends_sentence = np.zeros(max([end_id, *vocabulary.values()]) + 1, bool)
        for text, i in vocabulary.items():
            ends_sentence[i] = text.replace("</w>", "").rstrip("\"')]").endswith((".", "!", "?"))
        stream = _Stream(size, grid, sentence_penalty, inside_penalty, ends_sentence, TaskContext.get().partitionId() << 40)

        def made(rows):
            if rows:
                columns = list(zip(*rows, strict=True))
                arrays = [pa.array(c, pa.int64()) for c in columns[:-1]]
                if with_ids:
                    arrays.append(pa.array([x.tolist() for x in columns[-1]], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(arrays, names=[*names, "ids"] if with_ids else names)

        for batch in batches:
            for rows in slices(batch, "text"):
                ids, counts = with_end(*coder.encode(rows.column("text")), end_id)
                stream.add(rows.column("doc_id").to_pylist(), ids, counts)
                if stream.held >= BUFFER_TOKENS:
                    yield from made(stream.settle(last=False))
        yield from made(stream.settle(last=True))

    rows = in_id_order(docs, id_col, text_col, max(1, -(-total // PART_BYTES)))
    return rows.mapInArrow(pack, fields + ", ids array<int>" * with_ids)
