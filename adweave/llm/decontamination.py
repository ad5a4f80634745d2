"""Benchmark decontamination by pigeonhole edit matching (operator 2).

An item of m words may be met with k = floor(m * errors) word edits. It is split into k + 1 pieces; a passage within k
edits holds one of them unchanged. The pieces' hashes are looked up in every text, and around each hit the whole item
is searched with Myers' bit-parallel edit distance over words.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adweave.llm import chunks as C
from adweave.llm.tokens import slices

BLOCK_ITEMS = 10_000  # items that a pass over the documents carries; more items take more passes
SLICE_BYTES = 3 << 20  # text of the documents whose words are held at once
SHORTEST = 5  # words of the shortest item that is searched; fewer words say nothing about a leak


def plain_words(texts: pa.Array) -> C.Words:
    """Words in lower case without anything but letters and digits; what is then empty is no word."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    lists = pc.utf8_split_whitespace(texts)
    coded = lists.flatten().dictionary_encode()
    names = pc.replace_substring_regex(pc.utf8_lower(coded.dictionary), r"[^\p{L}\p{N}]+", "")
    digests = b"".join(map(xxhash.xxh3_128_digest, names.cast(pa.large_binary()).to_pylist()))
    table = np.frombuffer(digests, "<u8").reshape(-1, 2)
    at = coded.indices.to_numpy(zero_copy_only=False)
    full = (pc.binary_length(names).to_numpy(zero_copy_only=False) > 0)[at] if len(at) else np.empty(0, bool)
    bounds = lists.offsets.to_numpy().astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(full)])[bounds - bounds[0]]
    at = at[full]
    return C.Words(offsets, table, at, pa.nulls(0))


def myers(pattern: list, text: list, most: int) -> tuple[int, int] | None:
    """(least distance, end of the first best match) of ``pattern`` anywhere in ``text``, if at most ``most`` edits."""
    m = len(pattern)
    full, high = (1 << m) - 1, 1 << (m - 1)
    where: dict = {}
    for k, w in enumerate(pattern):
        where[w] = where.get(w, 0) | 1 << k
    up, down, score = full, 0, m
    best = None
    for end, w in enumerate(text, 1):
        equal = where.get(w, 0)
        vertical = equal | down
        flat = (((equal & up) + up) ^ up) | equal
        plus = down | ~(flat | up)
        minus = up & flat
        if plus & high:
            score += 1
        elif minus & high:
            score -= 1
        plus, minus = plus << 1, minus << 1
        up = (minus | ~(vertical | plus)) & full
        down = plus & vertical & full
        if score <= most and (best is None or score < best[0]):
            best = (score, end)
    return best


@dataclass(frozen=True)
class Items:
    """A block of items: words, error budgets, and pieces by length as sorted hashes."""

    ids: list
    words: list[list[int]]
    budgets: list[int]
    pieces: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]  # length: hashes, items, offsets, first words


def prepare(rows: list[tuple], errors: float) -> Items:
    held = plain_words(pa.array([t for _, t in rows], pa.string()))
    windows, first = C.Windows(held, lanes=1), held.lane(0)
    ids, words, budgets = [], [], []
    found: dict[int, list[tuple]] = {}
    for (key, _), a, b in zip(rows, held.offsets[:-1].tolist(), held.offsets[1:].tolist(), strict=True):
        m = b - a
        if m < SHORTEST:
            continue
        k = int(m * errors)
        cuts = [m * x // (k + 1) for x in range(k + 2)]
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            h = int(windows.at(np.asarray([a + lo]), hi - lo)[0])
            found.setdefault(hi - lo, []).append((h, len(ids), lo, int(first[a + lo])))
        ids.append(key)
        words.append(first[a:b].tolist())
        budgets.append(k)
    pieces = {}
    for length, entries in found.items():
        entries.sort()
        columns = list(zip(*entries, strict=True))
        pieces[length] = (np.asarray(columns[0], np.uint64), np.asarray(columns[1]), np.asarray(columns[2]), np.unique(np.asarray(columns[3], np.uint64)))
    return Items(ids, words, budgets, pieces)


def _matches(words: C.Words, items: Items):
    """(document, item, distance, start, length) of the best match of each item in each document it is found in."""
    windows, lane = C.Windows(words, lanes=1), words.lane(0)
    ends = words.ends
    regions: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for length, (hashes, owner, offset, firsts) in items.pieces.items():
        at = np.searchsorted(firsts, lane)
        starts = np.flatnonzero(firsts[np.minimum(at, len(firsts) - 1)] == lane)
        starts = starts[starts + length <= ends[starts]]
        seen = windows.at(starts, length)
        low, high = np.searchsorted(hashes, seen, "left"), np.searchsorted(hashes, seen, "right")
        for k in np.flatnonzero(high > low):
            p = int(starts[k])
            doc = int(np.searchsorted(words.offsets, p, side="right")) - 1
            a, b = int(words.offsets[doc]), int(words.offsets[doc + 1])
            for e in range(int(low[k]), int(high[k])):
                item = int(owner[e])
                budget = items.budgets[item]
                begin = p - int(offset[e])
                regions.setdefault((doc, item), []).append((max(a, begin - budget), min(b, begin + len(items.words[item]) + budget)))
    for (doc, item), spans in regions.items():
        pattern, budget = items.words[item], items.budgets[item]
        spans.sort()
        merged = [list(spans[0])]
        for a, b in spans[1:]:
            if a <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b])
        best = None
        for a, b in merged:
            if b - a >= len(pattern) - budget:
                text = lane[a:b].tolist()
                hit = myers(pattern, text, budget)
                if hit and (best is None or hit[0] < best[0]):
                    back = myers(pattern[::-1], text[: hit[1]][::-1], hit[0])
                    best = (hit[0], a + hit[1] - back[1] - int(words.offsets[doc]), back[1])
        if best:
            yield doc, item, *best


def _leaks_of(batch: pa.RecordBatch, items: Items):
    """The rows of ``find_leaks`` for a batch (doc_id, text, text_key). Words are held for a slice of its texts at a time."""
    for part in slices(batch, "text", SLICE_BYTES):
        found = list(_matches(plain_words(part.column("text")), items))
        pa.default_memory_pool().release_unused()
        ids, keys = part.column("doc_id").to_pylist(), part.column("text_key").to_pylist()
        columns = [[ids[f[0]] for f in found], [items.ids[f[1]] for f in found], *([f[k] for f in found] for k in (2, 3, 4)), [keys[f[0]] for f in found]]
        types = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["doc_id", "item_id", "distance", "start", "length", "text_key"])


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", errors: float = 0.2,
) -> DataFrame:
    """(doc_id, item_id, distance, start, length, text_key): the best match of each item in each document, in words.

    Of equally good matches the one that ends first counts, of these the shortest. ``text_key`` (xxhash64 of the text) tells rows of one id apart.

    Case and everything but letters and digits are ignored on both sides. Null or short items (under five words) and
    null or empty texts match nothing. Every row of either table is compared for itself, equal rows too; other columns
    are not read; an empty table on either side gives no rows. Items reach the tasks in blocks of bounded size, each
    block a pass over the documents.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.withColumn("text_key", F.xxhash64("text"))
    schema = "doc_id long, item_id long, distance int, start long, length long, text_key long"

    def against(block: list[tuple]) -> DataFrame:
        items = prepare(block, errors)

        def search(batches):
            for batch in batches:
                yield from _leaks_of(batch, items)

        return rows.mapInArrow(search, schema)

    out, block = None, []
    for row in benchmark.select(F.col(item_col).cast("long"), F.col(item_text).cast("string")).where(F.col(item_text).isNotNull()).toLocalIterator():
        block.append(tuple(row))
        if len(block) == BLOCK_ITEMS:
            out = against(block) if out is None else out.unionByName(against(block))
            block = []
    if block or out is None:
        out = against(block) if out is None else out.unionByName(against(block))
    return out
