"""Periodic runs of words (operator 13): a suffix array with ranks of every doubling, and the branching-tandem test.

The suffixes of all documents of a slice are ordered together, the document first, by prefix doubling in which only
suffixes that still share their prefix are ordered again. The ranks of each doubling are kept, so the longest common
prefix of any two suffixes is read off their bits. The intervals of the LCP array are met as places of its minima: each
place k parts its interval in two sides whose suffixes agree in exactly LCP[k] words. For every suffix i of the smaller
side the inverse suffix array tells whether i + LCP[k] or i - LCP[k] lies in the other one; if so, a branching square of
that period begins at the first of the two. No tree is built. Every run has one such square, its last; rotating the
square to the left, in steps that the common prefixes allow, gives the run, and squares of a multiple of the period meet
in the same stretch and are merged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adweave.llm.tokens import slices

SLICE_BYTES = 2 << 20  # text of the documents that are ordered together (a longer document by itself)
BLOCK = 1 << 20  # suffixes tested at once


class Suffixes:
    """Suffix array, inverse and common prefixes of several sequences; no prefix goes beyond its sequence."""

    def __init__(self, codes: np.ndarray, offsets: np.ndarray):
        n = len(codes)
        self.ends = np.repeat(offsets[1:], np.diff(offsets))
        owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        key = owner * (int(codes.max(initial=0)) + 1) + codes
        at = np.argsort(key, kind="stable")
        rank, single = self._grouped(key[at], np.zeros(n, np.int64))
        now = np.empty(n, np.int64)
        now[at] = rank
        self.levels = [now]
        active, length = at[~single], 1
        while len(active):
            beyond = active + length
            second = np.where(beyond < self.ends[active], now[np.minimum(beyond, n - 1)] + 1, 0)
            key = now[active] * (n + 1) + second
            order = np.argsort(key, kind="stable")
            active = active[order]
            rank, single = self._grouped(key[order], now[active])
            now = now.copy()
            now[active] = rank
            self.levels.append(now)
            active, length = active[~single], 2 * length
        self.inverse = now
        self.array = np.empty(n, np.int64)
        self.array[now] = np.arange(n)

    @staticmethod
    def _grouped(key: np.ndarray, old: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, whether the group has one member) for sorted keys; a group's rank is its place in the suffix array."""
        n = len(key)
        new = np.ones(n, bool)
        new[1:] = key[1:] != key[:-1]
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, n))
        group = np.cumsum(new) - 1
        outer = np.ones(n, bool)
        outer[1:] = old[1:] != old[:-1]
        begin = np.flatnonzero(outer)[np.cumsum(outer) - 1]
        return old + first[group] - begin, (size == 1)[group]

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of the suffixes at i and j, for i other than j."""
        length = np.zeros(len(i), np.int64)
        end_i, end_j = self.ends[i], self.ends[j]
        last = len(self.ends) - 1
        for power in range(len(self.levels) - 1, -1, -1):
            a, b = i + length, j + length
            same = (a < end_i) & (b < end_j)
            ranks = self.levels[power]
            same &= ranks[np.minimum(a, last)] == ranks[np.minimum(b, last)]
            length += same.astype(np.int64) << power
        return length

    def sides(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(LCP, k, begin, end) of the places k where neighbours in the suffix array agree in LCP[k] > 0 words.

        Suffixes begin..k-1 and k..end-1 of the array agree in exactly LCP[k] words across the sides.
        """
        same = self.levels[0][self.array]
        place = np.flatnonzero(same[1:] == same[:-1]) + 1
        lcp = self.common(self.array[place - 1], self.array[place])
        # intervals are bounded by places of smaller LCP; a gap in the places is an LCP of 0
        gap = np.ones(len(place), bool)
        gap[1:] = np.diff(place) > 1
        gaps, places, values = gap.tolist(), place.tolist(), lcp.tolist()
        begin, end, stack, bottom = [0] * len(places), [0] * len(places), [], 0
        for k, value in enumerate(values):
            if gaps[k]:
                for s in stack:
                    end[s] = places[k - 1] + 1
                stack, bottom = [], places[k] - 1
            while stack and values[stack[-1]] > value:
                end[stack.pop()] = places[k]
            begin[k] = places[stack[-1]] if stack else bottom
            stack.append(k)
        for s in stack:
            end[s] = places[-1] + 1
        return lcp, place, np.asarray(begin, np.int64), np.asarray(end, np.int64)


def squares(suffixes: Suffixes) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) of every branching square."""
    lcp, place, begin, end = suffixes.sides()
    array, inverse, n = suffixes.array, suffixes.inverse, len(suffixes.array)
    left = place - begin <= end - place
    size = np.where(left, place - begin, end - place)
    base = np.where(left, begin, place)
    other_low, other_high = np.where(left, place, begin), np.where(left, end, place)
    before = np.cumsum(size)
    found_at, found_period = [], []
    cuts = np.unique(np.append(np.searchsorted(before, np.arange(0, before[-1] if len(before) else 0, BLOCK)), len(place)))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        node = np.repeat(np.arange(a, b), size[a:b])
        entry = np.arange(len(node)) - np.repeat(before[a:b] - size[a:b] - (before[a] - size[a]), size[a:b]) + base[node]
        i, depth, low, high = array[entry], lcp[node], other_low[node], other_high[node]
        for step in (depth, -depth):
            to = i + step
            rank = inverse[np.clip(to, 0, n - 1)]
            hit = (to >= 0) & (to < n) & (rank >= low) & (rank < high)
            found_at.append(np.minimum(i, to)[hit])
            found_period.append(depth[hit])
    none = [np.empty(0, np.int64)]
    return np.concatenate(found_at or none), np.concatenate(found_period or none)


def runs(codes: np.ndarray, offsets: np.ndarray, times: int = 4, least: int = 6) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs of ``times`` periods and ``least`` codes or more, by start and period.

    Sequences are codes[offsets[k]:offsets[k + 1]]; starts count through all of them. ``times`` is at least 2.
    """
    suffixes = Suffixes(codes, offsets)
    at, period = squares(suffixes)
    begin = np.repeat(offsets[:-1], np.diff(offsets))
    # a run of so many periods holds a whole repetition of that many to the left of its last square
    back = at - (times - 2) * period
    far = np.maximum(back, 0)
    fits = (back >= begin[at]) & ((times == 2) | (suffixes.common(far, np.minimum(far + period, len(codes) - 1)) >= (times - 1) * period))
    at, period, back = at[fits], period[fits], back[fits]
    stop = at + 2 * period
    low, high = begin[at], back  # the run starts at the first place whose suffix still agrees up to the run's end
    while np.any(low < high):
        middle = (low + high) // 2
        good = suffixes.common(middle, middle + period) >= stop - period - middle
        low, high = np.where(good, low, middle + 1), np.where(good, middle, high)
    length = stop - low
    keep = length >= least
    start, length, period = low[keep], length[keep], period[keep]
    order = np.lexsort((period, length, start))  # squares of several periods that are one run: the smallest period
    start, length, period = start[order], length[order], period[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[new], length[new], period[new]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def _words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(offsets of the texts' first words and the end, the words ``[^\\x20\\x09-\\x0D]+``)."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    flat = lists.flatten()
    full = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0
    bounds = lists.offsets.to_numpy().astype(np.int64)
    return np.concatenate([[0], np.cumsum(full)])[bounds - bounds[0]], flat.filter(pa.array(full))


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _of_slice(ids: pa.Array, texts: pa.Array, times: int, least: int) -> pa.RecordBatch:
    offsets, words = _words(texts)
    coded = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    start, length, period = runs(coded, offsets, times, least)
    change = np.zeros(len(coded) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    kept = np.cumsum(change[:-1]) == 0
    left = np.concatenate([[0], np.cumsum(kept)])[offsets]
    collapsed = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(left), words.filter(pa.array(kept))), pa.scalar(" ", words.type))
    owner = np.searchsorted(offsets, start, side="right") - 1
    held = pa.StructArray.from_arrays([pa.array(start - offsets[owner]), pa.array(length), pa.array(period)], fields=list(RUN))
    bounds = np.searchsorted(owner, np.arange(len(offsets)))
    lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), held)
    return pa.RecordBatch.from_arrays([ids, pa.array(np.diff(offsets)), lists, collapsed.cast(pa.string())], names=["doc_id", "n_words", "runs", "collapsed_text"])


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", times: int = 4, least: int = 6, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """(doc_id, n_words, runs, collapsed_text) for every row of ``docs``, repeated rows and ids too.

    A run (start, length, period), in words ``[^\\x20\\x09-\\x0D]+`` numbered from 0, is a stretch of ``least`` words and
    ``times`` (2 or more) periods at least, with its smallest period, that cannot be extended; runs come by start, then
    period. ``collapsed_text`` has the words that no run holds after its first period, joined by one space. Null, empty
    and blank texts have no words, no runs and an empty ``collapsed_text``; a null id stays null; other columns are not
    read; an empty table gives no rows. Rows are worked on where they are read, without a shuffle. A task holds about
    500 bytes for each word of ``slice_bytes`` of text, or of a longer document.
    """
    if times < 2:
        raise ValueError("a run has two periods at least")

    def work(batches):
        for batch in batches:
            for part in slices(batch, "text", slice_bytes):
                yield _of_slice(part.column(0), part.column(1), times, least)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(work, "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed_text string")


def strongest(runs_col: F.Column) -> F.Column:
    """The run of the greatest length for its period; of ties the first. Null without runs."""
    none = F.lit(None).cast("struct<start: long, length: long, period: long>")
    better = lambda best, run: best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"])
    return F.aggregate(runs_col, none, lambda best, run: F.when(better(best, run), run).otherwise(best))


def looped(id_col: str, text_col: str) -> F.Column:
    """The text of one document in ten (by crc32 of the id) with the words from some place on repeating a stretch of it.

    With h = crc32(id), g = floor(h / 10), n words, a = g % n and p = 1 + floor((n - a) / (3 + g % 8)), the words from
    ``a`` on become words a..a+p-1 over and over if h % 10 = 0 and n > 0. A null id counts as the empty text.
    """
    h = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split(F.col(text_col), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    n = F.size(words)
    a = (g % F.greatest(n, F.lit(1))).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    again = F.flatten(F.array_repeat(F.slice(words, a + 1, p), (3 + g % 8).cast("int")))
    changed = F.array_join(F.concat(F.slice(words, F.lit(1), a), F.slice(again, F.lit(1), n - a)), " ")
    return F.when((h % 10 == 0) & (n > 0), changed).otherwise(F.col(text_col))
