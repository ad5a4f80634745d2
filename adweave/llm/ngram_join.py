"""Similarity join on word shingles with token-combination prefixes (operator 8).

Sets are collapsed to distinct ones first, so exact copies cost nothing further. The shingles of a set are ordered by
document frequency, then hash. A set of n shingles whose partners must hold ``need`` of them may lack ``n - need``; its
prefix is extended until that many losses cannot break every signature in it. A rare shingle is a signature by itself.
Frequent shingles fall into ``SUBCLASSES`` classes and only pairs of one class are signatures, so the first shingle of
a class adds nothing to the prefix's strength and common passages make few, selective signatures. Two sets that
reach the threshold share a signature: of the set whose prefix ends first, some class keeps a shingle (or two) in common,
and these lie in the other's prefix as well. Sets too small for that bound index plain prefixes too.

Sets that share a signature are compared with the group's most central set first (fewest shingles of its own). Only
sets that are in different components after that are compared with each other, if their sizes and the numbers of their
shingles in each of ``CELLS`` hash classes allow the threshold: two sets share no more of a class than the smaller
number. No pair of one component is listed. Sets that are alike share hundreds of signatures, but are compared for one:
each set carries the smallest of its signatures in each of ``LANES`` classes, and where two sets agree on some of these,
the smallest of those is the signature that lists them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adweave.llm import chunks as C
from adweave.llm.common import saved, unused
from adweave.llm.tokens import slices
from adweave.operators.components import connected_components

FREQUENT = 16  # document frequency above which shingles are indexed in pairs
SUBCLASSES = 8
CELLS, WIDE = 128, 16  # classes of shingles that a set is counted by before it is compared with another, and groups of these
LANES = 32  # classes of signatures of which a set carries the smallest
SLICE_BYTES = 3 << 20  # text of the documents whose words are held at once
_SMALL_SALT, _PAIR_SALT = np.uint64(0xA5A5A5A5A5A5A5A5), np.uint64(0x9E3779B97F4A7C15)


class _Sets:
    """The distinct shingle sets of a chunk: entries sorted by document and hash.

    Words and windows are held for a slice of the chunk's documents at a time, the hashes of the sets for all of them.
    """

    def __init__(self, rows: pa.Table, size: int):
        self.n_docs, at, docs, hashes = len(rows), 0, [], []
        for part in slices(rows, "text", SLICE_BYTES):
            doc, found = self._of_slice(part["text"], size)
            docs.append((doc + at).astype(np.int32))
            hashes.append(found)
            at += len(part)
        self.doc = np.concatenate(docs) if docs else np.empty(0, np.int32)
        self.hash = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        del docs, hashes
        pa.default_memory_pool().release_unused()
        self.bounds = np.searchsorted(self.doc, np.arange(self.n_docs + 1))
        self.sizes = np.diff(self.bounds)
        lanes = []
        for salt in (np.uint64(0x1234567887654321), np.uint64(0x0FEDCBA99ABCDEF0)):
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(C.mixed(self.hash ^ salt), dtype=np.uint64)])
            lanes.append(C.mixed(sums[self.bounds[1:]] - sums[self.bounds[:-1]] + self.sizes.astype(np.uint64)))
        raw = np.stack(lanes, axis=1).astype("<u8").tobytes()
        self.nodes = [raw[16 * k : 16 * k + 16] if self.sizes[k] else None for k in range(self.n_docs)]
        seen: dict = {}
        for k, node in enumerate(self.nodes):
            if node is not None:
                seen.setdefault(node, k)
        self.firsts = np.asarray(sorted(seen.values()), np.int64)  # one document of each distinct set

    @staticmethod
    def _of_slice(texts: pa.ChunkedArray, size: int) -> tuple[np.ndarray, np.ndarray]:
        words = C.words_of(texts, lower=True)
        windows = C.Windows(words, lanes=1)
        counts = np.diff(words.offsets)
        place = np.arange(windows.n)
        owner = np.repeat(np.arange(len(counts)), counts)
        starts = np.flatnonzero(place + size <= words.ends)
        short = np.flatnonzero((counts > 0) & (counts < size))
        hashes = np.concatenate([windows.at(starts, size), windows.at(words.offsets[short], counts[short])])
        doc = np.concatenate([owner[starts], short])
        order, _, first = C.runs(doc, hashes)
        return doc[order[first]], hashes[order[first]]

    def ask(self, ranges: int) -> None:
        """Makes the sorted distinct hashes of the distinct sets, cut at the hash ranges."""
        chosen = np.zeros(self.n_docs, bool)
        chosen[self.firsts] = True
        self.own = chosen[self.doc]
        values = self.hash[self.own] >> np.uint64(16)
        order = np.argsort(values, kind="stable")
        values = values[order]
        new = np.ones(len(values), bool)
        new[1:] = values[1:] != values[:-1]
        begin = np.flatnonzero(new)
        self.run = np.empty(len(order), np.int32)
        self.run[order] = np.cumsum(new) - 1
        self.distinct, self.counts = values[begin], np.diff(np.concatenate([begin, [len(order)]]))
        self.range_ids, self.cuts = C.cut_points(self.distinct, 48, ranges)

    def lists(self, chunk: int) -> list[dict]:
        few = np.minimum(self.counts, 255).astype(np.uint8)
        return [
            {"range": int(r), "chunk": chunk, "size": int(b - a), "hashes": C.coded(self.distinct[a:b], 6), "counts": few[a:b].tobytes()}
            for r, a, b in zip(self.range_ids, self.cuts[:-1], self.cuts[1:], strict=True)
        ]

    def signatures(self, found: pa.Table, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, signature) entries and the number of shingles of its own for each document."""
        answer = C.gathered(found, self.cuts, self.range_ids, lambda data, n: np.frombuffer(data, np.uint8), np.uint8)
        df = answer[self.run]
        doc, hashes = self.doc[self.own].astype(np.int64), self.hash[self.own]
        order = np.argsort(doc << 8 | df, kind="stable")  # hashes ascend within a document
        doc, hashes, df = doc[order], hashes[order], df[order]
        del order, answer
        alone = np.bincount(doc[df == 1], minlength=self.n_docs)
        spare = self.sizes - (self.sizes * percent + 99) // 100
        begin = np.searchsorted(doc, np.arange(self.n_docs))
        place = np.arange(len(doc)) - begin[doc]
        small = -(-100 * (SUBCLASSES + 1) // percent)  # at most so many shingles: the bound of the classes may fail
        out = []
        plain = (place <= spare[doc]) & (df > 1) & (self.sizes[doc] <= small * 100 // percent)
        out.append((doc[plain], C.mixed(hashes[plain] ^ _SMALL_SALT)))
        frequent = df > FREQUENT
        strength = np.ones(len(doc), np.int64)
        group = doc * SUBCLASSES + (hashes & np.uint64(SUBCLASSES - 1)).astype(np.int64)
        common = np.flatnonzero(frequent)
        strength[common[np.unique(group[common], return_index=True)[1]]] = 0
        before = np.cumsum(strength) - strength
        prefix = (before - before[begin[doc]] <= spare[doc]) & (self.sizes[doc] > small) if len(doc) else np.empty(0, bool)
        rare = prefix & ~frequent & (df > 1)
        out.append((doc[rare], hashes[rare]))
        paired = np.flatnonzero(prefix & frequent)
        paired = paired[np.argsort(group[paired], kind="stable")]
        edges = np.flatnonzero(np.concatenate([[True], group[paired][1:] != group[paired][:-1], [True]])) if len(paired) else [0]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            if b - a > 1:
                held = np.sort(hashes[paired[a:b]])
                i, j = np.triu_indices(b - a, 1)
                out.append((np.full(len(i), doc[paired[a]]), C.mixed(held[i] * _PAIR_SALT + held[j])))
        return np.concatenate([d for d, _ in out]), np.concatenate([s for _, s in out]), alone


def _merge_counts(table: pa.Table) -> list[bytes]:
    rows = table.select(["size", "hashes", "counts"]).to_pylist()
    values = np.concatenate([C.decoded(r["hashes"], 6) for r in rows])
    counts = np.concatenate([np.frombuffer(r["counts"], np.uint8) for r in rows]).astype(np.int64)
    order, run, starts = C.runs(values)
    total = np.minimum(np.add.reduceat(counts[order], starts), 255).astype(np.uint8)
    answer = np.empty(len(values), np.uint8)
    answer[order] = total[run]
    ends = np.cumsum([r["size"] for r in rows]).tolist()
    return [answer[b - r["size"] : b].tobytes() for b, r in zip(ends, rows, strict=True)]


def _reaches(shared: F.Column, i: str, j: str, percent: int) -> F.Column:
    """Whether so many shingles in common reach the threshold. ``shared`` stands in it once: what a condition repeats, Spark works out for every pair."""
    return shared.cast("long") * (100 + percent) >= (F.col(f"size_{i}") + F.col(f"size_{j}")) * percent


def _fits(i: str, j: str, percent: int) -> F.Column:
    """Whether two sets may reach the threshold by their sizes and by what each holds that no other set does."""
    size_i, size_j, alone_i, alone_j = F.col(f"size_{i}"), F.col(f"size_{j}"), F.col(f"alone_{i}"), F.col(f"alone_{j}")
    return _reaches(F.least(size_i - alone_i, size_j - alone_j, F.floor((size_i + size_j - alone_i - alone_j) / 2)), i, j, percent)


def _overlap_fits(i: str, j: str, percent: int) -> F.Column:
    """Whether two sets may reach the threshold by their numbers of shingles in each class, in a few wide classes first."""
    wide = sum((F.least(F.col(f"wide_{i}")[k], F.col(f"wide_{j}")[k]) for k in range(WIDE)), F.lit(0))
    least = F.zip_with(f"cells_{i}", f"cells_{j}", lambda a, b: F.least(a, b))
    every = F.aggregate(least, F.lit(0), lambda total, x: total + x)
    return _reaches(wide, i, j, percent) & _reaches(every, i, j, percent)


def _unsettled_pairs(placed: DataFrame, percent: int) -> DataFrame:
    """(i, j), i < j, for sets of ``placed`` that share a signature, lie in different components and may reach the threshold.

    A row of ``placed`` is a set's signature with what is known of the set. A pair comes once if its sets agree on the smallest signature
    of any class, else once for each signature that they share.
    """
    lane = F.pmod("sig", F.lit(LANES))
    lows = placed.groupBy("node").agg(F.array_compact(F.array(*[F.min(F.when(lane == k, F.col("sig"))) for k in range(LANES)])).alias("lows"))
    placed = placed.join(lows, "node")
    side = lambda k: placed.select("sig", "step", *(F.col(c).alias(f"{c}_{k}") for c in ("node", "size", "alone", "resolved_id", "cells", "wide", "lows")))
    near = side("j").withColumn("step", F.explode(F.array(F.col("step") - 1, F.col("step"), F.col("step") + 1)))
    differ = (F.col("node_i") < F.col("node_j")) & (F.col("resolved_id_i") != F.col("resolved_id_j"))
    listed = F.coalesce(F.array_min(F.array_intersect("lows_i", "lows_j")), F.col("sig")) == F.col("sig")
    rest = side("i").join(near, ["sig", "step"]).where(differ & _fits("i", "j", percent) & listed & _overlap_fits("i", "j", percent))
    return rest.select(F.col("node_i").alias("i"), F.col("node_j").alias("j"))


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (i, j) whose sets reach the threshold. The set of j travels to i, whose partition may be split."""
    left = sets.select(F.col("node").alias("i"), F.col("held").alias("held_i"))
    right = sets.select(F.col("node").alias("j"), F.col("held").alias("held_j"))
    both = pairs.join(right, "j").join(left, "i")
    shared = F.size(F.array_intersect("held_i", "held_j"))
    return both.where(shared * 100 >= (F.size("held_i") + F.size("held_j") - shared) * percent).select("i", "j")


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, percent: int = 90) -> DataFrame:
    """(doc_id, n_shingles, component_id, text_key, component) for every row; rows link when Jaccard similarity reaches ``percent``.

    Words are ``[^\\x20\\x09-\\x0D]+`` after folding A-Z; a text with fewer words than a shingle is one shingle; a text
    without words, or null, has none and links with nothing. Equal ids are separate rows; ``component_id`` is the
    smallest id reachable by links (null ids count only if no other is). ``text_key`` (xxhash64 of the text) tells rows of
    one id apart and ``component`` names the group, null without words. Other columns are not read. An empty table
    gives no rows. ``percent`` is at least 50.
    """
    if not 50 <= percent <= 100:
        raise ValueError("percent is between 50 and 100")
    chunks = C.in_chunks(docs, id_col, text_col)
    ranges = chunks.ranges

    def ask(rows: pa.Table) -> pa.Table:
        sets = _Sets(C.in_order(rows), words)
        sets.ask(ranges)
        lists = sets.lists(rows["chunk"][0].as_py())
        return pa.Table.from_pylist(lists, schema=pa.schema([("range", pa.int32()), ("chunk", pa.int64()), ("size", pa.int32()), ("hashes", pa.binary()), ("counts", pa.binary())]))

    lists = chunks.rows.groupBy("chunk").applyInArrow(ask, "range int, chunk long, size int, hashes binary, counts binary")
    frequencies = C.answered(lists, _merge_counts, "frequencies")

    def describe(rows: pa.Table, found: pa.Table) -> pa.Table:
        """A row per document (sig null) and a row per signature of a distinct set (doc_id null)."""
        schema = pa.schema([("is_doc", pa.bool_()), ("doc_id", pa.int64()), ("text_key", pa.int64()), ("size", pa.int64()), ("node", pa.binary()), ("sig", pa.int64()), ("alone", pa.int64()), ("chunk", pa.int64())])
        if not len(rows):
            return schema.empty_table()
        sets = _Sets(rows, words)
        sets.ask(ranges)
        doc, sig, alone = sets.signatures(found, percent)
        n, m = sets.n_docs, len(doc)
        nodes = pa.array(sets.nodes, pa.binary())
        none = lambda k, kind=pa.int64(): pa.nulls(k, kind)
        chunk = rows["chunk"][0].as_py()
        keys = np.asarray([42 if t is None else xxhash.xxh64_intdigest(t, 42) for t in rows["text"].to_pylist()], np.uint64).view(np.int64)  # as Spark's xxhash64
        per_doc = pa.table([pa.array(np.ones(n, bool)), rows["doc_id"], pa.array(keys), pa.array(sets.sizes.astype(np.int64)), nodes, none(n), none(n), none(n)], schema=schema)
        per_sig = pa.table(
            [
                pa.array(np.zeros(m, bool)), none(m), none(m), pa.array(sets.sizes[doc].astype(np.int64)), nodes.take(pa.array(doc)), pa.array(sig.view(np.int64)),
                pa.array(alone[doc].astype(np.int64)), pa.array(np.full(m, chunk)),
            ],
            schema=schema,
        )
        return pa.concat_tables([per_doc, per_sig])

    found = saved(C.with_answers(chunks, frequencies, describe, "is_doc boolean, doc_id long, text_key long, size long, node binary, sig long, alone long, chunk long"), "signatures")
    rows = found.where("is_doc").select("doc_id", "text_key", F.col("size").alias("n_shingles"), "node")
    entries = found.where("not is_doc").groupBy("sig", "node").agg(F.min("size").alias("size"), F.min("alone").alias("alone"), F.min("chunk").alias("chunk"))
    entries = saved(entries, "entries")
    centre = entries.groupBy("sig").agg(F.min(F.struct("alone", "node", "size")).alias("c"), F.count(F.lit(1)).alias("n")).where("n > 1").select("sig", "c")
    grouped = entries.join(centre, "sig").select(
        "sig", "chunk", F.col("node").alias("j"), F.col("size").alias("size_j"), F.col("alone").alias("alone_j"),
        F.col("c.node").alias("i"), F.col("c.size").alias("size_i"), F.col("c.alone").alias("alone_i"),
    )
    grouped = saved(grouped, "grouped")

    wanted = grouped.groupBy(F.col("j").alias("node")).agg(F.min("chunk").alias("chunk"))

    def take(rows: pa.Table, wanted: pa.Table) -> pa.Table:
        schema = pa.schema([("node", pa.binary()), ("held", pa.list_(pa.int64())), ("cells", pa.list_(pa.int32())), ("wide", pa.list_(pa.int32()))])
        if not len(rows) or not len(wanted):
            return schema.empty_table()
        sets, names = _Sets(rows, words), set(wanted["node"].to_pylist())
        at = [k for k in sets.firsts.tolist() if sets.nodes[k] in names]
        lists = [sets.hash[sets.bounds[k] : sets.bounds[k + 1]].view(np.int64) for k in at]
        cells = [np.bincount((x.view(np.uint64) >> np.uint64(20)).astype(np.int64) % CELLS, minlength=CELLS).astype(np.int32) for x in lists]
        return pa.table([pa.array([sets.nodes[k] for k in at], pa.binary()), pa.array(lists, pa.list_(pa.int64())), pa.array(cells, pa.list_(pa.int32())), pa.array([c.reshape(WIDE, -1).sum(1).astype(np.int32) for c in cells], pa.list_(pa.int32()))], schema=schema)

    sets = saved(C.with_answers(chunks, wanted, take, "node binary, held array<long>, cells array<int>, wide array<int>"), "sets")
    chunks.drop()

    others = grouped.where(F.col("j") != F.col("i"))
    stars = others.where(_fits("i", "j", percent)).select("i", "j").distinct()
    first = saved(_linked(stars, sets, percent), "star-links")
    nodes = wanted.select("node")
    resolved = saved(connected_components(nodes, first, "node"), "star-components")

    # sets that share a signature and still are in different components
    placed = others.select("sig", F.col("j").alias("node"), F.col("size_j").alias("size"), F.col("alone_j").alias("alone")).join(resolved, "node")
    mixed = placed.groupBy("sig").agg(F.min("resolved_id").alias("low"), F.max("resolved_id").alias("high")).where("low <> high").select("sig")
    # sizes that reach the threshold lie in one size step or in neighbouring ones
    step = F.floor(F.log("size") / F.log(F.lit(100.000001 / percent)) if percent < 100 else F.col("size")).cast("long")
    placed = saved(placed.join(mixed, "sig").join(sets.select("node", "cells", "wide"), "node").withColumn("step", step), "unsettled")
    rest = _unsettled_pairs(placed, percent).distinct()
    links = first.unionByName(_linked(rest, sets, percent))
    resolved = connected_components(nodes, saved(links, "links"), "node")
    named = rows.join(resolved, "node", "left").withColumn("component", F.coalesce("resolved_id", "node"))
    lowest = named.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return named.join(lowest, "component", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), "text_key", "component")


def one_per_component(docs: DataFrame, groups: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without all but one of each component of ``groups``, which came from the same rows.

    The row with the smallest id stays (null ids come first), of equal ids the one with the smallest hash of its text, of equal texts
    any one. Rows without words all stay.
    """
    own_id, key = unused(docs, "_id"), unused(docs, "_key")
    groups = saved(groups.select("doc_id", "text_key", "component"), "groups")
    first = groups.where("component is not null").groupBy("component").agg(F.min(F.struct("doc_id", "text_key")).alias("k"))
    copies = groups.groupBy("doc_id", "text_key").agg(((F.count(F.lit(1)) > 1) & (F.count("component") > 0)).alias("again"))
    chosen = first.select("k.*").unionByName(groups.where("component is null").select("doc_id", "text_key")).distinct().toDF(own_id, key)
    chosen = chosen.join(copies, F.col(own_id).eqNullSafe(F.col("doc_id")) & (F.col(key) == F.col("text_key"))).select(own_id, key, "again")
    chosen = saved(chosen, "chosen")
    match = F.col(id_col).cast("long").eqNullSafe(F.col(own_id)) & (F.xxhash64(F.col(text_col).cast("string")) == F.col(key))
    kept = docs.join(chosen.where("not again").select(own_id, key), match, "left_semi")
    again = chosen.where("again").select(own_id, key)
    if again.isEmpty():
        return kept
    repeated = docs.join(again, match, "left_semi").withColumn(key, F.xxhash64(F.col(text_col).cast("string"))).dropDuplicates([id_col, key]).drop(key)
    return kept.unionByName(repeated)
