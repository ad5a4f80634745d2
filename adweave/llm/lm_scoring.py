"""Language-model scores of whole documents (operator 6).

Word counts come from all training documents. The words that occur often enough are the vocabulary of a recurrent net,
which learns from every training document: in each round tasks train copies of it on the next piece of their chunks and
the copies are averaged. Texts are read once and kept as numbers of their chunk's words. Every other word gets the net's probability of another word times its share among them by
corpus counts. So the scores are those of one distribution over all words, comparable with the unigram base.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adweave.llm import chunks as C
from adweave.llm import gru
from adweave.llm.common import fold_of, saved
from adweave.llm.tokens import slices

VOCABULARY = 4_096  # words of the net at least, if there are so many
PASSES = 1  # times that every training token is learned from
ROUNDS = 8  # pieces of a chunk, and times that the copies are averaged
SLICE = 1 << 18  # weights that are summed together
LOG10 = float(np.log(10))


LISTS = pa.schema([
    ("range", pa.int32()), ("chunk", pa.int64()), ("size", pa.int32()), ("hashes", pa.binary()), ("counts", pa.binary()), ("ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
])
_LISTS = "range int, chunk long, size int, hashes binary, counts binary, ids array<long>, lengths array<long>"
CODES = -1  # in the place of a range: the row holds the words of a chunk as numbers


def _read(chunk: int, ids: pa.Array, texts: pa.Array, ranges: int, folds: int, held_fold: int) -> pa.Table:
    """The distinct words of a chunk as lists of hashes with their training counts by hash range, and its texts as numbers of these words."""
    words = C.words_of(texts, lower=True)
    distinct, number = np.unique(words.table[:, 0], return_inverse=True)
    codes, lengths = number[words.at], np.diff(words.offsets)
    use = np.repeat(_trained(ids, folds, held_fold), lengths)
    counts = np.bincount(codes[use], minlength=len(distinct)).astype(np.uint64)
    owners, cuts = C.cut_points(distinct, 64, ranges)
    rows = [
        {"range": int(r), "chunk": chunk, "size": int(b - a), "hashes": C.coded(distinct[a:b], 8), "counts": C.planes(counts[a:b], 4)}
        for r, a, b in zip(owners, cuts[:-1], cuts[1:], strict=True)
    ]
    rows.append({"range": CODES, "chunk": chunk, "size": len(distinct), "hashes": C.coded(distinct, 8), "counts": C.planes(codes, 4), "ids": ids.to_pylist(), "lengths": lengths.tolist()})
    return pa.Table.from_pylist(rows, schema=LISTS)


class _Texts:
    """A chunk read back: sorted hashes of its words, texts as numbers of them."""

    def __init__(self, row: dict):
        self.distinct = C.decoded(row["hashes"], 8)
        self.codes = C.from_planes(row["counts"], 4).astype(np.int64)
        self.ids = pa.array(row["ids"], pa.int64())
        self.lengths = np.asarray(row["lengths"], np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(self.lengths)])


def _merge(table: pa.Table, most: int):
    """The corpus count of every entry; the range's sums and its ``most`` most frequent words stand in its first row."""
    rows = table.select(["size", "hashes", "counts"]).to_pylist()
    values = np.concatenate([C.decoded(r["hashes"], 8) for r in rows])
    counts = np.concatenate([C.from_planes(r["counts"], 4) for r in rows])
    order, run, starts = C.runs(values)
    total = np.add.reduceat(counts[order], starts)
    answer = np.empty(len(values), np.uint64)
    answer[order] = total[run]
    ends = np.cumsum([r["size"] for r in rows]).tolist()
    top = np.argsort(-total.astype(np.int64), kind="stable")[:most]
    top = top[total[top] > 0]
    names = values[order[starts]].view(np.int64)
    listed = [{"hash": int(names[k]), "count": int(total[k])} for k in top]
    rest = len(rows) - 1
    extra = {
        "tokens": pa.array([int(total.sum()), *[0] * rest], pa.int64()), "kinds": pa.array([int((total > 0).sum()), *[0] * rest], pa.int64()),
        "top": pa.array([listed, *[[]] * rest], pa.list_(pa.struct([("hash", pa.int64()), ("count", pa.int64())]))),
    }
    return [C.planes(answer[b - r["size"] : b], 8) for b, r in zip(ends, rows, strict=True)], extra


def _trained(ids, folds: int, held_fold: int) -> np.ndarray:
    from zlib import crc32

    return np.asarray([crc32(b"" if i is None else str(i).encode()) % folds != held_fold for i in ids.to_pylist()], bool)


def _learn(net: gru.Net, texts: DataFrame, numbered, end: int, folds: int, held_fold: int, passes: int) -> None:
    """Trains ``net`` in ``ROUNDS`` on all training tokens of all chunks, ``passes`` times.

    Each chunk's training tokens are written once as ``ROUNDS`` pieces. In a round every chunk trains a copy of the net on its next
    ``passes`` pieces; tasks add up what their copies learned, and slices of these sums are added up over the tasks.
    """
    names = [f"p{k}" for k in range(ROUNDS)]

    def encode(batches):
        for batch in batches:
            for row in batch.to_pylist():
                held = _Texts(row)
                use = _trained(held.ids, folds, held_fold)
                ends = np.cumsum(held.lengths[use])
                stream = np.insert(numbered(held.distinct)[held.codes[np.repeat(use, held.lengths)]], ends, end)
                yield pa.RecordBatch.from_arrays([pa.array([C.planes(x, 4)], pa.binary()) for x in np.array_split(stream, ROUNDS)], names=names)

    pieces = saved(texts.mapInArrow(encode, ", ".join(f"{k} binary" for k in names)), "pieces")
    tasks = 2 * pieces.sparkSession.sparkContext.defaultParallelism  # each moves one net
    for turn in range(ROUNDS):
        these = [names[k % ROUNDS] for k in range(turn * passes, (turn + 1) * passes)]
        rate, last = (0.05 * (1 - x / ROUNDS) + 1e-4 for x in (turn, turn + 1))

        def learn(batches, these=these, rate=rate, last=last):
            mean = gru.Mean(net)
            for batch in batches:
                for row in batch.to_pylist():
                    mean.learn(np.concatenate([C.from_planes(row[k], 4) for k in these]).astype(np.int64), end, rate, last)
            flat = mean.flat()
            for k in range(0, len(flat), SLICE):
                yield pa.RecordBatch.from_arrays([pa.array([k // SLICE], pa.int32()), pa.array([flat[k : k + SLICE].tobytes()], pa.binary())], names=["slice", "sums"])

        def add(rows: pa.Table) -> pa.Table:
            total = sum(np.frombuffer(x.as_py(), np.float32).astype(np.float64) for x in rows["sums"])
            return pa.table({"slice": rows["slice"][:1], "sums": pa.array([total.astype(np.float32).tobytes()], pa.binary())})

        found = pieces.select(*sorted(set(these))).coalesce(tasks).mapInArrow(learn, "slice int, sums binary")
        slices = sorted(found.groupBy("slice").applyInArrow(add, "slice int, sums binary").collect())
        if slices:
            gru.Mean(net).apply(np.concatenate([np.frombuffer(r["sums"], np.float32) for r in slices]))


def score_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 5, held_fold: int = 1, vocabulary: int = VOCABULARY, passes: int = PASSES,
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row, scores as log10 probabilities.

    Tokens are the words after folding A-Z, then one end. A null or empty text is the end alone. Rows with equal ids
    are scored each; other columns are not read; an empty table gives no rows. Without training documents every count
    is 0. Only documents outside the held-out fold are counted or learned from, and all of them are, ``passes`` times. The
    net's words are all that make up more than 1 / sqrt(training tokens) of them, so the net grows slower than the corpus, and
    at least the ``vocabulary`` most frequent (ties by hash).
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(8, total // C.RANGE_BYTES)
    outside = rows.where(fold_of("doc_id", folds) != held_fold)

    def read(batches):
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in slices(batch, "text", C.CHUNK_BYTES):
                yield from _read(chunk, part.column(0), part.column(1), ranges, folds, held_fold).to_batches()
                chunk += 1

    everything = saved(rows.mapInArrow(read, _LISTS), "words")
    texts, lists = everything.where(F.col("range") == CODES), everything.where(F.col("range") != CODES)
    more = ", tokens long, kinds long, top array<struct<hash: long, count: long>>"
    answers = C.answered(lists, lambda t: _merge(t, max(vocabulary, VOCABULARY)), "counts", more)
    sums = answers.agg(F.sum("tokens"), F.sum("kinds")).first()
    ends = outside.count()
    tokens, kinds = (sums[0] or 0) + ends, (sums[1] or 0) + (ends > 0)
    listed = answers.select(F.explode("top").alias("t")).select("t.hash", "t.count")
    # a range has some 650,000 tokens, so far fewer words above the root of all than it lists
    top = listed.where(F.col("count") >= math.isqrt(tokens)).collect()
    if len(top) < vocabulary - 1:
        top = listed.orderBy(F.desc("count"), "hash").limit(vocabulary - 1).collect()
    # the end is a word of the vocabulary; its hash is none of the others'
    ranked = sorted([*((r["count"], r["hash"]) for r in top), (ends, None)], key=lambda x: (-x[0], x[1] is not None, x[1] or 0))
    end = next(k for k, (_, name) in enumerate(ranked) if name is None)
    counts = np.asarray([c for c, _ in ranked], float)
    others = tokens - int(counts.sum())
    named = [(k, h) for k, (_, h) in enumerate(ranked) if h is not None]
    hashes = np.asarray([h for _, h in named], np.int64).view(np.uint64)
    order = np.argsort(hashes)
    hashes, places = hashes[order], np.asarray([k for k, _ in named], np.int64)[order]
    n = len(ranked)

    def numbered(values: np.ndarray) -> np.ndarray:
        if not len(hashes):
            return np.full(len(values), n)
        at = np.minimum(np.searchsorted(hashes, values), len(hashes) - 1)
        return np.where(hashes[at] == values, places[at], n)

    net = gru.new_net(counts, others)
    _learn(net, texts, numbered, end, folds, held_fold, passes)

    scale = tokens + 0.5 * (kinds + 1)
    other_scale = others + 0.5 * (kinds - int((counts > 0).sum())) + 0.5
    log_end = float(np.log10((ends + 0.5) / scale))

    def judge(rows: pa.Table, found: pa.Table) -> pa.Table:
        held = _Texts(rows.to_pylist()[0])
        owners, cuts = C.cut_points(held.distinct, 64, ranges)
        known = C.gathered(found, cuts, owners, lambda data, size: C.from_planes(data, 8), np.uint64).astype(float)
        offsets, number = held.offsets, numbered(held.distinct)
        filled = np.flatnonzero(held.lengths)

        def summed(per_word: np.ndarray) -> np.ndarray:
            """Sums of each text's words, text by text, so that a short text keeps its digits beside long ones."""
            out = np.zeros(len(held.lengths))
            if len(filled):
                out[filled] = np.add.reduceat(per_word[held.codes], offsets[filled])
            return out

        base = summed(np.log10((known + 0.5) / scale)) + log_end
        other = np.where(number == n, np.log10((known + 0.5) / other_scale), 0.0)
        ids = np.insert(number[held.codes], offsets[1:], end)
        bounds = offsets + np.arange(len(offsets))
        model = gru.score(net, [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)], end) / LOG10 + summed(other)
        return pa.table({
            "doc_id": held.ids, "held_out": pa.array(~_trained(held.ids, folds, held_fold)), "n_tokens": pa.array(np.diff(bounds)),
            "n_known": pa.array(summed((known > 0).astype(float)).astype(np.int64) + (ends > 0)), "train_tokens": pa.array(np.full(len(held.ids), tokens)),
            "base_score": pa.array(base), "score": pa.array(model),
        })

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    answers = answers.select("chunk", "range", "answer")
    return texts.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(judge, schema)
