"""Toxicity by compression distance (operator 4).

Two zstandard dictionaries are built from labelled text: one of ordinary words, one of the same followed by toxic text
(words of toxic documents that hold byte runs tied to the label). Every window of a few words of a text is compressed
with both; a window that gets shorter with the second is evidence. Thresholds on the differences are calibrated by a
logistic fit on the same labelled sample. The dictionaries are content dictionaries: those that zstandard trains with
entropy tables told the classes apart less well (README).
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adweave.llm.common import fold_of

SAMPLE = 2_000  # labelled documents of each class that the dictionaries are built from
GRAMS = (4, 5, 6)
CLEARLY = 4  # times that a byte run must be more frequent in toxic documents
CHANCE = 0.03  # of taking a run that is not
STEPS = (2, 3, 4, 5, 6, 8)


@dataclass(frozen=True)
class Model:
    ordinary: bytes
    toxic: bytes
    window: int
    level: int
    weights: tuple[float, ...]  # the last is the intercept


def windows(text: str | None, words: int) -> list[bytes]:
    """The text in windows of ``words`` words, lower-case; a text without words is one empty window."""
    held = (text or "").lower().encode("utf-8", "surrogatepass").split()
    return [b" ".join(held[i : i + words]) for i in range(0, len(held), words)] or [b""]


class Lengths:
    """Compressed lengths of windows with both dictionaries."""

    def __init__(self, model: Model):
        self.coders = []
        for content in (model.ordinary, model.toxic):
            held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(level=model.level)
            plain = zstandard.ZstdCompressionParameters.from_level(model.level, write_checksum=0, write_content_size=0, write_dict_id=0)
            self.coders.append(zstandard.ZstdCompressor(dict_data=held, compression_params=plain))

    def gain(self, parts: list[bytes]) -> np.ndarray:
        """Bytes that the toxic dictionary saves on each window."""
        a, b = ([len(x) for x in coder.multi_compress_to_buffer(parts, threads=0)] if any(parts) else [0] * len(parts) for coder in self.coders)
        return np.asarray(a) - np.asarray(b)


def features(gain: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Per document: largest gains, and how many windows reach each step (log, and as a share)."""
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((-gain, owner))
    ranked = gain[order]
    n = np.diff(bounds)
    top = [np.where(n > k, ranked[np.minimum(bounds[:-1] + k, len(ranked) - 1)], 0) for k in (0, 1, 3)]
    columns = [*top]
    for step in STEPS:
        many = np.bincount(owner[gain >= step], minlength=len(n))
        columns += [np.log1p(many), many / n]
    return np.stack([*columns, np.log1p(n)], axis=1).astype(float)


def _distinct(rows: list[tuple]) -> list[tuple]:
    """Without documents that share a third of their long words with earlier ones: copies say nothing new about a word.

    Compared are the smallest hashes; a text with fewer than six long words is no copy.
    """
    seen: set = set()
    out = []
    for row in rows:
        keys = sorted({crc32(w) for w in row[0].lower().encode("utf-8", "surrogatepass").split() if len(w) > 6})[:12]
        if len(keys) < 6 or 3 * sum(k in seen for k in keys) < len(keys):
            out.append(row)
        seen.update(keys)
    return out


def _grams(word: bytes) -> set[bytes]:
    return {word[i : i + n] for n in GRAMS for i in range(len(word) - n + 1)}


def _clearly(a: int, b: int, n1: int, n0: int) -> bool:
    """Whether a of n1 against b of n0 documents is ``CLEARLY`` more often: if it weren't, so many would be in the first with a chance under ``CHANCE``."""
    p = CLEARLY * n1 / (CLEARLY * n1 + n0)
    if a <= p * (a + b):
        return False
    term = math.exp(math.lgamma(a + b + 1) - math.lgamma(a + 1) - math.lgamma(b + 1) + a * math.log(p) + b * math.log1p(-p))
    chance = 0.0
    for k in range(b, -1, -1):  # of the a + b documents, k in the second class or fewer
        chance += term
        term *= k / (a + b - k + 1) * p / (1 - p)
    return chance < CHANCE


def train(sample: list[tuple[str, int]], share: float, window: int = 4, level: int = 6) -> Model:
    """Fits dictionaries and thresholds to (text, label) rows; ``share`` is the label's share in all training rows.

    Without rows of both classes the model gives ``share`` to every text.
    """
    rows = _distinct([(t or "", y) for t, y in sample])
    totals = Counter(y for _, y in rows)
    prior = math.log(max(share, 1e-6) / max(1 - share, 1e-6))
    flat = (*[0.0] * (3 + 2 * len(STEPS) + 1), prior)
    if not totals[0] or not totals[1]:
        return Model(b" ", b" ", window, level, flat)
    of_word: dict[bytes, set[bytes]] = {}
    seen = (Counter(), Counter())
    words = (Counter(), Counter())
    for text, y in rows:
        held = set(text.lower().encode("utf-8", "surrogatepass").split())
        words[y].update(held)
        grams: set[bytes] = set()
        for w in held:
            if len(w) < 40:  # longer runs are no words
                if w not in of_word:
                    of_word[w] = _grams(w)
                grams |= of_word[w]
        seen[y].update(grams)
    tied = {g for g, a in seen[1].items() if a >= 2 and _clearly(a, seen[0][g], totals[1], totals[0])}
    of_class = [(a, w) for w, a in words[1].items() if not of_word.get(w, tied).isdisjoint(tied) and words[0][w] * totals[1] <= a * totals[0] / 4]
    ordinary = b" ".join(w for w, _ in words[0].most_common(1_500))
    toxic = b" ".join(w for _, w in sorted(of_class)[-400:])
    model = Model(ordinary or b" ", (ordinary + b" " + toxic) or b" ", window, level, flat)
    lengths = Lengths(model)
    parts = [windows(t, window) for t, _ in rows]
    bounds = np.cumsum([0, *map(len, parts)])
    x = features(lengths.gain([w for p in parts for w in p]), bounds)
    y = np.asarray([label for _, label in rows], float)
    weight = np.where(y == 1, share / totals[1], (1 - share) / totals[0]) * len(rows)
    return Model(model.ordinary, model.toxic, window, level, tuple(_logistic(x, y, weight)))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    x = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.eye(x.shape[1]) * ridge
    penalty[-1, -1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = weight * p * (1 - p)
        step = np.linalg.solve((x.T * slope) @ x + penalty, x.T @ (weight * (p - y)) + penalty @ w)
        w -= step
        if np.abs(step).max() < 1e-7:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text", folds: int = 5, held_fold: int = 0, sample: int = SAMPLE) -> Model:
    """A model from a sample of at most ``sample`` labelled documents of each class outside the held-out fold.

    Only labels 0 and 1 count. The sample is the rows with the smallest hashes of their ids; the label's share is taken
    over all labelled rows outside the fold. Of rows with equal ids one label is used.
    """
    usable = labels.select(F.col(id_col), F.col(label_col).cast("int").alias("_label")).where("_label in (0, 1)").where(fold_of(id_col, folds) != held_fold)
    usable = usable.groupBy(id_col).agg(F.max("_label").alias("_label"))
    counts = {r["_label"]: r["n"] for r in usable.groupBy("_label").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = [usable.where(F.col("_label") == y).orderBy(F.xxhash64(id_col), id_col).limit(sample) for y in (0, 1)]
    picked = F.broadcast(chosen[0].unionByName(chosen[1]))  # at most 2 x sample ids
    rows = docs.select(id_col, F.col(text_col).cast("string").alias("_text")).join(picked, id_col).orderBy(F.xxhash64(id_col), id_col, F.xxhash64("_text")).limit(2 * sample)
    data = [(r["_text"], r["_label"]) for r in rows.select("_text", "_label").collect()]
    total = sum(counts.values())
    return train(data, counts.get(1, 0) / total if total else 0.0)


def score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """The rows of ``docs`` with a score from 0 to 1 of their whole texts; null texts count as empty.

    All other columns stay as they are; one named ``score_col`` is replaced. An empty table gives no rows.
    """
    docs = docs.drop(score_col)
    at = docs.columns.index(text_col)

    def run(batches):
        lengths, weights = Lengths(model), np.asarray(model.weights)
        for batch in batches:
            scores = np.empty(len(batch))
            start = 0
            texts = batch.column(at).cast(pa.string())
            parts: list[list[bytes]] = []
            held = 0
            for k in range(len(texts) + 1):
                if k == len(texts) or held > 40_000:
                    bounds = np.cumsum([0, *map(len, parts)])
                    if parts:
                        x = features(lengths.gain([w for p in parts for w in p]), bounds)
                        scores[start:k] = 1 / (1 + np.exp(-np.clip(x @ weights[:-1] + weights[-1], -30, 30)))
                    start, parts, held = k, [], 0
                if k < len(texts):
                    parts.append(windows(texts[k].as_py(), model.window))
                    held += len(parts[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], names=[*batch.schema.names, score_col])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{fields}, `{score_col}` double")
