"""Language proportions of documents by mixture inference (operator 12).

A language is a distribution of letter 3-grams, interpolated with 2-grams and single letters. The likelihood of a word
under each language is that of its letters and its end; n-grams fall into a fixed number of slots, so a model's size
depends on the number of languages alone. Expectation-maximisation finds a document's proportions of languages from the
likelihoods of its words. The languages in it are chosen by penalised likelihood: sets grow by the language with the
next largest proportion, each is fitted anew, and the one with the best log-likelihood less a penalty for each further
language stays.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adweave.llm.common import fold_of
from adweave.llm.tokens import slices

SLOTS = 1 << 16  # n-grams of one length share so many counts
STRENGTH = 8.0  # counts that the shorter n-gram's probability stands for
PENALTY = 2.0  # times the logarithm of the number of words: what a further language has to gain
ROUNDS = 60  # most rounds of expectation-maximisation for one set
CLOSE = 1e-4  # rounds end when no proportion moves by more
SLICE_BYTES = 3 << 20
HELD_LANGUAGES = 64  # languages whose counts a task holds before it sends them on

NONE = "und"
MIX = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))


@dataclass(frozen=True)
class Model:
    languages: list[str]  # sorted
    counts: np.ndarray  # languages x 5 x SLOTS: n-grams of 1, 2 and 3 letters, then their contexts of 1 and 2


class Letters:
    """The distinct words of some texts and their n-grams, in lower case; other characters than letters end a word's runs."""

    def __init__(self, texts: pa.Array):
        lists = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
        bounds = lists.offsets.to_numpy().astype(np.int64)
        coded = lists.flatten().dictionary_encode()
        self.offsets = bounds - bounds[0]
        self.words = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.n_words = len(coded.dictionary)
        joined = " ".join(coded.dictionary.to_pylist())
        points = np.frombuffer((joined + " ").encode("utf-32-le"), np.uint32).astype(np.int64)
        word = np.cumsum(points == 32) - (points == 32)  # a word's closing blank belongs to it
        kinds = np.flatnonzero(np.bincount(points))
        folded = np.zeros(int(kinds[-1]) + 1, np.int64)
        for k in kinds.tolist():
            if chr(k).isalpha():
                low = chr(k).lower()
                folded[k] = ord(low) if len(low) == 1 and low.isalpha() else k
        points = folded[points]
        one = np.concatenate([[0, 0], points])  # a blank before the first word
        a, b, c = one[2:], one[1:-1], one[:-2]
        real = (a > 0) | (b > 0)
        self.word, a, b, c = word[real], a[real], b[real], np.where(b > 0, c, 0)[real]
        self.slots = [_slot(a), _slot(a, b), _slot(a, b, c)]
        self.contexts = [_slot(b), _slot(b, c)]
        self.has_letter = np.bincount(self.word, weights=a > 0, minlength=self.n_words) > 0


def _slot(*points: np.ndarray) -> np.ndarray:
    mixed = np.zeros(len(points[0]), np.uint64)
    for k, x in enumerate(points):
        mixed = (mixed ^ (x.astype(np.uint64) + np.uint64(k + 1))) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return (mixed & np.uint64(SLOTS - 1)).astype(np.int64)


def _counts(letters: Letters, words: np.ndarray) -> np.ndarray:
    """Counts of the n-grams of the words with these numbers: 5 x SLOTS, the n-grams by length, then the contexts."""
    often = np.bincount(words, minlength=letters.n_words).astype(np.float64)[letters.word]
    return np.stack([np.bincount(s, weights=often, minlength=SLOTS) for s in [*letters.slots, *letters.contexts]]).astype(np.int64)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 5, held_fold: int | None = 0) -> Model:
    """The distribution of every language, from all rows with a text and a language outside fold ``held_fold``.

    The fold is crc32 of the id as text modulo ``folds`` (a null id counts as the empty text); without ``held_fold`` all
    rows count. A task adds up the counts of its rows; the driver gets the sums, 5 x SLOTS numbers a language at most.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).where("text is not null and lang is not null")
    if held_fold is not None:
        rows = rows.where(fold_of("doc_id", folds) != held_fold)

    def count(batches):
        held: dict[str, np.ndarray] = {}

        def sent():
            for lang, counts in held.items():
                at = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(counts[at])], names=["lang", "slot", "n"])
            held.clear()

        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                letters = Letters(part.column("text"))
                names = part.column("lang").dictionary_encode()
                owner = np.repeat(names.indices.to_numpy(zero_copy_only=False), np.diff(letters.offsets))
                for k, lang in enumerate(names.dictionary.to_pylist()):
                    counts = _counts(letters, letters.words[owner == k]).ravel()
                    held[lang] = held[lang] + counts if lang in held else counts
                    if len(held) >= HELD_LANGUAGES:
                        yield from sent()
        yield from sent()

    parts = rows.select("text", "lang").mapInArrow(count, "lang string, slot int, n long")
    sums = parts.groupBy("lang", "slot").agg(F.sum("n").alias("n")).toArrow()
    languages = sorted(set(sums["lang"].to_pylist()))
    counts = np.zeros((len(languages), 5 * SLOTS))
    place = {lang: k for k, lang in enumerate(languages)}
    codes = sums["lang"].combine_chunks().dictionary_encode() if len(sums) else None
    if codes is not None:
        codes = codes.combine_chunks() if isinstance(codes, pa.ChunkedArray) else codes
        row = np.asarray([place[x] for x in codes.dictionary.to_pylist()])[codes.indices.to_numpy(zero_copy_only=False)]
        counts[row, sums["slot"].to_numpy()] = sums["n"].to_numpy()
    return Model(languages, counts.reshape(len(languages), 5, SLOTS).astype(np.float32))


def word_scores(letters: Letters, model: Model) -> np.ndarray:
    """Log-likelihood of each distinct word under each language: words x languages."""
    out = np.empty((letters.n_words, len(model.languages)))
    one, two, three = letters.slots
    after_one, after_two = letters.contexts
    for k, (c1, c2, c3, n1, n2) in enumerate(model.counts):
        p = (c1[one] + 0.5) / (c1.sum(dtype=np.float64) + 0.5 * SLOTS)
        p = (c2[two] + STRENGTH * p) / (n1[after_one] + STRENGTH)
        p = (c3[three] + STRENGTH * p) / (n2[after_two] + STRENGTH)
        out[:, k] = np.bincount(letters.word, weights=np.log(p), minlength=letters.n_words)
    return out


def proportions(scores: np.ndarray, counts: np.ndarray, bounds: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(proportions, log-likelihood) of documents by expectation-maximisation.

    ``scores`` are log-likelihoods of distinct words (rows) under languages, ``counts`` their numbers, ``bounds`` the
    documents' first rows and the end (no document is empty), ``allowed`` the languages of each document.
    """
    n = len(bounds) - 1
    sizes = np.diff(bounds)
    share = allowed / allowed.sum(axis=1, keepdims=True)
    total = np.add.reduceat(counts, bounds[:-1])[:, None]
    owner = np.repeat(np.arange(n), sizes)
    best = np.where(allowed[owner], scores, -np.inf).max(axis=1)
    weight = np.exp(np.maximum(scores - best[:, None], -700)) * allowed[owner]
    likelihood = np.empty(n)
    active, rows, row_bounds, row_owner = np.arange(n), weight, bounds[:-1], owner
    row_counts = counts
    for turn in range(ROUNDS + 1):
        mixed = rows * share[active][row_owner]
        whole = mixed.sum(axis=1)
        new = np.add.reduceat(mixed * (row_counts / whole)[:, None], row_bounds, axis=0) / total[active]
        likelihood[active] = np.add.reduceat(row_counts * np.log(whole), row_bounds)
        moves = (np.abs(new - share[active]).max(axis=1) > CLOSE) & (turn < ROUNDS)
        share[active] = new
        if not moves.any():
            break
        if moves.mean() < 0.7:  # documents that have settled leave
            stay = moves[row_owner]
            kept = np.diff(np.append(row_bounds, len(row_owner)))[moves]
            active, rows, row_counts = active[moves], rows[stay], row_counts[stay]
            row_owner = np.repeat(np.arange(len(active)), kept)
            row_bounds = np.cumsum(kept) - kept
    return share, likelihood + np.add.reduceat(counts * best, bounds[:-1])


def mixtures(scores: np.ndarray, counts: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The proportions of the chosen languages of each document (0 for the others)."""
    n, k = len(bounds) - 1, scores.shape[1]
    single = np.add.reduceat(scores * counts[:, None], bounds[:-1], axis=0)
    chosen = np.zeros((n, k))
    chosen[np.arange(n), single.argmax(axis=1)] = 1
    if k == 1:
        return chosen
    value = single.max(axis=1)
    penalty = PENALTY * np.log(np.add.reduceat(counts, bounds[:-1]) + 1)
    share, most = proportions(scores, counts, bounds, np.ones((n, k), bool))
    order = np.argsort(-share, axis=1, kind="stable")
    for size in range(2, k + 1):
        # no set of this size gains more than all languages together
        open_ = np.flatnonzero(most - (size - 1) * penalty > value)
        if not len(open_):
            break
        allowed = np.zeros((len(open_), k), bool)
        np.put_along_axis(allowed, order[open_, :size], True, axis=1)
        rows = np.concatenate([np.arange(a, b) for a, b in zip(bounds[open_], bounds[open_ + 1], strict=True)])
        sizes = bounds[open_ + 1] - bounds[open_]
        fitted, likelihood = proportions(scores[rows], counts[rows], np.concatenate([[0], np.cumsum(sizes)]), allowed)
        better = likelihood - (size - 1) * penalty[open_] > value[open_]
        chosen[open_[better]] = fitted[better]
        value[open_[better]] = (likelihood - (size - 1) * penalty[open_])[better]
    return chosen


def _of_slice(ids: pa.Array, texts: pa.Array, model: Model) -> pa.RecordBatch:
    letters = Letters(texts)
    n, k = len(texts), len(model.languages)
    owner = np.repeat(np.arange(n), np.diff(letters.offsets))
    real = letters.has_letter[letters.words] if letters.n_words else np.empty(0, bool)
    pair, counts = np.unique(owner[real] * max(letters.n_words, 1) + letters.words[real], return_counts=True)
    doc, word = pair // max(letters.n_words, 1), pair % max(letters.n_words, 1)
    found, first = np.unique(doc, return_index=True)
    shares = np.zeros((n, k))
    if k and len(found):
        shares[found] = mixtures(word_scores(letters, model)[word], counts.astype(np.float64), np.append(first, len(doc)))
    top = shares.max(axis=1) if k else np.zeros(n)
    best = shares.argmax(axis=1) if k else np.zeros(n, np.int64)
    names = np.asarray([*model.languages, NONE], object)
    predicted = names[np.where(top > 0, best, k)]
    order = np.argsort(-shares, axis=1, kind="stable")
    mixes = [[{"lang": model.languages[j], "share": float(shares[i, j])} for j in order[i] if shares[i, j] > 0] for i in range(n)]
    return pa.RecordBatch.from_arrays([ids, pa.array(predicted, pa.string()), pa.array(np.clip(top, 0, 1)), pa.array(mixes, MIX)], names=["doc_id", "lang_pred", "score", "languages"])


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, languages) for every row of ``docs``, repeated rows and ids too.

    ``languages`` are the chosen languages with their shares of the text's words, largest first (ties by name);
    ``lang_pred`` is the first and ``score`` its share. Texts that are null or have no letter (Unicode), and all texts if
    the model has no languages, get ``und``, 0 and no languages. Only the text is read; whole texts count, whatever
    their length. An empty table gives no rows.
    """

    def work(batches):
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                yield _of_slice(part.column(0), part.column(1), model)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(work, "doc_id long, lang_pred string, score double, languages array<struct<lang: string, share: double>>")
