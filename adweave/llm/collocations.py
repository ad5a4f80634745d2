"""Phrase collocation mining after Toivonen (operator 11).

A sample of the documents proposes the words and word pairs that are common in it, at a lowered threshold. A full pass
then counts, exactly and over all documents, what was proposed and the negative border: everything that was not proposed
though all its parts were, that is every other word, every other pair of proposed words, and every triple of two
proposed pairs. A phrase of the border that turns out frequent is a failure: it joins the known ones, and a further pass
counts what has become a candidate by it, until no pass finds a failure.

Which parts are known is asked by chunk (``chunks``): the distinct words and pairs of a chunk travel once as hashes,
with their counts there and in the sample; each pass answers them with the round in which they became known, and whether
all occurrences of the hash together reach the threshold. A phrase is counted in the pass in which its last part became
known, so in one pass only and by all chunks alike. Phrases that cannot reach the threshold, because their hash or that
of a part does not, are counted out by that; all others by their words, so two that share a hash are told apart.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adweave.llm import chunks as C
from adweave.llm.common import saved
from adweave.llm.tokens import slices

SAMPLE = 0.25  # share of the documents that proposes phrases
LOWERED = 0.8  # the sample's threshold is this part of the expected count
CHUNK_BYTES = 6 << 20
NO_LANG = "und"
BITS = 48  # of a hash that travels
_ENOUGH = 128  # added to a round

_BLANKS, _MARKS = b"\x20\x09", b".,;:!?\x0a\x0b\x0c\x0d"
_KIND = bytes(1 if b in _BLANKS else 2 if b in _MARKS else 0 for b in range(256))
_LOW = bytes(range(256)).lower().translate(bytes.maketrans(_MARKS, b" " * len(_MARKS)))
_PAIR = np.uint64(0x9E3779B97F4A7C15)

CODES = -1  # in the place of a range: the row holds the words of a chunk as numbers
LISTS = pa.schema([("range", pa.int32()), ("chunk", pa.int64()), ("size", pa.int32()), ("hashes", pa.binary()), ("values", pa.binary()), ("counts", pa.binary())])
CHUNKS = pa.schema([*LISTS, ("langs", pa.list_(pa.string())), ("words", pa.list_(pa.string()))])
COUNTS = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("size", pa.int32()), ("n", pa.int64()), ("known", pa.bool_())])
_LISTS, _COUNTS = "range int, chunk long, size int, hashes binary, values binary, counts binary", "lang string, phrase string, size int, n long, known boolean"


def _word_hashes(langs: list[str], words: list[str]) -> np.ndarray:
    """64 bits for each (language, word)."""
    of_lang = {lang: xxhash.xxh3_64_intdigest(lang) for lang in set(langs)}
    lang = np.asarray([of_lang[x] for x in langs], np.uint64)
    return C.mixed(np.asarray([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64) ^ C.mixed(lang))


def _pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return C.mixed(C.mixed(first * _PAIR) + second)


def _numbered(key: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct keys, the number of each key among them) for keys below ``most``."""
    if most <= 8 * len(key) + 1024:
        distinct = np.flatnonzero(np.bincount(key, minlength=1))
        number = np.zeros(most, np.int64)
        number[distinct] = np.arange(len(distinct))
        return distinct, number[key]
    return np.unique(key, return_inverse=True)


class _Grams:
    """The words and pairs of a chunk, numbered by (language, word) and by pair."""

    def __init__(self, langs: pa.Array, words: pa.Array, hashes: np.ndarray, word: np.ndarray, joined: np.ndarray):
        self.langs, self.words, self.word_hashes, self.word, self.joined = langs, words, hashes, word, joined
        self.n_words = len(words)
        at = np.flatnonzero(joined)
        pairs, number = np.unique(word[at] * self.n_words + word[at + 1], return_inverse=True)
        self.pair = np.full(len(word), -1)  # the pair that begins at each word
        self.pair[at] = number
        self.first, self.second = (pairs // self.n_words, pairs % self.n_words) if self.n_words else (pairs, pairs)
        values = np.concatenate([hashes, _pair_hashes(hashes[self.first], hashes[self.second])]) >> np.uint64(64 - BITS)
        self.hashes, self.place = np.unique(values, return_inverse=True)

    @classmethod
    def read(cls, ids: pa.Array, texts: pa.Array, lang: pa.Array, sample: float) -> _Grams:
        """From texts; ``sampled`` marks the words of the documents that propose."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = texts.buffers()[2]
        raw = data.slice(int(ends[0]), int(ends[-1] - ends[0])).to_pybytes() if data is not None else b""
        ends = ends - ends[0]
        kind = np.frombuffer(raw.translate(_KIND), np.uint8)
        plain = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(ends.tobytes()), pa.py_buffer(raw.translate(_LOW)))
        lists = pc.ascii_split_whitespace(plain)
        flat = lists.flatten()
        full = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0
        counts = np.diff(np.concatenate([[0], np.cumsum(full)])[lists.offsets.to_numpy()])
        coded = flat.filter(pa.array(full)).dictionary_encode()
        begin = kind == 0
        begin[1:] &= kind[:-1] != 0
        starts = ends[:-1][np.diff(ends) > 0]
        begin[starts] = kind[starts] == 0
        piece = np.cumsum(kind == 2, dtype=np.int32)[begin]
        owner = np.repeat(np.arange(len(texts)), counts)
        joined = (piece[1:] == piece[:-1]) & (owner[1:] == owner[:-1])  # a word and the next are in one piece

        langs = lang.dictionary_encode()
        vocabulary = max(len(coded.dictionary), 1)
        key = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)[owner] * vocabulary + coded.indices.to_numpy(zero_copy_only=False)
        distinct, word = _numbered(key, len(langs.dictionary) * vocabulary)
        names, words = langs.dictionary.take(pa.array(distinct // vocabulary)), coded.dictionary.take(pa.array(distinct % vocabulary))
        made = cls(names, words, _word_hashes(names.to_pylist(), words.to_pylist()), word, joined)
        sampled = C.mixed(pc.fill_null(ids, -1).to_numpy(zero_copy_only=False).astype(np.uint64) + _PAIR) < np.uint64(int(min(sample, 1 - 2**-50) * 2**64))
        made.sampled = sampled[owner]
        return made

    def packed(self, chunk: int) -> pa.Table:
        """The chunk's row with its words as numbers."""
        names = self.langs.dictionary_encode()
        row = {
            "range": CODES, "chunk": chunk, "size": len(self.word), "hashes": self.word_hashes.tobytes(), "values": C.planes(self.word, 4),
            "counts": C.bits(self.joined) + C.planes(names.indices.to_numpy(zero_copy_only=False), 4), "langs": names.dictionary.to_pylist(), "words": self.words.to_pylist(),
        }
        return pa.Table.from_pylist([row], schema=CHUNKS)

    @classmethod
    def unpacked(cls, rows: pa.Table) -> _Grams:
        size = rows["size"][0].as_py()
        hashes, codes, more = (rows[c][0].as_buffer() for c in ("hashes", "values", "counts"))
        bit_bytes = (max(size - 1, 0) + 7) // 8
        words = rows["words"].combine_chunks().flatten()
        names, number = rows["langs"].combine_chunks().flatten(), C.from_planes(more[bit_bytes:], 4).astype(np.int64)
        joined = C.from_bits(more[:bit_bytes], max(size - 1, 0))
        return cls(names.take(pa.array(number)), words, np.frombuffer(hashes, np.uint64), C.from_planes(codes, 4).astype(np.int64), joined)

    def lists(self, chunk: int, ranges: int, least: int) -> pa.Table:
        n = np.concatenate([np.bincount(self.word, minlength=self.n_words), np.bincount(self.pair[self.pair >= 0], minlength=len(self.first))])
        n = np.bincount(self.place, weights=n, minlength=len(self.hashes)).astype(np.int64)
        at = np.flatnonzero(self.joined & self.sampled[:-1]) if len(self.word) else np.empty(0, np.int64)
        sampled = np.concatenate([np.bincount(self.word[self.sampled], minlength=self.n_words), np.bincount(self.pair[at], minlength=len(self.first))])
        sampled = np.bincount(self.place, weights=sampled, minlength=len(self.hashes))
        return _lists(self.hashes, np.minimum(sampled, 255).astype(np.uint8), np.minimum(n, least), chunk, ranges, _width(least))

    def counts(self, found: pa.Table, turn: int, ranges: int) -> pa.Table:
        """What is counted in the pass ``turn``, by ``found``, the answers to ``lists``."""
        owners, cuts = C.cut_points(self.hashes, BITS, ranges)
        level = C.gathered(found, cuts, owners, lambda data, n: np.frombuffer(data, np.uint8), np.uint8)[self.place]
        enough, level = level >= _ENOUGH, level % _ENOUGH
        word_level, pair_level = level[: self.n_words], level[self.n_words :]
        out = []
        if turn == 1:
            totals = pc.value_counts(self.langs.take(pa.array(self.word)))
            out.append(_rows(totals.field("values"), pa.nulls(len(totals), pa.string()), 0, totals.field("counts"), False))
            at = np.flatnonzero(enough[: self.n_words])
            n = np.bincount(self.word, minlength=self.n_words)[at]
            out.append(_rows(self.langs.take(pa.array(at)), self.words.take(pa.array(at)), 1, n, word_level[at] > 0))

        a, b, enough = word_level[self.first], word_level[self.second], enough[self.n_words :]
        wanted = (np.minimum(a, b) > 0) & (np.maximum(a, b) == turn) & enough
        n = np.bincount(self.pair[self.pair >= 0], minlength=len(self.first))[wanted]
        first, second = self.first[wanted], self.second[wanted]
        out.append(_rows(self.langs.take(pa.array(first)), self._phrase(first, second), 2, n, pair_level[wanted] > 0))

        at = np.flatnonzero(self.joined[:-1] & self.joined[1:]) if len(self.word) > 2 else np.empty(0, np.int64)
        a, b = pair_level[self.pair[at]], pair_level[self.pair[at + 1]]
        at = at[(np.minimum(a, b) > 0) & (np.maximum(a, b) == turn) & enough[self.pair[at]] & enough[self.pair[at + 1]]]
        triples, n = np.unique(self.pair[at] * max(self.n_words, 1) + self.word[at + 2], return_counts=True)
        pair, third = triples // max(self.n_words, 1), triples % max(self.n_words, 1)
        out.append(_rows(self.langs.take(pa.array(third)), self._phrase(self.first[pair], self.second[pair], third), 3, n, False))
        return pa.concat_tables(out)

    def _phrase(self, *places: np.ndarray) -> pa.Array:
        return pc.binary_join_element_wise(*(self.words.take(pa.array(p)) for p in places), pa.scalar(" ", self.words.type))


def _rows(langs, phrases, size: int, n, known) -> pa.Table:
    known = np.broadcast_to(np.asarray(known), len(langs))
    return pa.table([langs.cast(pa.string()), phrases.cast(pa.string()), pa.array(np.full(len(langs), size, np.int32)), pa.array(n).cast(pa.int64()), pa.array(known)], schema=COUNTS)


def _width(least: int) -> int:
    """Bytes of a count up to ``least``."""
    return max(1, (int(least).bit_length() + 7) // 8)


def _lists(hashes: np.ndarray, values: np.ndarray, counts: np.ndarray, chunk: int, ranges: int, width: int) -> pa.Table:
    """A row for each hash range of sorted hashes, with a byte and a count for each hash."""
    owners, cuts = C.cut_points(hashes, BITS, ranges)
    rows = [
        {"range": int(r), "chunk": chunk, "size": int(b - a), "hashes": C.coded(hashes[a:b], BITS // 8), "values": values[a:b].tobytes(), "counts": C.planes(counts[a:b], width)}
        for r, a, b in zip(owners, cuts[:-1], cuts[1:], strict=True)
    ]
    return pa.Table.from_pylist(rows, schema=CHUNKS)


def _levels(table: pa.Table, threshold: int, least: int) -> list[bytes]:
    """For the lists of a range the round in which each hash became known, with ``_ENOUGH`` more if its counts reach ``least``.

    The round is 0 if the hash is not known yet, 1 by the sample, else what the list of a round (chunk -1) says.
    """
    rows = table.select(["chunk", "size", "hashes", "values", "counts"]).to_pylist()
    counts = np.concatenate([C.from_planes(r["counts"], _width(least)) for r in rows]).astype(np.int64)
    hashes = np.concatenate([C.decoded(r["hashes"], BITS // 8) for r in rows])
    values = np.concatenate([np.frombuffer(r["values"], np.uint8) for r in rows]).astype(np.int64)
    told = np.repeat([r["chunk"] < 0 for r in rows], [r["size"] for r in rows])
    order, run, starts = C.runs(hashes)
    sampled = np.add.reduceat(np.where(told, 0, values)[order], starts)
    level = np.minimum.reduceat(np.where(told, values, 255)[order], starts)
    level = np.where(sampled >= threshold, 1, np.where(level == 255, 0, level))
    level = (level + np.where(np.add.reduceat(counts[order], starts) >= least, _ENOUGH, 0)).astype(np.uint8)
    answer = np.empty(len(hashes), np.uint8)
    answer[order] = level[run]
    ends = np.cumsum([r["size"] for r in rows]).tolist()
    return [b"" if r["chunk"] < 0 else answer[b - r["size"] : b].tobytes() for b, r in zip(ends, rows, strict=True)]


def _known_lists(frequent: DataFrame, ranges: int, width: int) -> DataFrame:
    """Lists (chunk -1) of the words and pairs of (lang, phrase, turn), each with the round after its own."""

    def hashed(batches):
        for batch in batches:
            langs, phrases = batch.column(0).to_pylist(), [p.split(" ") for p in batch.column(1).to_pylist()]
            hashes = _word_hashes(langs, [p[0] for p in phrases])
            two = np.asarray([len(p) == 2 for p in phrases])
            at = np.flatnonzero(two)
            hashes[at] = _pair_hashes(hashes[at], _word_hashes([langs[k] for k in at], [phrases[k][1] for k in at]))
            hashes >>= np.uint64(64 - BITS)
            level = batch.column(2).to_numpy().astype(np.int32) + 1
            yield pa.RecordBatch.from_arrays([pa.array(C.range_of(hashes, BITS, ranges).astype(np.int32)), pa.array(hashes.view(np.int64)), pa.array(level)], names=["range", "hash", "level"])

    def listed(table: pa.Table) -> pa.Table:
        hashes, levels = table["hash"].to_numpy().view(np.uint64), table["level"].to_numpy()
        order = np.lexsort((levels, hashes))
        hashes, levels = hashes[order], levels[order].astype(np.uint8)
        new = np.ones(len(hashes), bool)
        new[1:] = hashes[1:] != hashes[:-1]
        return _lists(hashes[new], levels[new], np.zeros(int(new.sum()), np.int64), -1, ranges, width).select(LISTS.names)

    rows = frequent.select("lang", "phrase", F.col("turn").cast("int")).mapInArrow(hashed, "range int, hash long, level int")
    return rows.groupBy("range").applyInArrow(listed, _LISTS)


def frequent_phrases(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", least: int = 10, sample: float = SAMPLE, lowered: float = LOWERED, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(lang, phrase, size, n, turn) of all phrases of 1 to 3 words with ``least`` occurrences or more in their language.

    ``sample`` is the share of the documents that proposes, ``lowered`` the part of the expected count that suffices there.
    ``turn`` is the pass that counted the phrase. A row of size 0 with a null phrase has the number of words of the
    language. A phrase lies within a piece: texts (A-Z folded) are cut at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those
    into words ``[^\\x20\\x09]+``; occurrences overlap. Null languages are ``und``. The counts do not depend on the
    sample, which only decides how many passes there are (three at most).
    """
    spark = docs.sparkSession
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANG)).alias("lang")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), lang)
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges, threshold = max(8, total // C.RANGE_BYTES), max(1, round(lowered * sample * least))

    def read(batches):
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in slices(batch, "text", chunk_bytes):
                grams = _Grams.read(*part.columns, sample)
                yield from grams.lists(chunk, ranges, least).to_batches()
                yield from grams.packed(chunk).to_batches()
                chunk += 1

    # texts are read once; the chunks' words, as numbers, are bucketed, so that only answers travel to them
    name = f"llm_chunks_{uuid.uuid4().hex}"
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * total // chunk_bytes)
    rows.mapInArrow(read, f"{_LISTS}, langs array<string>, words array<string>").write.option("compression", "zstd").bucketBy(buckets, "chunk").saveAsTable(name)
    everything = spark.table(name)
    lists = everything.where(F.col("range") != CODES).select(*LISTS.names)
    texts = everything.where(F.col("range") == CODES)

    def counted(turn: int):
        def count(rows: pa.Table, found: pa.Table) -> pa.Table:
            return _Grams.unpacked(rows).counts(found, turn, ranges) if len(rows) else COUNTS.empty_table()

        return count

    frequent = None
    for turn in (1, 2, 3):
        told = lists if frequent is None else lists.unionByName(_known_lists(frequent.where("size in (1, 2)"), ranges, _width(least)))
        levels = C.answered(told, lambda table: _levels(table, threshold, least), "levels")
        parts = texts.groupBy("chunk").cogroup(levels.groupBy("chunk")).applyInArrow(counted(turn), _COUNTS)
        sums = parts.groupBy("lang", "phrase", "size").agg(F.sum("n").alias("n"), F.max("known").alias("known"))
        new = saved(sums.where((F.col("n") >= least) | (F.col("size") == 0)).withColumn("turn", F.lit(turn)), "frequent")
        frequent = new if frequent is None else frequent.unionByName(new)
        if new.where("size in (1, 2) and not known").isEmpty():
            break
    spark.sql(f"DROP TABLE {name}")
    return frequent.select("lang", "phrase", "size", "n", "turn")


def scored(frequent: DataFrame, inside_percent: int = 50) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of the candidates among ``frequent_phrases`` that no longer one takes in.

    Cutting a phrase gives score floor(1000000 a a / (l r)), in exact decimals (counts below 10^15); the lowest cut
    counts, of equal ones the first. A pair goes if it lies in a candidate of three words with
    100 f(longer) >= ``inside_percent`` * a.
    """
    phrases = frequent.where("size > 0").select("lang", "phrase", "size", F.col("n").alias("a"))
    words = F.split("phrase", " ")
    cuts = phrases.where("size > 1").withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.withColumn("left", F.array_join(F.slice(words, F.lit(1), F.col("k")), " ")).withColumn("right", F.array_join(F.slice(words, F.col("k") + 1, F.col("size") - F.col("k")), " "))
    side = lambda name, n: phrases.select("lang", F.col("phrase").alias(name), F.col("a").alias(n))
    cuts = cuts.join(side("left", "l"), ["lang", "left"]).join(side("right", "r"), ["lang", "right"])
    big = lambda c: f"cast({c} as decimal(15, 0))"
    score = F.expr(f"(cast(1000000 as decimal(7, 0)) * {big('a')} * {big('a')}) div ({big('l')} * {big('r')})")
    best = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    triples = phrases.where("size = 3")
    inner = F.explode(F.array(F.array_join(F.slice(words, 1, 2), " "), F.array_join(F.slice(words, 2, 2), " ")))
    covers = triples.select("lang", inner.alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = best.join(covers, ["lang", "phrase"], "left").where(f"longer is null or 100 * longer < {inside_percent} * a")
    totals = frequent.where("size = 0").select("lang", "n")
    return kept.join(totals, "lang").select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def collocations(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", least: int = 10, most: int = 2_000, sample: float = SAMPLE, lowered: float = LOWERED, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``most`` phrases of 2 or 3 words.

    They come by score, then ``a``, both descending, then the phrase in byte order. ``a``, ``l`` and ``r`` are the
    occurrences of the phrase and of the two parts of its lowest cut, ``n`` the words of the language. Null and empty texts have no
    words; repeated rows and ids all count; other columns are not read; a language without a candidate, or an empty
    table, gives no rows.
    """
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    found = scored(frequent_phrases(docs, id_col, text_col, lang_col, least, sample, lowered, chunk_bytes))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
    return ranked.select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")
