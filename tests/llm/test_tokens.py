"""Encoding, token files and packing against the tokenizers library."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from adweave.llm import packing, token_files
from adweave.llm.common import scratch
from adweave.llm.tokens import TextEncoder
from tests.llm import cases

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def expected(tokenizer, texts):
    return [[*e.ids, 2] for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def crc(ids) -> int:
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_words_give_the_ids_of_whole_texts(name):
    coder = TextEncoder(public_tokenizers.path(name))
    rng = random.Random(3)
    parts = [*"aZé'sÉßİſªº.,!?|<>_-0٣ \t\n\x0b\x1c\x85\xa0́漢ΣςﬁI", "<|endoftext|>", "<|ENDOFTEXT|>", "'re", "n't", "don't.", "x.́", "word. ", "Word, "]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(3_000)] + [None, "", "abc " * 5_000]
    ids, counts = coder.encode(pa.array(texts, pa.string()))
    ends = np.cumsum(counts)
    want = coder.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)
    assert all(ids[e - n : e].tolist() == w.ids for e, n, w in zip(ends, counts, want, strict=True))


def test_cache_starts_anew(tokenizer):
    coder = TextEncoder(PATH)
    coder.CACHE_WORDS = 50
    for seed in range(4):
        text = cases.prose(seed, 60, 10_000)
        assert coder.encode(pa.array([text]))[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("encoding", token_files.ENCODINGS)
def test_token_files(spark, tokenizer, encoding):
    path = scratch(spark, "test")
    rows = cases.odd_texts()
    token_files.write_token_ids(cases.table(spark), path, PATH, encoding=encoding, row_group_bytes=4_096)
    got = token_files.written_index(spark, path).orderBy("start").collect()
    ids = expected(tokenizer, [t for _, t in rows])
    assert cases.ordered((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == cases.ordered((i, len(x), crc(x)) for (i, _), x in zip(rows, ids, strict=True))
    assert [r["start"] for r in got] == np.cumsum([0, *(r["n_tokens"] for r in got)])[:-1].tolist()
    order = [r["doc_id"] for r in got]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0))
    assert [list(r["ids"]) for r in token_files.read_tokens(spark, path, [9]).collect()] == [ids[11]]


def test_token_files_of_nothing(spark):
    path = scratch(spark, "test")
    token_files.write_token_ids(cases.table(spark, []), path, PATH)
    assert token_files.written_index(spark, path).count() == 0


def test_packing(spark, tokenizer):
    rows = cases.odd_texts()
    got = packing.pack_windows(cases.table(spark), PATH, size=256).collect()
    want = expected(tokenizer, [t for _, t in rows])
    assert sorted(len(x) for x in want) == sorted(r["doc_tokens"] for r in got if r["start"] == 0)
    by_doc = {}
    for r in got:
        assert crc(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == r["length"]
        by_doc.setdefault(r["doc_id"], []).append(r)
    for (i, _), ids in zip(rows, want, strict=True):
        if sum(k == i for k, _ in rows) == 1:
            assert [x for r in sorted(by_doc[i], key=lambda r: r["start"]) for x in r["ids"]] == ids
    windows = {}
    for r in got:
        windows.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in windows.values():
        pieces.sort()
        assert [o for o, _ in pieces] == np.cumsum([0, *(n for _, n in pieces)])[:-1].tolist() and sum(n for _, n in pieces) <= 256
    assert sum(r["length"] for r in got) / (256 * len(windows)) > 0.9
    assert packing.pack_windows(cases.table(spark, []), PATH).count() == 0


def test_windows_settled_in_parts_are_whole(monkeypatch, spark, tokenizer):
    texts = [cases.prose(k, 40 + k) for k in range(60)]
    ids = expected(tokenizer, texts)
    ends = np.zeros(60_000, bool)
    stream = packing._Stream(128, 8, 4, 24, ends, 0)
    rows = []
    for k, x in enumerate(ids):
        stream.add([k], np.asarray(x, np.int32), np.asarray([len(x)]))
        if stream.held > 600:
            rows += stream.settle(last=False)
    rows += stream.settle(last=True)
    back = {}
    for key, start, length, _, total, _, _, piece in rows:
        assert len(piece) == length and total == len(ids[key])
        back.setdefault(key, []).append((start, piece.tolist()))
    assert all([x for _, p in sorted(back[k]) for x in p] == ids[k] for k in back) and len(back) == 60


def test_best_cuts_are_the_cheapest():
    rng = np.random.default_rng(1)
    for _ in range(30):
        places = np.unique(np.concatenate([[0], rng.integers(1, 120, 25), np.arange(10, 130, 10)]))
        costs = rng.integers(0, 9, len(places))
        cuts = packing.best_cuts(places, costs, 20)
        best = [0] + [None] * (len(places) - 1)
        for j in range(1, len(places)):
            best[j] = min(best[i] + 20 - (places[j] - places[i]) + costs[j] for i in range(j) if places[j] - places[i] <= 20)
        chain = [0, *cuts]
        paid = sum(20 - (places[b] - places[a]) + costs[b] for a, b in zip(chain[:-1], chain[1:], strict=True))
        assert paid == best[-1] and chain[-1] == len(places) - 1
