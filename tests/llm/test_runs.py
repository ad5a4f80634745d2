"""Periodic runs against a plain search of every period, and the query's contract in plain Python."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from adweave.llm import periodic_runs, queries
from tests.llm import cases


def plain_runs(w: list, times: int = 4, least: int = 6) -> list[tuple]:
    n, found = len(w), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(least, times * q):
                found.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted((s, length, q) for (s, length), q in found.items())


def kept(w: list, found: list[tuple]) -> list:
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    return [x for i, x in enumerate(w) if i not in gone]


def looped(doc_id, w: list) -> list:
    h = zlib.crc32(str(doc_id if doc_id is not None else "").encode())
    g, n = h // 10, len(w)
    if h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def in_arrays(sequences: list[list[int]], times: int, least: int) -> list[list[tuple]]:
    offsets = np.cumsum([0, *map(len, sequences)])
    start, length, period = periodic_runs.runs(np.asarray([c for s in sequences for c in s], np.int64), offsets, times, least)
    owner = np.searchsorted(offsets, start, side="right") - 1
    out: list[list[tuple]] = [[] for _ in sequences]
    for k, s, n, q in zip(owner, start, length, period, strict=True):
        out[k].append((s - offsets[k], n, q))
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=40), min_size=1, max_size=5), st.sampled_from([(4, 6), (2, 2), (3, 1)]))
def test_runs_of_small_alphabets(sequences, rule):
    assert in_arrays(sequences, *rule) == [plain_runs(s, *rule) for s in sequences]


def test_runs_of_long_repetitions():
    rng = random.Random(3)
    sequences = []
    for k in range(25):
        block = [rng.randrange(3) for _ in range(rng.randrange(1, 25))]
        body = block * rng.randrange(2, 9) + block[: rng.randrange(len(block))]
        head = [rng.randrange(6) for _ in range(rng.randrange(10))]
        sequences.append(head + body + body[: rng.randrange(len(body))] + [rng.randrange(6) for _ in range(rng.randrange(9))] + [k % 3] * rng.randrange(12))
    sequences += [[1] * 700, [0, 1] * 400 + [0], [], [5]]
    for rule in ((4, 6), (2, 2)):
        assert in_arrays(sequences, *rule) == [plain_runs(s, *rule) for s in sequences]


def test_common_prefixes_and_order():
    rng = random.Random(5)
    sequences = [[rng.randrange(2) for _ in range(n)] for n in (50, 0, 33, 1)]
    offsets = np.cumsum([0, *map(len, sequences)])
    codes = np.asarray([c for s in sequences for c in s])
    suffixes = periodic_runs.Suffixes(codes, offsets)
    want = sorted(range(len(codes)), key=lambda i: (np.searchsorted(offsets, i, side="right"), codes[i : suffixes.ends[i]].tolist()))
    assert suffixes.array.tolist() == want
    i, j = np.asarray([(a, b) for a in range(50) for b in range(50) if a != b]).T
    plain = [next((k for k in range(50) if max(a, b) + k >= 50 or codes[a + k] != codes[b + k]), 50) for a, b in zip(i, j, strict=True)]
    assert suffixes.common(i, j).tolist() == plain


@pytest.mark.parametrize("slice_bytes", [300, 2 << 20])
def test_find_runs(spark, slice_bytes):
    rows = cases.odd_texts()
    rng = random.Random(9)
    for k in range(30):
        block = cases.prose(k, rng.randrange(1, 9), 6)
        rows.append((50 + k // 2, f"{cases.prose(90 + k, 7)} {' '.join([block] * rng.randrange(3, 9))}\n{cases.prose(k, 5)}"))
    got = periodic_runs.find_runs(cases.table(spark, rows), slice_bytes=slice_bytes).collect()
    want = []
    for i, text in rows:
        w = cases.words(text)
        found = plain_runs(w)
        want.append((i, len(w), found, " ".join(kept(w, found))))
    assert cases.ordered((r[0], r[1], [tuple(x) for x in r["runs"]], r[3]) for r in got) == cases.ordered(want)
    assert sum(len(r["runs"]) for r in got) > 15
    assert periodic_runs.find_runs(cases.table(spark, [])).count() == 0
    with pytest.raises(ValueError):
        periodic_runs.find_runs(cases.table(spark), times=1)


def test_query(spark, tmp_path):
    rows = cases.odd_texts() + [(500 + k, cases.prose(k, 3 + 7 * k, 12)) for k in range(60)]
    cases.table(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op13_periodic_runs(spark, str(tmp_path)).collect()
    want = []
    for i, text in rows:
        w = looped(i, cases.words(text))
        found = plain_runs(w)
        best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        want.append((i, len(found), *top, sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(" ".join(kept(w, found)))))
    columns = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    assert cases.ordered(tuple(r[c] for c in columns) for r in got) == cases.ordered(want)
    assert sum(r["n_runs"] for r in got) > 3
