"""Collocations against plain counts in Python, however much the sample proposes."""

import random
import re
from collections import Counter

import pytest

from adweave.llm import collocations
from tests.llm import cases


def plain_counts(rows: list[tuple]) -> Counter:
    found = Counter()
    for _, text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", cases.lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            for m in (1, 2, 3):
                found.update((lang or "und", tuple(w[i : i + m])) for i in range(len(w) - m + 1))
    return found


def plain(rows: list[tuple], least: int, most: int) -> list[tuple]:
    counts = plain_counts(rows)
    out = []
    for lang in {x for x, _ in counts}:
        f = {p: c for (x, p), c in counts.items() if x == lang and c >= least}
        n = sum(c for (x, p), c in counts.items() if x == lang and len(p) == 1)
        kept = []
        for p, a in f.items():
            if len(p) == 1 or any(100 * c >= 50 * a for q, c in f.items() if len(q) == 3 and len(p) == 2 and p in (q[:2], q[1:])):
                continue
            score, _, left, right = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, k, p.decode(), -a, left, right, n, -s) for k, (s, a, p, left, right) in enumerate(sorted(kept)[:most], 1)]
    return out


def texts(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    fixed = ["red green blue", "New York City", "a b", "ÉTÉ été x", "as well as", "zz zz zz"]
    rows = []
    for k in range(150):
        parts = []
        for _ in range(rng.randrange(12)):
            parts.append(rng.choice([rng.choice(fixed), cases.prose(rng.randrange(10**6), 3, 25), rng.choice(fixed)]))
            parts.append(rng.choice([" ", "  ", "\t", ". ", ",", "\n", "\x0b", " ; "]))
        rows.append((k // 2 if k % 9 else None, "".join(parts), rng.choice(["en", "en", "fr", None])))
    return rows + [(1, None, "en"), (1, "", "de"), (2, "...", "de"), (3, "only once here", "de"), (4, "x " * 3_000, "en"), (4, "x " * 3_000, "en"), (5, "a" * 9_000, "fr")]


def frame(spark, rows: list[tuple]):
    return spark.createDataFrame([(i, t, lang, 1, "x", 0.5) for i, t, lang in rows], "doc_id long, text string, lang string, chunk long, phrase string, n double")


@pytest.mark.parametrize(("sample", "lowered", "chunk_bytes"), [(0.25, 0.8, 900), (0.02, 0.8, 6 << 20), (0.6, 0.1, 4_000)])
def test_collocations(spark, sample, lowered, chunk_bytes):
    rows = texts(1)
    got = collocations.collocations(frame(spark, rows), least=5, most=15, sample=sample, lowered=lowered, chunk_bytes=chunk_bytes).collect()
    assert cases.ordered(got) == cases.ordered(plain(rows, 5, 15))
    assert {r["lang"] for r in got} == {"en", "fr", "und"}


def test_every_frequent_phrase_is_counted_once_and_wholly(spark):
    rows = texts(2)
    got = collocations.frequent_phrases(frame(spark, rows), least=4, sample=0.0).collect()  # nothing is proposed
    want = plain_counts(rows)
    assert cases.ordered((r["lang"], r["phrase"], r["n"]) for r in got if r["size"]) == cases.ordered((x, " ".join(p), c) for (x, p), c in want.items() if c >= 4)
    assert {r["turn"] for r in got} == {1, 2, 3}
    totals = Counter()
    for (lang, p), c in want.items():
        totals[lang] += c * (len(p) == 1)
    assert {r["lang"]: r["n"] for r in got if not r["size"]} == totals
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("llm_chunks")]


def test_thresholds_of_more_than_a_byte(spark):
    rows = texts(4) + [(900 + k, "New York City, " * 40, "en") for k in range(12)]
    got = collocations.frequent_phrases(frame(spark, rows), least=400).collect()
    assert cases.ordered((r["lang"], r["phrase"], r["n"]) for r in got if r["size"]) == cases.ordered((x, " ".join(p), c) for (x, p), c in plain_counts(rows).items() if c >= 400)
    assert len(got) > 6


def test_everything_proposed_needs_one_pass(spark):
    got = collocations.frequent_phrases(frame(spark, texts(3)), least=4, sample=1.0, lowered=0.05).collect()
    assert {r["turn"] for r in got} == {1}


def test_empty_and_wordless(spark):
    assert collocations.collocations(frame(spark, [])).count() == 0
    assert collocations.collocations(frame(spark, [(1, None, "en"), (2, " .\n", None), (3, "", "fr")])).count() == 0


def test_scores_are_exact_beyond_64_bits(spark):
    big = 900_000_000_000
    rows = [("en", "a", 1, big + 7), ("en", "b", 1, big + 9), ("en", "a b", 2, big + 1), ("en", None, 0, 5 * big)]
    got = collocations.scored(spark.createDataFrame(rows, "lang string, phrase string, size int, n long")).collect()
    assert [r["score"] for r in got] == [1_000_000 * (big + 1) ** 2 // ((big + 7) * (big + 9))] and got[0]["n"] == 5 * big
