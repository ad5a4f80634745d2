"""Language proportions against plain counts and a plain expectation-maximisation, and held-out accuracy."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from adweave.llm import language_id, queries
from tests.llm import cases

WORDS = {"de": "der und nicht schön über Straße zwischen", "en": "the and with which thing over would", "es": "los que señor años está muy también"}


def mixed(rng: random.Random, *parts: tuple) -> str:
    return " ".join(" ".join(rng.choice(WORDS[lang].split()) for _ in range(n)) for lang, n in parts)


def training(rng: random.Random) -> list[tuple]:
    return [(1000 + k, mixed(rng, (lang, 40)), lang) for k in range(40) for lang in WORDS]


def docs(spark, rows: list[tuple]):
    return spark.createDataFrame([(i, t, lang, 0.0, "n", 1) for i, t, lang in rows], "doc_id long, text string, lang string, score double, languages string, lang_pred int")


def letters_of(word: str) -> list[str]:
    """The letters of a word in lower case, with one blank for any other characters between or after them."""
    out = [c.lower() if c.isalpha() else " " for c in word + " "]
    return [c for k, c in enumerate(out) if c != " " or (k and out[k - 1] != " ")]


def plain_counts(texts: list, length: int) -> Counter:
    """n-grams (the last letter, those before it), a word's first ones being blanks."""
    found = Counter()
    for text in texts:
        for word in (text or "").split():
            held = letters_of(word)
            for k, c in enumerate(held):
                back = [held[k - b] if k >= b else " " for b in range(1, length)]
                for b in range(1, len(back)):
                    back[b] = " " if back[b - 1] == " " else back[b]
                found[(c, *back)] += 1
    return found


def test_counts_are_those_of_all_training_rows(spark):
    rows = training(random.Random(1))[:30] + [(1, None, "de"), (2, "the thing", None), (3, "", "en"), (None, "über ü.ü2ß don't", "de")]
    model = language_id.fit(docs(spark, rows), held_fold=0)
    held = [(i, t, lang) for i, t, lang in rows if lang and t is not None and zlib.crc32(str("" if i is None else i).encode()) % 5]
    assert model.languages == sorted({lang for _, _, lang in held})
    for k, lang in enumerate(model.languages):
        for n in (1, 2, 3):
            want = Counter()
            for gram, count in plain_counts([t for _, t, x in held if x == lang], n).items():
                points = [np.asarray([0 if c == " " else ord(c)]) for c in gram]
                want[int(language_id._slot(*points)[0])] += count
            got = model.counts[k, n - 1]
            assert {s: int(got[s]) for s in np.flatnonzero(got)} == want
    assert language_id.fit(docs(spark, []), held_fold=0).languages == []


def test_scores_are_products_of_letters(spark):
    model = language_id.fit(docs(spark, training(random.Random(2))), held_fold=None)
    letters = language_id.Letters(pa.array(["schön don't", "ÜBER x1y 77"]))
    got = language_id.word_scores(letters, model)
    slot = lambda gram: int(language_id._slot(*[np.asarray([0 if c == " " else ord(c)]) for c in gram])[0])
    for w, word in enumerate(["schön", "don't", "ÜBER", "x1y", "77"]):
        for k in range(3):
            c1, c2, c3, n1, n2 = model.counts[k]
            total, held = 0.0, letters_of(word)
            for j, a in enumerate(held):
                b = held[j - 1] if j else " "
                c = held[j - 2] if j > 1 and b != " " else " "
                p = (c1[slot(a)] + 0.5) / (c1.sum() + 0.5 * language_id.SLOTS)
                p = (c2[slot((a, b))] + language_id.STRENGTH * p) / (n1[slot(b)] + language_id.STRENGTH)
                total += math.log((c3[slot((a, b, c))] + language_id.STRENGTH * p) / (n2[slot((b, c))] + language_id.STRENGTH))
            assert got[w, k] == pytest.approx(total)


def plain_mixture(scores: list[list[float]], counts: list[int]) -> list[float]:
    def fitted(allowed: list[int]) -> tuple[list[float], float]:
        share = [1 / len(allowed) if k in allowed else 0.0 for k in range(len(scores[0]))]
        for turn in range(language_id.ROUNDS + 1):
            new, value = [0.0] * len(share), 0.0
            for s, n in zip(scores, counts, strict=True):
                top = max(s[k] for k in allowed)
                parts = [p * math.exp(x - top) if k in allowed else 0.0 for k, (p, x) in enumerate(zip(share, s, strict=True))]
                value += n * (math.log(sum(parts)) + top)
                for k, x in enumerate(parts):
                    new[k] += n * x / sum(parts) / sum(counts)
            move = max(abs(a - b) for a, b in zip(new, share, strict=True))
            share = new
            if move <= language_id.CLOSE:
                break
        return share, value

    penalty = language_id.PENALTY * math.log(sum(counts) + 1)
    single = [sum(s[k] * n for s, n in zip(scores, counts, strict=True)) for k in range(len(scores[0]))]
    best, value = [float(k == single.index(max(single))) for k in range(len(single))], max(single)
    share, most = fitted(list(range(len(single))))
    order = sorted(range(len(single)), key=lambda k: -share[k])
    for size in range(2, len(single) + 1):
        if most - (size - 1) * penalty <= value:
            continue
        made, likelihood = fitted(order[:size])
        if likelihood - (size - 1) * penalty > value:
            best, value = made, likelihood - (size - 1) * penalty
    return best


def test_mixtures_are_those_of_plain_rounds():
    rng = np.random.default_rng(3)
    sizes = [1, 4, 30, 12, 60, 25]
    scores, counts, want = [], [], []
    for k, n in enumerate(sizes):
        made = rng.normal(-20, 3, (n, 4))
        for j in range(n):
            made[j, (k + j * (k % 3)) % 4] += 9
        times = rng.integers(1, 4, n)
        scores.append(made)
        counts.append(times)
        want.append(plain_mixture(made.tolist(), times.tolist()))
    got = language_id.mixtures(np.concatenate(scores), np.concatenate(counts).astype(float), np.cumsum([0, *sizes]))
    assert np.allclose(got, want, atol=1e-9)
    assert {int((row > 0).sum()) for row in got} >= {1, 2}


def test_identify(spark):
    rng = random.Random(4)
    model = language_id.fit(docs(spark, training(rng)), held_fold=None)
    rows = [
        (1, mixed(rng, ("de", 60)), "en"), (2, mixed(rng, ("de", 60), ("en", 30)), None), (2, mixed(rng, ("es", 20)), "x"), (3, None, "de"), (4, "", "de"), (5, "12 345 ... !", "de"), (None, "señor", None),
        (6, mixed(rng, ("en", 4000), ("es", 9000)), "en"), (7, mixed(rng, ("en", 4)), "en"), (7, mixed(rng, ("en", 4)), "en"),
    ]
    got = language_id.identify(docs(spark, rows), model).collect()
    assert cases.ordered((r["doc_id"], r["lang_pred"]) for r in got) == cases.ordered([(1, "de"), (2, "de"), (2, "es"), (3, "und"), (4, "und"), (5, "und"), (None, "es"), (6, "es"), (7, "en"), (7, "en")])
    by = {(r["doc_id"], r["lang_pred"]): r for r in got}
    assert by[1, "de"]["score"] == 1 and by[5, "und"]["score"] == 0 and by[5, "und"]["languages"] == []
    shares = {m["lang"]: m["share"] for m in by[2, "de"]["languages"]}
    assert set(shares) == {"de", "en"} and shares["de"] == pytest.approx(2 / 3, abs=0.06)
    assert by[6, "es"]["score"] == pytest.approx(9 / 13, abs=0.03)
    assert language_id.identify(docs(spark, []), model).count() == 0
    none = language_id.identify(docs(spark, rows), language_id.fit(docs(spark, []))).collect()
    assert {r["lang_pred"] for r in none} == {"und"} and len(none) == len(rows)


def test_query_on_held_out_documents(spark, sf_dir):
    got = queries.op12_language_id(spark, sf_dir)
    truth = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    held = got.where("held_out").join(truth, "doc_id").collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in held)
    assert got.count() == truth.count() and len(held) > 10
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.95 * len(held)
