"""Operators on whole texts against plain versions."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql.functions import col as F_col

from adweave.llm import decontamination, lm_scoring, ngram_join, pii, secret_scan, spans, substring_dedup, toxicity
from tests.llm import cases


@pytest.mark.parametrize("window", [1, 4, 35])
def test_substring_dedup(spark, window):
    rows = cases.odd_texts()
    got = substring_dedup.remove_repeats(cases.table(spark), window=window).collect()
    want = [(i, *k) for (i, _), k in zip(rows, cases.kept_words([t for _, t in rows], window), strict=True)]
    assert cases.ordered((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in got) == cases.ordered(want)
    assert all(sum(s["length"] for s in r["spans"]) == r["n_removed"] for r in got)
    assert substring_dedup.remove_repeats(cases.table(spark, [])).count() == 0
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("llm_chunks")]  # nor of the other operators


@pytest.mark.parametrize(("size", "percent"), [(3, 90), (5, 80), (2, 50)])
def test_ngram_join(spark, size, percent):
    rows = cases.odd_texts()
    base = cases.prose(20, 60).split()
    rng = random.Random(4)
    for k in range(40):  # a group of near copies, more than make a shingle frequent
        near = list(base)
        for _ in range(k % 4):
            near[rng.randrange(60)] = f"w{k}"
        rows.append((100 + k, " ".join(near)))
    rows += [(200 + k, " ".join(base[k % 7 : k % 7 + 9 + k % 3])) for k in range(30)]
    got = ngram_join.similar_documents(cases.table(spark, rows), words=size, percent=percent).collect()
    assert cases.ordered(r[:3] for r in got) == cases.ordered(cases.components(rows, size, percent))


def test_class_counts_are_compared_only_where_sizes_fit(spark):
    """What a condition repeats is worked out before the conditions in front of it, for every pair."""
    text = str(ngram_join._overlap_fits("i", "j", 90)) + str(ngram_join._fits("i", "j", 90))
    assert text.count("aggregate(") == 1 and text.count("floor(") == 1
    rng = random.Random(2)
    rows = []
    for k in range(300):
        cells = [[rng.randrange(3) for _ in range(ngram_join.CELLS)] for _ in range(2)]
        if k % 2:
            cells[1] = [max(x - (rng.random() < 0.1), 0) for x in cells[0]]
        wide = [[sum(c[at : at + ngram_join.CELLS // ngram_join.WIDE]) for at in range(0, ngram_join.CELLS, ngram_join.CELLS // ngram_join.WIDE)] for c in cells]
        sizes = [sum(c) for c in cells]
        rows.append((*cells, *wide, *sizes, *(rng.randrange(s // 8) for s in sizes)))
    names = "cells_i array<int>, cells_j array<int>, wide_i array<int>, wide_j array<int>, size_i long, size_j long, alone_i long, alone_j long"
    for percent in (50, 80, 90, 100):
        got = spark.createDataFrame(rows, names).select("*", ngram_join._fits("i", "j", percent).alias("f"), ngram_join._overlap_fits("i", "j", percent).alias("o")).collect()
        for r in got:
            both = r.size_i + r.size_j
            most = min(r.size_i - r.alone_i, r.size_j - r.alone_j, (both - r.alone_i - r.alone_j) // 2)
            shared = sum(map(min, r.cells_i, r.cells_j))
            assert r.f == (100 * most >= percent * (both - most)) and r.o == (100 * shared >= percent * (both - shared))


def test_sets_that_share_many_signatures_are_listed_once(spark):
    """A pair was listed for each signature in common. None may be lost, also not where the smallest signatures differ."""
    rng = random.Random(2)
    signatures = {k: set(rng.sample(range(-300, 300), 280)) for k in range(6)}  # most in common
    signatures |= {k: {-500 - 100 * k - i for i in range(60)} | {900 + k // 2} for k in range(6, 12)}  # two in two share one, the largest they have
    signatures |= {12: {1007}, 13: {1007, 1008}, 14: {1008}}
    component = {k: k // 2 if k < 6 else k for k in signatures}
    rows = [
        (sig, bytes([k]), 100, 0, bytes([component[k]]), [100] * ngram_join.CELLS, [100 * ngram_join.CELLS // ngram_join.WIDE] * ngram_join.WIDE, 20 + k % 2)
        for k, held in signatures.items() for sig in held
    ]
    placed = spark.createDataFrame(rows, "sig long, node binary, size long, alone long, resolved_id binary, cells array<int>, wide array<int>, step long")
    got = Counter((r.i[0], r.j[0]) for r in ngram_join._unsettled_pairs(placed, 80).collect())
    assert set(got) == {(i, j) for i in signatures for j in signatures if i < j and component[i] != component[j] and signatures[i] & signatures[j]}
    assert all(n == 1 for n in got.values())


def test_one_row_of_each_component_stays(spark):
    docs = cases.table(spark)
    groups = ngram_join.similar_documents(docs, words=5, percent=80)
    kept = ngram_join.one_per_component(docs, groups)
    assert kept.columns == docs.columns
    ids = Counter(r["doc_id"] for r in kept.collect())
    # the base text, its copies and near copies leave the row without an id; the texts without words stay
    assert ids[1] + ids[2] + ids[3] + ids[14] == 0 and ids[None] == 2 and ids[4] == 2 and ids[5] == 2 and ids[6] == ids[7] == 1
    assert ids[8] == 1 and ids[15] == 0 and ids[9] == ids[10] == 1
    empty = cases.table(spark, [])
    assert ngram_join.one_per_component(empty, ngram_join.similar_documents(empty)).count() == 0


def test_myers_is_the_edit_distance():
    rng = random.Random(1)
    for _ in range(300):
        pattern = [rng.randrange(4) for _ in range(rng.randrange(1, 12))]
        text = [rng.randrange(4) for _ in range(rng.randrange(0, 25))]
        above = [0] * (len(text) + 1)
        for k, x in enumerate(pattern, 1):
            row = [k]
            for j, y in enumerate(text, 1):
                row.append(min(above[j - 1] + (x != y), above[j] + 1, row[-1] + 1))
            above = row
        least = min(above[1:], default=None)
        got = decontamination.myers(pattern, text, 3)
        assert (got is None) == (least is None or least > 3)
        if got:
            assert got == (least, above.index(least, 1))


def test_decontamination(spark):
    items = [(1, cases.prose(50, 20)), (2, cases.prose(51, 30)), (3, None), (4, "too short"), (1, cases.prose(52, 12)), (5, "")]
    first, second = items[0][1].split(), items[1][1].split()
    cut = second[:10] + ["new"] + second[10:20] + second[21:]  # one word more, one less
    changed = ["zzz"] * 5 + first[5:]  # a quarter of the words
    docs = [
        (1, cases.prose(60, 50) + " " + " ".join(first).upper() + "! " + cases.prose(61, 9)), (2, " ".join(f"{w}," for w in cut)), (3, " ".join(changed)), (4, None), (5, ""),
        (6, cases.prose(62, 3_000)), (7, " ".join(first)), (7, " ".join(first)), (None, " ".join(second)), (8, items[4][1]),
    ]
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    got = decontamination.find_leaks(cases.table(spark, docs), bench, errors=0.2)
    want = [(1, 1, 0, 50, 20), (2, 2, 2, 0, 30), (7, 1, 0, 0, 20), (7, 1, 0, 0, 20), (None, 2, 0, 0, 30), (8, 1, 0, 0, 12)]
    assert cases.ordered(got.drop("text_key").collect()) == cases.ordered(want)
    assert decontamination.find_leaks(cases.table(spark, []), bench).count() == 0
    assert decontamination.find_leaks(cases.table(spark, docs), bench.limit(0)).count() == 0


def test_words_of_leaks_are_held_for_a_slice_of_a_batch(monkeypatch):
    """A batch of many texts is searched slice by slice, with the same result."""
    items = decontamination.prepare([(k, cases.prose(70 + k, 15)) for k in range(7)], 0.2)
    texts = [f"{cases.prose(k, 60_000)} {cases.prose(70 + k % 7, 15)}" for k in range(40)]
    batch = pa.record_batch([pa.array(range(40), pa.int64()), pa.array(texts), pa.array(range(40), pa.int64())], names=["doc_id", "text", "text_key"])
    held, plain = [], decontamination.plain_words
    monkeypatch.setattr(decontamination, "plain_words", lambda t: held.append(sum(map(len, t.to_pylist()))) or plain(t))
    rows = lambda: sorted(tuple(r.values()) for part in decontamination._leaks_of(batch, items) for r in part.to_pylist())
    found = rows()
    assert sum(held) > 2 * max(held) and max(held) < 4 << 20 and [r[:2] for r in found] == [(k, k % 7) for k in range(40)]
    monkeypatch.setattr(decontamination, "SLICE_BYTES", 1)
    assert rows() == found


def test_blocks_of_items_find_the_same(spark, monkeypatch):
    items = [(k, cases.prose(70 + k, 15)) for k in range(7)]
    docs = cases.table(spark, [(k, f"{cases.prose(k, 20)} {t}") for k, t in items])
    bench = spark.createDataFrame(items, "item_id long, text string")
    whole = cases.ordered(decontamination.find_leaks(docs, bench).collect())
    monkeypatch.setattr(decontamination, "BLOCK_ITEMS", 2)
    assert cases.ordered(decontamination.find_leaks(docs, bench).collect()) == whole and len(whole) == 7


def test_toxicity(spark):
    rng = random.Random(2)
    bad = ["grumbol", "snarfet", "klimpox"]
    rows, labels = [], []
    for k in range(400):
        w = [2 * x for x in cases.prose(1_000 + k, 60, 60).split()]
        toxic = k % 4 == 0
        for _ in range(6 * toxic):
            w[rng.randrange(60)] = rng.choice(bad)
        rows.append((k, " ".join(w)))
        labels.append((k, int(toxic), "x"))
    labels += [(None, 1, "x"), (1_000_000, None, "x"), (3, 7, "x")]
    docs, marked = cases.table(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int, text string")
    model = toxicity.fit(docs, marked)
    held = [r for r in toxicity.score(docs, model).collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert len(held) > 40 and np.mean([(r["score"] >= 0.5) == (r["doc_id"] % 4 == 0) for r in held]) > 0.9
    odd = toxicity.score(cases.table(spark), model)
    assert odd.count() == len(cases.odd_texts()) and all(0 <= r["score"] <= 1 for r in odd.collect()) and set(odd.columns) == set(cases.table(spark).columns)
    assert toxicity.score(cases.table(spark, []), model).count() == 0
    nothing = toxicity.fit(docs, marked.limit(0))
    assert {r["score"] < 1e-3 for r in toxicity.score(docs.limit(3), nothing).collect()} == {True}


def test_toxic_words_of_few_documents_count():
    for bad, good, held in ((10, 58, 4), (40, 240, 6), (400, 400, 20)):
        text = lambda k, more: " ".join(w + chr(97 + k % 26) + chr(97 + k // 26) for w in ("ab", "cd", "ef")) + more
        sample = [(text(k, " grumbol" * (k < held)), 1) for k in range(bad)] + [(text(k, ""), 0) for k in range(good)]
        model = toxicity.train(sample, 0.1)
        assert b"grumbol" in model.toxic and b"grumbol" not in model.ordinary
    assert not toxicity._clearly(3, 0, 2_000, 2_000) and not toxicity._clearly(400, 100, 2_000, 2_000)


def test_held_out_labels_do_not_matter(spark):
    docs = cases.table(spark, [(k, cases.prose(k, 30)) for k in range(60)])
    fold = [zlib.crc32(str(k).encode()) % 5 for k in range(60)]
    one = spark.createDataFrame([(k, k % 2 if fold[k] else 0) for k in range(60)], "doc_id long, toxic int")
    two = spark.createDataFrame([(k, k % 2 if fold[k] else 1) for k in range(60)], "doc_id long, toxic int")
    assert toxicity.fit(docs, one) == toxicity.fit(docs, two)


def test_lm_scoring(spark):
    rows = [*cases.odd_texts(), *((300 + k, cases.prose(k % 5, 40)) for k in range(40))]
    got = lm_scoring.score_documents(cases.table(spark, rows), vocabulary=100, passes=12).collect()
    tokens = [[*cases.words(cases.lower(t)), None] for _, t in rows]
    trained = [zlib.crc32(b"" if i is None else str(i).encode()) % 5 != 1 for i, _ in rows]
    counts = Counter(w for t, use in zip(tokens, trained, strict=True) if use for w in t)
    n, v = sum(counts.values()), len(counts)
    want = [(i, not use, len(t), sum(counts[w] > 0 for w in t), n, round(sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t), 5)) for (i, _), t, use in zip(rows, tokens, trained, strict=True)]
    assert cases.ordered((*r[:5], round(r["base_score"], 5)) for r in got) == cases.ordered(want)
    assert all(math.isfinite(r["score"]) and r["score"] <= 0 for r in got)
    assert sum(r["score"] for r in got) > sum(r["base_score"] for r in got)
    assert lm_scoring.score_documents(cases.table(spark, [])).count() == 0
    alone = lm_scoring.score_documents(cases.table(spark, [(0, None)])).first()
    assert alone["n_tokens"] == 1


def test_words_of_a_slice():
    import pyarrow as pa

    from adweave.llm import chunks

    texts = pa.array([f"Ab{k} \u00c4 {'X' * (k % 7)} cD" for k in range(200)])
    for part in (texts.slice(120), texts.slice(50, 30), pa.chunked_array([texts]).slice(120)):
        found = chunks.words_of(part, lower=True)
        want = [cases.words(cases.lower(t)) for t in part.to_pylist()]
        assert found.flat.to_pylist() == [w for t in want for w in t]
        assert found.offsets.tolist() == [0, *np.cumsum([len(t) for t in want])]


def test_lm_base_of_short_texts_beside_long_ones(spark):
    rows = [(k, cases.prose(k, 6_000) if k % 3 == 0 else f"Kurz {k % 4}") for k in range(30)]
    got = {r["doc_id"]: r["base_score"] for r in lm_scoring.score_documents(cases.table(spark, rows).coalesce(1)).collect()}
    tokens = [[*cases.words(cases.lower(t)), None] for _, t in rows]
    counts = Counter(w for k, t in enumerate(tokens) if zlib.crc32(str(k).encode()) % 5 != 1 for w in t)
    n, v = sum(counts.values()), len(counts)
    for k, t in enumerate(tokens):
        base = math.fsum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t)
        assert abs(got[k] - base) <= 1e-13 * len(t) + 1e-14 * abs(base)


def test_lm_learns_from_every_training_document(spark):
    from pyspark.sql import functions as F

    ids = [r[0] for r in spark.range(2_200).orderBy(F.xxhash64("id"), "id").collect()]
    late = set([i for i in ids if zlib.crc32(str(i).encode()) % 5 != 1][1_500:])
    rows = [(i, " ".join(["uno", "dos", "tres"] * 30) if i in late else cases.prose(i, 20)) for i in ids]
    got = lm_scoring.score_documents(cases.table(spark, rows), vocabulary=50, passes=10).where(F.col("doc_id").isin(*late)).collect()
    assert len(got) == len(late) > 100 and all(r["score"] > 0.5 * r["base_score"] for r in got)


def test_words_of_the_net_follow_their_counts(spark):
    from adweave.llm import gru

    rows = [(k, "alfa beta gamma delta rara" + str(k)) for k in range(60)]
    sizes = []
    held = gru.new_net
    try:
        gru.new_net = lambda counts, others: sizes.append(len(counts)) or held(counts, others)
        lm_scoring.score_documents(cases.table(spark, rows), vocabulary=2)
    finally:
        gru.new_net = held
    assert sizes == [5]  # four words and the end


def test_net_is_a_distribution_and_carries_its_state():
    from adweave.llm import gru

    counts = np.asarray([50.0, 30, 9, 5, 3, 2, 1])
    net = gru.new_net(counts, 4)
    stream = np.random.default_rng(0).integers(0, 8, 9_000)
    gru.train(net, stream, 3, updates=30)
    rng = np.random.default_rng(1)
    states = rng.standard_normal((3, gru.HIDDEN)).astype(np.float32)
    total = sum(np.exp(gru.log_probs(net, states, np.full(3, k))) for k in range(8))
    assert np.allclose(total, 1, atol=1e-4)
    sequences = [rng.integers(0, 8, n) for n in (1, 100, 33, 64, 2)]
    together = gru.score(net, sequences, 3)
    for s, found in zip(sequences, together, strict=True):
        h, given, want = np.zeros((1, gru.HIDDEN), np.float32), np.asarray([3]), 0.0
        for token in s:
            h = gru.step(net.gates()[given], h, net.weights["recur"])[0]
            given = np.asarray([token])
            want += gru.log_probs(net, h, given)[0]
        assert abs(want - found) < 1e-3


def test_gradients_are_the_slopes_of_the_loss():
    from adweave.llm import gru

    rng = np.random.default_rng(2)
    net = gru.new_net(rng.integers(1, 40, 11).astype(float), 5)
    for name, x in net.weights.items():
        net.weights[name] = np.where(x < -1e8, x, x + rng.standard_normal(x.shape) * 0.3).astype(np.float64)
    given, wanted = rng.integers(0, 12, (7, 5)), rng.integers(0, 12, (7, 5))
    real, h = rng.random((7, 5)) < 0.8, rng.standard_normal((5, gru.HIDDEN)) * 0.5

    def loss() -> float:
        state, total, gates = h, 0.0, net.gates()
        for t in range(7):
            state = gru.step(gates[given[t]], state * (given[t] != 3)[:, None], net.weights["recur"])[0]
            total -= gru.log_probs(net, state, wanted[t])[real[t]].sum()
        return total / real.sum()

    grads, rows, last = gru.gradients(net, given, wanted, real, h, 3)
    assert last.shape == h.shape
    for name, x in net.weights.items():
        whole = np.zeros_like(x)
        whole[rows.get(name, slice(None))] = grads[name]
        for place in rng.permutation(x.size)[:25]:
            at, kept = np.unravel_index(place, x.shape), x.ravel()[place]
            if kept < -1e8:
                continue
            x[at] = kept + 1e-5
            up = loss()
            x[at] = kept - 1e-5
            slope, x[at] = (up - loss()) / 2e-5, kept
            assert abs(slope - whole[at]) < 1e-6 + 1e-4 * abs(slope), (name, at)


def test_training_lowers_the_loss():
    from adweave.llm import gru

    stream = np.tile(np.asarray([0, 1, 2, 3]), 3_000)
    net = gru.new_net(np.asarray([3_000.0] * 4), 0)
    before = gru.score(net, [stream[:400]], 3)[0]
    gru.train(net, stream, 3, updates=150)
    assert gru.score(net, [stream[:400]], 3)[0] > 0.5 * before


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = int(c) * (2 if k % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")), "card": lambda: 16 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 8 <= len(digits) <= 15}[kind]():
                out.append((kind, m.start(), m.end()))
    return out


def test_base_spans(spark):
    rng = random.Random(5)
    parts = [*"aZ9.@+-_%() 0147", "a@b.cc", "+49 171 ", "é", "𝔘", "10.0.0.1", "4111 1111 1111 1111", "255.", "\n"]
    rows = [(k, "".join(rng.choice(parts) for _ in range(rng.randrange(60)))) for k in range(1_500)]
    rows += [(2_000, None), (2_001, ""), (2_002, "1" * 30_000), (2_003, "a." * 20_000 + "@"), (2_004, "x@y.zz " * 300), (2_005, "+1" + " 2" * 10_000)]
    got = {r["doc_id"]: [tuple(s)[:3] for s in r["base"]] for r in pii.find_personal_data(cases.table(spark, rows)).collect()}
    assert all(got[i] == base_spans(t) for i, t in rows)


def test_disclosing_terms(spark):
    rows = [(k, f"{cases.prose(k, 12)} Quarlbert writes from q.b@mail.example about the weather {cases.prose(k + 99, 12)}") for k in range(5)]
    rows += [(50 + k, cases.prose(k, 200) + " writes from about the weather") for k in range(40)]
    rows += [(None, None), (90, ""), (91, rows[0][1])]
    docs = cases.table(spark, rows)
    found = pii.find_personal_data(docs, bits=3.0)
    terms = {s["found"] for r in found.collect() for s in r["terms"]}
    assert "quarlbert" in terms and not terms & {"writes", "weather", "about", "from"}
    clean = {r["doc_id"]: r["text"] for r in pii.sanitised(docs, found).collect()}
    assert len(clean) == len(rows) and clean[50] == dict(rows)[50] and clean[None] is None
    assert "Quarlbert" not in clean[0] and "q.b@" not in clean[0] and "[TERM]" in clean[0] and "[EMAIL]" in clean[0] and "weather" in clean[0]
    assert pii.find_personal_data(cases.table(spark, [])).count() == 0


def plain_terms(rows: list[tuple], support: int, share: float, bits: float) -> dict:
    """(id, text) -> spans of the terms, from the definition."""
    marks = spans.WORD_MARKS
    trimmed = lambda w: w.strip(marks).lower()
    corpus = Counter(t for _, text in rows for w in cases.words(text) if (t := trimmed(w)))
    shared, times, near = {}, {}, {}
    for i, text in rows:
        base = base_spans(text) if text else []
        for kind, start, stop in base:
            first = max(start - pii.AROUND, 0)
            before, after = text[first:start], text[stop : stop + pii.AROUND]
            left = re.sub(r"^[^\x20\x09-\x0D]+", "", before) if first > 0 else before
            right = re.sub(r"[^\x20\x09-\x0D]+$", "", after) if len(after) == pii.AROUND else after
            for side, origin in ((left, start - len(left)), (right, stop)):
                for w in re.finditer(r"[^\x20\x09-\x0D]+", side):
                    at = origin + w.start() + len(w[0]) - len(w[0].lstrip(marks))
                    term, end = trimmed(w[0]), at + len(w[0].strip(marks))
                    if not any(c.isalnum() for c in term) or any(a < end and b > at for _, a, b in base):
                        continue
                    key = (kind, text[start:stop].lower())
                    shared.setdefault((key, term), set()).add((before, after))
                    times.setdefault((key, term), set()).add((i, text, at))
                    near.setdefault(key, set()).add((i, text, at))
    out: dict = {}
    for (key, term), contexts in shared.items():
        given = len(times[key, term]) / corpus[term]
        if len(contexts) >= support and given >= share and math.log2(given * corpus.total() / len(near[key])) >= bits:
            for i, text, at in times[key, term]:
                out.setdefault((i, text), set()).add((at, at + len(term)))
    return out


def test_disclosing_terms_are_those_of_the_definition(spark):
    rng = random.Random(12)
    names = ["Quarlbert", "user_42x", "O'Neil-Ray", "77-A", "x"]
    rows = []
    for k in range(60):
        who = rng.randrange(5)
        entity = [f"{who}.p@mail.example", f"+49 170 12345{who}0", f"10.0.0.{who}"][rng.randrange(3)]
        words = [cases.prose(k, rng.randrange(1, 40), 60), f"({names[who]}),", "writes", entity, cases.prose(k + 500, rng.randrange(1, 30), 60), names[rng.randrange(5)]]
        rows.append((k // 2 if k % 7 else None, " ".join(words)))
    rows += [(1, None), (2, ""), rows[3], (300, "plain " * 300)]
    for support, share, bits in ((2, 0.5, 3.0), (1, 0.2, 1.0), (3, 0.5, 6.0)):
        got = pii.find_personal_data(cases.table(spark, rows), support=support, share=share, bits=bits)
        want = plain_terms(rows, support, share, bits)
        keyed = got.join(cases.table(spark, rows).selectExpr("doc_id as i", "text as t", "xxhash64(text) as k").distinct(), [got["doc_id"].eqNullSafe(F_col("i")), got["text_key"] == F_col("k")])
        for r in keyed.collect():
            assert [tuple(s)[1:3] for s in r["terms"]] == sorted(want.get((r["i"], r["t"]), ())), (support, r["t"])
        assert support == 3 or want


def test_secret_scan(spark):
    rng = random.Random(6)
    key = lambda alphabet, n: "".join(rng.choice(alphabet) for _ in range(n))
    upper, hexes = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "0123456789abcdef"
    rows, want = [], set()
    for k in range(60):
        body = cases.prose(k, 20)
        secret = "AKIA" + key(upper, 16) if k % 2 else key(hexes, 40)
        line = f"key {secret} end" if k % 2 else f'token = "{secret}" end'
        rows.append((k, f"{body} é {line} {cases.prose(k + 7, 10)}"))
        at = rows[-1][1].index(secret)
        want.add((k, at, at + len(secret)))
        rows.append((100 + k, f"{body} call 49{key('0123456789', 14)} now, commit {key(hexes, 40)} fixed it"))
    rows += [(None, None), (200, ""), (201, "word " * 5_000)]
    docs = cases.table(spark, rows)
    found = secret_scan.scan(docs, path_col="source")
    assert {(r["doc_id"], r["start"], r["stop"]) for r in found.where("is_secret").collect()} == want
    clean = {r["doc_id"]: r["text"] for r in secret_scan.redacted(docs, found).collect()}
    assert len(clean) == len(rows) and all("[SECRET]" in clean[i] for i, _, _ in want) and clean[101] == dict(rows)[101] and clean[None] is None
    assert secret_scan.scan(cases.table(spark, [])).count() == 0
    assert secret_scan.scan(cases.table(spark)).where("is_secret").count() == 0
