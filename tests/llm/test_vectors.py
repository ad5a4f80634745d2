"""Near-duplicate vectors against all pairs."""

import math
import tracemalloc

import numpy as np

from adweave.llm import vector_neardup

SCHEMA = "vec_id long, embedding array<float>, label int, node string, cell int, copies long"


def brute(rows, least):
    keep = []
    for i, v, label in rows:
        fine = label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)
        keep.append(np.asarray(v, np.float32).astype(float) if fine else None)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = [0] * len(rows)
    for a in range(len(rows)):
        for b in range(a):
            x, y = keep[a], keep[b]
            if x is not None and y is not None and rows[a][2] == rows[b][2] and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= least:
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    low = {}
    for k, (i, _, _) in enumerate(rows):
        low.setdefault(find(k), []).append(i)
    low = {k: min((i for i in v if i is not None), default=None) for k, v in low.items()}
    return [(i, links[k], low[find(k)]) for k, (i, _, _) in enumerate(rows)]


def test_near_duplicates(spark, monkeypatch):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((40, 16))
    rows = [(k, (centres[k % 40] + 0.03 * rng.standard_normal(16)).tolist(), int(k % 3)) for k in range(400)]
    rows += [(1_000, rows[0][1], 0), (1_001, rows[0][1], 0), (1_001, rows[0][1], 0), (1_002, rows[0][1], 1), (1_003, rows[0][1], None), (None, rows[3][1], 0)]
    rows += [(1_004, None, 0), (1_005, [0.0] * 16, 0), (1_005, [0.0] * 16, 0), (1_006, [float("nan"), *[1.0] * 15], 0), (1_007, [float("inf"), *[1.0] * 15], 0), (1_008, [None, *[1.0] * 15], 0), (1_009, [], 0), (1_010, [1.0] * 8, 0), (1_011, [2 * x for x in rows[5][1]], 2)]
    rows += [(1_012, [1.0, 2.0], 0), (1_013, [10.0, 20.0], 0), (1_014, [2.0, -1.0], 0), (1_015, [10.0, 20.0], 1), (1_016, [3.0], 0), (1_017, [0.5], 0), (1_018, [-3.0], 0), (1_019, [1.0] * 8, 0), (1_020, [2.0] * 8, 0), (1_021, [1.0] * 3, 0)]
    monkeypatch.setattr(vector_neardup, "STORED_BLOCK", 7)  # cells of many blocks
    monkeypatch.setattr(vector_neardup, "PROBE_BLOCK", 11)
    got = vector_neardup.near_duplicates(spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA), recall=1.0)
    found = sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in got.collect()), key=repr)
    assert found == sorted(brute(rows, 0.98), key=repr)
    assert all(r["kept"] == (r["vec_id"] is None or r["vec_id"] == r["component_id"]) or r["component_id"] is not None for r in got.collect())


def test_recall_and_no_false_links(spark):
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((300, 32))
    rows = [(k, (centres[k % 300] + 0.05 * rng.standard_normal(32)).tolist(), 0) for k in range(3_000)]
    got = {r["vec_id"]: r["n_links"] for r in vector_neardup.near_duplicates(spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)).collect()}
    unit = np.asarray([r[1] for r in rows], np.float32).astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    want = (unit @ unit.T >= 0.98).sum(1) - 1
    found = np.asarray([got[k] for k in range(3_000)])
    assert (found <= want).all() and found.sum() >= 0.98 * want.sum()


def test_nothing(spark):
    assert vector_neardup.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    lone = vector_neardup.near_duplicates(spark.createDataFrame([(1, None, 0, "x", 1, 2)], SCHEMA)).collect()
    assert [tuple(r) for r in lone] == [(1, 0, 1, True)]


def test_frontier_is_the_order():
    rng = np.random.default_rng(5)
    books = (rng.standard_normal((6, 4)), rng.standard_normal((6, 4)))
    x = rng.standard_normal((50, 8))
    total = vector_neardup._distances(x[:, :4], books[0])[:, :, None] + vector_neardup._distances(x[:, 4:], books[1])[:, None, :]
    assert (vector_neardup.multi_sequence(books, x, 9) == np.argsort(total.reshape(50, -1), 1, kind="stable")[:, :9]).all()


def test_a_block_of_links_is_verified_in_slices():
    """All pairs of a block are links: what is held at once does not follow their number, and the trees are those of all pairs."""
    rng = np.random.default_rng(6)
    centre = rng.standard_normal(32)
    stored, probes = (centre + 0.005 * rng.standard_normal((n, 32)) for n in (1_024, 2_048))
    tracemalloc.start()
    parent, tree, pairs = np.arange(3_072), [], 0
    for i, j in vector_neardup._close(stored, probes, 0.98):
        tree += vector_neardup._tied(parent, i, j + 2_048)
        pairs += len(i)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert pairs == 1_024 * 2_048 and len(tree) == 3_071 and most < 120e6  # their vectors alone are 1.07 GB


def test_trees_are_those_of_the_links():
    rng = np.random.default_rng(7)
    links = rng.integers(0, 400, (350, 2))
    parent, tree = np.arange(400), []
    for part in np.array_split(links, 20):
        tree += vector_neardup._tied(parent, part[:, 0], part[:, 1])
    root = list(range(400))
    for a, b in links.tolist():
        root = [root[b] if x == root[a] else x for x in root]
    again = list(range(400))
    for a, b in tree:
        assert again[a] != again[b]
        again = [again[b] if x == again[a] else x for x in again]
    same = lambda x: [x.index(v) for v in x]
    assert same(again) == same(root)
