"""Near-duplicate vectors by an inverted multi-index (operator 7).

Each half of the unit vectors has its own codebook; the product of both is a grid of cells. A vector is stored in the
cell of its nearest codewords and visits cells in the multi-sequence order (rising sum of both squared distances) until
the share of neighbours reached is the target, measured on sample vectors turned by exactly the threshold angle. Every
stored vector of a visited cell is verified by its cosine in double precision.

Equal vectors are collapsed first. Cells are split into blocks, so a crowded cell is many tasks, and tasks return sums
of links and a spanning forest of their links, not the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adweave.llm.common import saved
from adweave.operators.components import connected_components

SAMPLE = 8_192  # vectors that the codebooks are fitted to; all vectors are stored
CELL_ROWS = 64  # distinct vectors for which one more cell is made
CODEWORDS = 256  # most codewords of a half; more vectors then share a cell
STORED_BLOCK, PROBE_BLOCK = 2_048, 4_096
PLACED_ROWS = 2_048  # vectors whose distances to the codewords are held at once
SLICE_NUMBERS = 1 << 21  # most numbers of one side of the pairs that a task verifies at once


@dataclass(frozen=True)
class Index:
    books: tuple[np.ndarray, np.ndarray]
    visits: int


def _units(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _distances(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ book.T + (book * book).sum(1), 0)


def _codebook(x: np.ndarray, size: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    book = x[rng.choice(len(x), size, replace=False)].copy()
    for _ in range(rounds):
        near = _distances(x, book).argmin(1)
        for k in range(size):
            if (near == k).any():
                book[k] = x[near == k].mean(0)
    return book


def multi_sequence(index_books: tuple, units: np.ndarray, visits: int) -> np.ndarray:
    """The first ``visits`` cells of each vector in rising order of both squared distances.

    The t-th cell of the order has ranks (a, b) with (a + 1)(b + 1) <= t, so the order is a sort of these few.
    """
    half = units.shape[1] // 2
    left, right = _distances(units[:, :half], index_books[0]), _distances(units[:, half:], index_books[1])
    by_left, by_right = np.argsort(left, 1, kind="stable"), np.argsort(right, 1, kind="stable")
    ranks = np.asarray([(a, b) for a in range(min(visits, left.shape[1])) for b in range(min(visits // (a + 1), right.shape[1]))])
    i, j = by_left[:, ranks[:, 0]], by_right[:, ranks[:, 1]]
    total = np.take_along_axis(left, i, 1) + np.take_along_axis(right, j, 1)
    order = np.argsort(total, 1, kind="stable")[:, :visits]
    return np.take_along_axis(i * right.shape[1] + j, order, 1)


def build_index(sample: np.ndarray, rows: int, least: float, recall: float, seed: int = 11) -> Index:
    """Codebooks of ``sample`` for ``rows`` vectors, and the visits that reach ``recall`` at cosine ``least``."""
    rng = np.random.default_rng(seed)
    units = _units(sample)
    half = units.shape[1] // 2
    size = int(np.clip(round((rows / CELL_ROWS) ** 0.5), 1, min(CODEWORDS, len(units))))
    books = (_codebook(units[:, :half], size, rng), _codebook(units[:, half:], size, rng))
    noise = rng.standard_normal(units.shape)
    noise -= (noise * units).sum(1, keepdims=True) * units
    length = np.linalg.norm(noise, axis=1, keepdims=True)
    turned = least * units + (1 - least * least) ** 0.5 * noise / np.where(length > 0, length, 1)
    home = multi_sequence(books, turned, 1)
    visits = 1
    while visits < size * size and (multi_sequence(books, units, visits) == home).any(1).mean() < recall:
        visits += max(1, visits // 4)
    return Index(books, min(visits, size * size))


def _close(stored: np.ndarray, probes: np.ndarray, least: float, width: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places of probes, places of stored vectors) of all pairs with cosine ``least`` or more, those of a few probes at a time.

    All pairs of a block may be links, so no more are held at once than have SLICE_NUMBERS components, or ``width`` numbers each.
    """
    units, lengths = [_units(v) for v in (stored, probes)], [np.linalg.norm(v, axis=1) for v in (stored, probes)]
    step = max(1, SLICE_NUMBERS // (len(stored) * max(stored.shape[1], width)))
    for k in range(0, len(probes), step):
        i, j = np.nonzero(units[1][k : k + step] @ units[0].T >= least - 1e-9)
        i += k
        close = (probes[i] * stored[j]).sum(1) / (lengths[1][i] * lengths[0][j]) >= least
        yield i[close], j[close]


def _tied(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> list[tuple[int, int]]:
    """Adds links to the forest in ``parent`` and returns those that tie two of its trees."""
    while ((up := parent[parent]) != parent).any():
        parent[:] = up
    apart = parent[i] != parent[j]
    kept, root = [], {}

    def top(x: int) -> int:
        while x in root:
            root[x] = root.get(root[x], root[x])
            x = root[x]
        return x

    for a, b, x, y in zip(i[apart].tolist(), j[apart].tolist(), parent[i[apart]].tolist(), parent[j[apart]].tolist(), strict=True):
        x, y = top(x), top(y)
        if x != y:
            root[x] = y
            kept.append((a, b))
    for x in root:
        parent[x] = top(x)
    return kept


def near_duplicates(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", least: float = 0.98, recall: float = 0.995, sample: int = SAMPLE,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row; rows of one label link at cosine ``least`` or more.

    A null label, a null or zero vector, or one with null or non-finite components links with nothing. Vectors of one
    length are compared with each other, each length by an index of its own. Equal vectors link with each other; rows with equal ids are rows of their
    own, whose component is the smallest id reached. Other columns are not read; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("vector"))
    fine = F.coalesce(
        F.col("label").isNotNull() & (F.size("vector") > 0) & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0),
        F.lit(False),
    )
    name = F.concat(F.hex(F.xxhash64("label", "vector")), F.lit("-"), F.hex(F.xxhash64("vector", "label", F.lit(1))))
    rows = rows.withColumn("node", F.when(fine, name))
    nodes = rows.where("node is not null").groupBy("node").agg(F.first("label").alias("label"), F.first("vector").alias("vector"), F.count(F.lit(1)).alias("copies"))
    nodes = saved(nodes.withColumn("dim", F.size("vector")), "vectors")
    nothing = rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    lengths = nodes.groupBy("dim").count().orderBy("dim").collect()
    if not lengths:
        return nothing
    indexes = {}
    for dim, count in lengths:  # the sample is shared out among the lengths
        picked = nodes.where(F.col("dim") == dim).select("node", "vector").orderBy("node").limit(max(sample // len(lengths), CELL_ROWS)).collect()
        indexes[dim] = build_index(np.asarray([r["vector"] for r in picked], float), count, least, recall)

    def place(batches):
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                part, index = batch.filter(pa.array(dims == dim)), indexes[dim]
                held = np.asarray(part.column("vector").flatten().to_numpy(zero_copy_only=False)).reshape(len(part), dim)
                cells = np.concatenate([multi_sequence(index.books, _units(held[k : k + PLACED_ROWS]), index.visits) for k in range(0, len(held), PLACED_ROWS)])
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1, dtype=np.int32) * cells.shape[1]), pa.array(cells.ravel().astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(cells[:, 0].astype(np.int32)), lists], names=[*part.schema.names, "home", "visited"])

    kind = dict(nodes.dtypes)["label"]
    fields = f"node string, label {kind}, vector array<double>, copies long, dim int, home int, visited array<int>"
    placed = saved(nodes.select("node", "label", "vector", "copies", "dim").mapInArrow(place, fields), "placed")
    # a cell's stored vectors and probes are cut into blocks; each probe block meets each stored block once
    stored = placed.groupBy("label", "dim", F.col("home").alias("cell")).agg(F.ceil(F.count(F.lit(1)) / STORED_BLOCK).cast("int").alias("stored_blocks"))
    probes = placed.select("label", "dim", F.explode("visited").alias("cell")).groupBy("label", "dim", "cell").agg(F.ceil(F.count(F.lit(1)) / PROBE_BLOCK).cast("int").alias("probe_blocks"))
    blocks = stored.join(probes, ["label", "dim", "cell"])
    shuffled = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = ["label", "dim", "cell", "sb", "pb", "node", "vector", "copies", "home", "visited"]
    left = placed.withColumn("cell", F.col("home")).join(blocks, ["label", "dim", "cell"]).withColumn("sb", shuffled("stored_blocks")).withColumn("pb", every("probe_blocks")).select(columns)
    right = placed.withColumn("cell", F.explode("visited")).join(blocks, ["label", "dim", "cell"]).withColumn("pb", shuffled("probe_blocks")).withColumn("sb", every("stored_blocks")).select(columns)
    right = right.toDF(*[f"probe_{c}" for c in columns])

    def verify(stored: pa.Table, probes: pa.Table) -> pa.Table:
        schema = pa.schema([("node", pa.string()), ("links", pa.int64()), ("other", pa.string())])
        if not len(stored) or not len(probes):
            return schema.empty_table()
        probes = probes.rename_columns([c.removeprefix("probe_") for c in probes.column_names])
        vectors = [np.stack(t["vector"].to_numpy()).astype(float) for t in (stored, probes)]
        names = [t["node"].to_numpy() for t in (stored, probes)]
        copies = [t["copies"].to_numpy() for t in (stored, probes)]
        seen, homes = np.stack(stored["visited"].to_numpy()), probes["home"].to_numpy()
        links, back = np.zeros(len(probes), np.int64), np.zeros(len(stored), np.int64)
        parent, tree = np.arange(len(probes) + len(stored)), []
        for i, j in _close(*vectors, least, seen.shape[1]):
            other = names[1][i] != names[0][j]
            i, j = i[other], j[other]
            # the reverse of a link is found by the stored vector itself if it visits the probe's cell
            alone = ~(seen[j] == homes[i][:, None]).any(1)
            links += np.bincount(i, copies[0][j], len(probes)).astype(np.int64)
            back += np.bincount(j[alone], copies[1][i[alone]], len(stored)).astype(np.int64)
            tree += _tied(parent, i, j + len(probes))
        both = np.concatenate([names[1], names[0]])
        counted = pa.table([pa.array(both), pa.array(np.concatenate([links, back])), pa.nulls(len(both), pa.string())], schema=schema)
        edges = pa.table([pa.array([both[x] for x, _ in tree], pa.string()), pa.array(np.zeros(len(tree), np.int64)), pa.array([both[y] for _, y in tree], pa.string())], schema=schema)
        return pa.concat_tables([counted.filter(pa.array(np.concatenate([links, back]) > 0)), edges])

    keys = ["label", "dim", "cell", "sb", "pb"]
    found = saved(left.groupBy(*keys).cogroup(right.groupBy(*[f"probe_{k}" for k in keys])).applyInArrow(verify, "node string, links long, other string"), "vector-links")
    links = found.where("other is null").groupBy("node").agg(F.sum("links").alias("links"))
    edges = found.where("other is not null").select(F.col("node").alias("i"), F.col("other").alias("j"))
    resolved = connected_components(nodes.select("node"), edges, "node")
    about = nodes.select("node", "copies").join(links, "node", "left").join(resolved, "node").select("node", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), "resolved_id")
    named = rows.select("vec_id", "node").join(about, "node", "left")
    lowest = named.where("resolved_id is not null").groupBy("resolved_id").agg(F.min("vec_id").alias("lowest"))
    out = named.join(lowest, "resolved_id", "left").select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("lowest", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
