"""Blocking, components and completeness against brute force on small tables."""

from collections import Counter
from itertools import combinations

from pyspark.sql import functions as F

from adweave.operators import identity as idn
from adweave.operators.components import connected_components

FIELDS = "record_id long, person_id long, name string, email string, phone string, city string, user_agent string, email_hash string, cookie_id string"


def records(spark, rows):
    return spark.createDataFrame(rows, FIELDS)


def sample(spark, n=60):
    rows = []
    for i in range(n):
        email = "" if i % 7 == 0 else f"u{i // 3}@{'big.com' if i % 4 else 'small.com'}"
        rows.append((i, i // 3, f"n{i % 5} last", email, "" if i % 5 == 0 else f"555{1000 + i // 3}", "" if i % 6 == 0 else f"c{i % 2}", f"ua{i % 2}", email and f"h{i // 3}", "c"))
    return records(spark, rows)


def brute(rows):
    """Pairs that share a blocking key, and those that meet the rule."""
    both = lambda a, b, c: a[c] is not None and a[c] == b[c]
    full, found = 0, set()
    for a, b in combinations(sorted(rows, key=lambda r: r["record_id"]), 2):
        full += any(both(a, b, c) for c in idn.BLOCKING)
        named = both(a, b, "name") and (both(a, b, "domain") or both(a, b, "city_ua"))
        if both(a, b, "email_hash") or named or (both(a, b, "phone4") and set(a["tokens"]) & set(b["tokens"])):
            found.add((a["record_id"], b["record_id"]))
    return full, found


def test_candidates_match_brute_force(spark):
    table = sample(spark)
    full, want = brute(idn.blocking_keys(table).collect())
    got = [(r["i"], r["j"]) for r in idn.candidate_pairs(table).collect()]
    assert set(got) == want and len(got) == len(want)
    assert idn.blocking_counts(table).first()["candidate_pairs"] == full


def test_further_records_never_remove_a_pair(spark):
    few = {(r["i"], r["j"]) for r in idn.candidate_pairs(sample(spark, 40)).collect()}
    many = {(r["i"], r["j"]) for r in idn.candidate_pairs(sample(spark, 400)).collect()}
    assert few and few <= many


def test_key_edges_give_the_components_of_all_pairs(spark):
    table = sample(spark, 30)
    rows = [r for r in table.collect() if r["email_hash"]]
    pairs = [(a["record_id"], b["record_id"]) for a, b in combinations(rows, 2) if a["email_hash"] == b["email_hash"]]
    ids = table.select("record_id")
    resolved = [sorted(map(tuple, connected_components(ids, e).collect())) for e in (idn.key_edges(table, "email_hash"), spark.createDataFrame(pairs, "i long, j long"))]
    assert resolved[0] == resolved[1]


def test_links_of_the_model_resolve_as_a_plain_union(spark):
    table = sample(spark, 90)
    pairs = idn.label_pairs(idn.candidate_pairs(table), table)
    features = idn.pair_features(pairs, table)
    model, _, columns = idn.train_linker(features)
    links = [(r["i"], r["j"]) for r in idn.link_pairs(model, features, columns).where("p >= 0.70").collect()]
    root = {r["record_id"]: r["record_id"] for r in table.collect()}
    for i, j in sorted(links):
        low, high = sorted((root[i], root[j]))
        root = {k: low if v == high else v for k, v in root.items()}
    edges = idn.link_pairs(model, features, columns).where("pred_match = 1")
    assert {r["record_id"]: r["resolved_id"] for r in idn.resolve(table, edges).collect()} == root and links


def test_missing_city_blocks_but_fully_empty_does_not(spark):
    base = ("n", "", "")
    rows = [(1, 1, *base, "", "ua", "", ""), (2, 1, *base, "", "ua", "", ""), (3, 1, *base, "", "", "", ""), (4, 1, *base, "", "", "", "")]
    assert idn.blocking_counts(records(spark, rows)).first()["candidate_pairs"] == 1
    assert {(r["i"], r["j"]) for r in idn.candidate_pairs(records(spark, rows)).collect()} == {(1, 2)}


def test_components(spark):
    chain = [(i, i + 1) for i in range(50)]
    star = [(100, 100 + i) for i in range(1, 40)]
    cliques = list(combinations(range(200, 206), 2)) + list(combinations(range(210, 216), 2)) + [(205, 210)]
    nodes = sorted({n for e in chain + star + cliques for n in e} | {999})
    edges = spark.createDataFrame(chain + star + cliques, "i long, j long")
    frame = spark.createDataFrame([(n,) for n in nodes], "record_id long")
    got = {r["record_id"]: r["resolved_id"] for r in connected_components(frame, edges).collect()}
    want = {n: 0 if n <= 50 else 100 if n < 200 else 200 if n < 999 else 999 for n in nodes}
    assert got == want
    labels = frame.sparkSession.createDataFrame(list(got.items()), "i long, j long")
    again = {r["record_id"]: r["resolved_id"] for r in connected_components(frame, labels).collect()}
    assert again == got


def test_empty_completeness_bucket_is_kept(spark):
    rows = [(i, 1, "n", "a@b.c", "5551234", "c", "ua", "h", "k") for i in (1, 2)]
    pairs = spark.createDataFrame([(1, 2, 1, 1)], "i long, j long, same_person int, pred_match int")
    table = {r["completeness_bucket"]: r for r in idn.completeness_report(pairs, records(spark, rows)).collect()}
    assert set(table) == set(idn.BUCKETS)
    assert table["0-40%"]["n_pairs"] == 0 and table["0-40%"]["true_match_rate"] is None
    assert Counter(r["n_pairs"] for r in table.values()) == {0: 3, 1: 1}


def test_embedding_keeps_cosines_of_low_rank_rows(spark):
    import numpy as np

    from adweave.operators.decomposition import truncated_svd

    rng = np.random.default_rng(0)
    dense = rng.normal(size=(40, 3)) @ rng.normal(size=(3, 25))
    rows = [(i, f"t{j}", float(dense[i, j])) for i in range(40) for j in range(25)]
    table = truncated_svd(spark.createDataFrame(rows, "record_id long, term string, weight double"), "record_id", 3).collect()
    out = np.array([r["embedding"] for r in sorted(table, key=lambda r: r["record_id"])])
    assert np.allclose(out @ out.T, dense @ dense.T, atol=1e-6)


def test_embedding_of_more_terms_than_a_driver_table(spark):
    """80,000 terms: rows of their own terms are the singular vectors, their lengths the singular values."""
    import numpy as np

    from adweave.operators.decomposition import truncated_svd

    length = lambda i: F.when(F.col("i") < 6, 100 * F.pow(F.lit(0.5), F.col("i"))).otherwise(0.01)
    cells = spark.range(80_000).select((F.col("id") % 200).alias("i"), F.concat(F.lit("t"), "id").alias("term"))
    cells = cells.select(F.col("i").alias("record_id"), "term", (length("i") / F.sqrt(F.lit(400.0))).alias("weight"))
    table = {r["record_id"]: r["embedding"] for r in truncated_svd(cells, "record_id", 4).collect()}
    assert len(table) == 200
    for i in range(4):
        want = np.zeros(4)
        want[i] = 100 * 0.5**i
        assert np.allclose(np.abs(table[i]), want, atol=1e-3)


def test_embedding_singular_values_are_those_of_the_matrix(spark):
    import numpy as np

    from adweave.operators.decomposition import truncated_svd

    rng = np.random.default_rng(3)
    dense = rng.normal(size=(60, 12)) * (0.6 ** np.arange(12)) @ np.linalg.qr(rng.normal(size=(40, 12)))[0].T
    rows = [(i, f"t{j}", float(dense[i, j])) for i in range(60) for j in range(40)]
    table = truncated_svd(spark.createDataFrame(rows, "record_id long, term string, weight double"), "record_id", 6).collect()
    found = np.linalg.norm([r["embedding"] for r in table], axis=0)
    assert np.allclose(found, np.linalg.svd(dense, compute_uv=False)[:6], rtol=1e-4)
    assert truncated_svd(spark.createDataFrame([], "record_id long, term string, weight double"), "record_id", 6).count() == 0


def test_pairs_bring_their_rows(spark):
    """Pairs are never shuffled, nothing that grows is broadcast, and repeated or null ids give what joins with the records give."""
    one = sample(spark, 120)
    table = one.unionByName(one.where("record_id % 7 = 0").withColumn("city", F.lit("elsewhere"))).unionByName(one.limit(3).withColumn("record_id", F.lit(None).cast("long")))
    kept = idn.candidate_pairs(table, idn.feature_inputs(table))
    joined = idn.pair_features(idn.label_pairs(idn.candidate_pairs(table), table), table)
    packed = idn.pair_features(idn.label_pairs(kept, table), table)
    assert sorted(map(tuple, packed.collect())) == sorted(map(tuple, joined.collect())) and packed.columns == joined.columns
    plan = packed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 3  # of the blocks, and of each side with its rows; the pairs meet no records any more
    executed = packed._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in executed


def test_terms_are_not_broadcast(spark):
    plan = []
    held = idn.cut_lineage
    try:
        idn.cut_lineage = lambda df: plan.append(df._jdf.queryExecution().executedPlan().toString()) or held(df)
        idn.tfidf(sample(spark, 40)).count()
    finally:
        idn.cut_lineage = held
    assert plan and not any("Broadcast" in p for p in plan)


def test_counted_terms_are_not_broadcast(spark, tmp_path):
    """The size of the counted terms is guessed from the records' files, so the join with their frequencies may not go by it."""
    sample(spark, 40).write.parquet(str(tmp_path / "records"))
    plan = idn.tfidf(spark.read.parquet(str(tmp_path / "records")))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_embedding_of_many_blocks_and_columns_at_a_time(spark, monkeypatch):
    """Cells are multiplied inside blocks of rows, so nothing is shuffled per cell; null rows and terms count as before."""
    import numpy as np

    from adweave.operators import decomposition

    rng = np.random.default_rng(8)
    dense = rng.normal(size=(90, 4)) @ rng.normal(size=(4, 30))
    rows = [(i, f"t{j}", float(dense[i, j])) for i in range(90) for j in range(30)] + [(5, None, 3.0), (None, "t0", 1.0), (7, "t1", None)]
    monkeypatch.setattr(decomposition, "BLOCK_CELLS", 400)
    monkeypatch.setattr(decomposition, "BLOCK_NUMBERS", 30 * 5)
    widths, product = [], decomposition._product
    monkeypatch.setattr(decomposition, "_product", lambda cells, needs, basis, back: widths.append(len(basis.columns) - 1) or product(cells, needs, basis, back))
    table = decomposition.truncated_svd(spark.createDataFrame(rows, "record_id long, term string, weight double"), "record_id", 4).collect()
    got = {r["record_id"]: r["embedding"] for r in table}
    assert len(table) == 91 and widths and max(widths) <= 5
    out = np.array([got[i] for i in range(90)])
    assert np.allclose(out @ out.T, dense @ dense.T, atol=1e-6)
    assert np.allclose(np.array(got[None]) @ out.T, dense[:, 0] * 0 + (np.linalg.pinv(dense) @ dense)[0] @ dense.T, atol=1e-6)


def test_files_of_earlier_steps_go(spark):
    """The shuffle files of a step go when it is written; a table that is still used keeps its own."""
    from adweave.session import cut_lineage

    at = lambda: int(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().size())
    used = spark.range(1_000).groupBy((F.col("id") % 7).alias("k")).count()
    before = at()
    for _ in range(3):
        assert cut_lineage(used).count() == 7
    assert at() <= before + 3 and used.count() == 7  # those of the three counts at most
