"""Edge rules of ordered primitives, metrics and uplift tables."""

import random

import pytest
from pyspark.sql import functions as F

from adweave.operators import metrics as met
from adweave.operators import ordered, uplift


def scored(spark, rows):
    return spark.createDataFrame(rows, "label int, p double").withColumn("model", F.lit("m"))


def test_ranges_and_ties_match_a_plain_sort(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice([0.5, 0.5, 0.5, rng.random()])) for i in range(3000)]
    df = spark.createDataFrame(rows, "key long, score double")
    got = {r["key"]: r["rank"] for r in ordered.positional_rank(df, "score", "key").collect()}
    want = {k: i for i, (k, _) in enumerate(sorted(rows, key=lambda r: (-r[1], r[0])), start=1)}
    assert got == want


def test_one_score_with_a_text_key_is_cut_inside_the_tie(spark):
    df = spark.range(4000).select(F.concat(F.lit("k"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("key"), F.lit(0.5).alias("score"))
    rows = ordered.positional_rank(df.repartition(8), "score", "key")
    assert {r["key"]: r["rank"] for r in rows.collect()} == {f"k{i:05d}": i + 1 for i in range(4000)}
    assert rows.first()["rank_all"] == 4000


def test_ranges_of_the_scan_split_a_group(spark, monkeypatch):
    from adweave.operators import scan

    kept = []
    held = scan.cut_lineage
    monkeypatch.setattr(scan, "cut_lineage", lambda df: kept.append(held(df)) or kept[-1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("v"), F.lit("one").alias("g"))
        got = scan.running(df, ["g"], [F.col("v")], {"n": F.lit(1), "s": F.col("v")}, following={"to": ("v", False)}, totals=True).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert kept[0].select("_scan_range").distinct().count() > 4
    assert all((r["n"], r["s"], r["to"], r["n_all"]) == (r["v"] + 1, r["v"] * (r["v"] + 1) // 2, r["v"] + 1 if r["v"] < 4999 else None, 5000) for r in got)


def test_five_thousand_groups(spark):
    rows = [(g if g else None, float((g * 31 + i * 17) % 101) + i / 100, i) for g in range(5000) for i in range(1 + g % 4)]
    df = spark.createDataFrame(rows, "g int, v double, key int")
    ranks = {(r["g"], r["key"]): (r["rank"], r["rank_all"]) for r in ordered.positional_rank(df, "v", "key", ["g"]).collect()}
    medians = {r["g"]: r["quantile"] for r in ordered.exact_quantiles(df, "v", [0.5], ["g"]).collect()}
    by = {}
    for g, v, i in rows:
        by.setdefault(g, []).append((-v, i))
    assert len(medians) == 5000
    for g, held in by.items():
        assert all(ranks[g, i] == (k, len(held)) for k, (_, i) in enumerate(sorted(held), 1))
        values = sorted(-v for v, _ in held)
        assert medians[g] == pytest.approx((values[(len(values) - 1) // 2] + values[len(values) // 2]) / 2)


def test_quantiles_of_a_large_table_with_ties(spark):
    import numpy as np

    values = np.round(np.random.default_rng(6).normal(size=60_000), 2)
    df = spark.createDataFrame([(float(v), int(k % 2)) for k, v in enumerate(values)], "v double, g int")
    probs = [0.0, 0.001, 0.25, 0.5, 0.77, 0.999, 1.0]
    for r in ordered.exact_quantiles(df, "v", probs, ["g"]).collect():
        assert r["quantile"] == pytest.approx(float(np.quantile(values[r["g"] :: 2], r["prob"])))


def test_decaying_sums_over_twenty_years(spark):
    from adweave.operators import scan

    day = 86_400
    rng = random.Random(8)
    times = sorted(rng.randrange(20 * 365 * day) for _ in range(400)) + [20 * 365 * day + k for k in range(30)]
    df = spark.createDataFrame([(u, t, k) for u in ("a", "b") for k, t in enumerate(times)], "u string, t long, k int")
    for half_life in (2 * day, 3600, 400 * day):
        got = scan.running(df, ["u"], [F.col("t"), F.col("k")], {"n": F.lit(1)}, {"d": F.lit(1.0)}, "t", float(half_life)).where("u = 'b'").collect()
        want, last, by = 0.0, None, {}
        for k, t in enumerate(times):
            want = want * 2.0 ** (-(t - last) / half_life) + 1 if last is not None else 1.0
            last, by[k] = t, want
        assert len(got) == len(times) and all(r["d"] == pytest.approx(by[r["k"]], rel=1e-9) and r["n"] == r["k"] + 1 for r in got)


def test_next_score_crosses_ranges(spark):
    df = spark.createDataFrame([(float(i),) for i in range(500)], "score double")
    table = ordered.running_totals(df, "score", None, {"n": F.lit(1)}, descending=False, next_score="to").collect()
    assert all(r["to"] == r["score"] + 1 for r in table if r["score"] < 499)


def test_rows_of_quantiles_are_not_dealt_by_group(spark):
    """A few groups would be as many tasks, whatever the table's size; above a number of groups they are."""
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    limit, most = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), ordered.BROADCAST_GROUPS
    rows = spark.range(1_000).select(F.struct((F.col("id") % 3).alias("g")).alias("_g"), F.col("id").cast("double").alias("_value"))
    brackets = rows.groupBy("_g").agg(F.min("_value").alias("_lo0"), F.max("_value").alias("_hi0"))
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        few = ordered._beside_brackets(rows, brackets)
        assert "BroadcastHashJoin" in plan(few) and few.count() == 1_000
        ordered.BROADCAST_GROUPS = 2
        many = ordered._beside_brackets(rows, brackets)
        assert "SortMergeJoin" in plan(many) and many.count() == 1_000
        table = spark.range(1_001).select(F.when(F.col("id") % 2 == 0, "a").alias("g"), F.col("id").alias("v"))
        for ordered.BROADCAST_GROUPS in (1, 2):
            got = {r["g"]: r["quantile"] for r in ordered.exact_quantiles(table, "v", [0.5], ["g"]).collect()}
            assert got == {"a": 500.0, None: 500.0}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        ordered.BROADCAST_GROUPS = most


def test_quantiles_match_linear_interpolation(spark):
    import numpy as np

    values = [random.Random(5).gauss(0, 1) for _ in range(1)] + [float(v) for v in np.random.default_rng(2).normal(size=999)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    probs = [0.0, 0.025, 0.5, 0.9, 1.0]
    got = {r["prob"]: r["quantile"] for r in ordered.exact_quantiles(df, "v", probs).collect()}
    for p in probs:
        assert got[p] == pytest.approx(float(np.quantile(values, p)))


def test_calibration_error_edges(spark):
    df = scored(spark, [(1, 1.0), (1, 0.2), (0, 0.2), (1, 0.0)])
    plain = met.expected_calibration_error(df).first()["ece"]
    assert plain == pytest.approx(2 / 4 * abs(0.5 - 0.2) + 1 / 4 * 1.0)
    assert met.expected_calibration_error(df, include_one=True).first()["ece"] == pytest.approx(plain)


def test_constant_score_gives_one_reliability_bin(spark):
    table = met.reliability_curve(scored(spark, [(i % 2, 0.4) for i in range(20)])).collect()
    assert len(table) == 1 and table[0]["fraction_positive"] == 0.5


def test_scan_uses_grid_doubles(spark):
    edge = 0.1 + 4 * 0.05
    assert edge != 0.3
    df = scored(spark, [(1, 0.3), (1, edge), (1, 0.31)])
    row = [r for r in met.threshold_scan(df).collect() if r["threshold"] == 0.3][0]
    assert (row["tp"], row["fn"]) == (1, 2)


def test_scan_ties_take_lowest_threshold(spark):
    best = met.threshold_scan(scored(spark, [(1, 0.95), (0, 0.01)])).where("best").collect()
    assert [r["threshold"] for r in best] == [0.1]


def test_profit_formula(spark):
    table = spark.createDataFrame([(351, 525, 23, 508, 27550.0)], "tp int, fp int, fn int, tn int, profit double")
    assert table.where(met.profit_expr() == F.col("profit")).count() == 1


def test_bootstrap_finds_a_clear_winner(spark):
    rows = [(i, i % 2, 0.5, 0.8 if i % 2 else 0.2) for i in range(400)]
    df = spark.createDataFrame(rows, "key long, label int, p_base double, p_new double")
    table = met.paired_bootstrap(df, replicates=200).collect()
    assert all(r["significant_improvement"] for r in table)
    again = met.paired_bootstrap(df.repartition(7), replicates=200).collect()
    assert [r["median_delta"] for r in table] == pytest.approx([r["median_delta"] for r in again])


def people(spark, rows):
    return spark.createDataFrame(rows, "key long, treatment int, outcome int, score double")


def test_lift_table_with_one_arm_and_one_row(spark):
    treated = uplift.lift_table(people(spark, [(i, 1, i % 2, float(i)) for i in range(20)])).collect()
    assert len(treated) == 10 and all(r["control_rate"] is None and r["incremental_lift"] is None for r in treated)
    single = uplift.lift_table(people(spark, [(1, 1, 1, 0.5)])).collect()
    assert {r["segment_size"] for r in single} == {1} and len(single) == 10


def test_constant_score_orders_by_key(spark):
    rows = [(i, i % 2, 1 if i < 10 else 0, 0.5) for i in range(100)]
    table = {r["decile"]: r for r in uplift.lift_table(people(spark, rows)).collect()}
    assert table[1]["treated_rate"] == 1.0 and table[10]["treated_rate"] == 0.1
    curve = uplift.qini_curve(people(spark, rows))
    assert [r["key"] for r in curve.orderBy("rank").collect()] == list(range(100))
