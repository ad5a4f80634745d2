"""Mix edge rules, splits, streaming restart, registry, scored log, calibration."""

import pytest
from pyspark.sql import functions as F

from adweave import schemas
from adweave.operators import calibration, mix, models, quality, registry, scoring
from adweave.sources import readers, sinks
from adweave.streaming import ingest


def daily(spark, spends):
    rows = [(f"2024-01-{i + 1:02d}", 100.0, *s) for i, s in enumerate(spends)]
    table = spark.createDataFrame(rows, "date string, revenue double, spend_search double, spend_social double, spend_display double, spend_email double")
    return mix.load_mix_wide(table)


def test_adstock_of_constant_and_zero_spend(spark):
    rows = mix.prepare(daily(spark, [(1.0, 0.0, 1.0, 0.0)] * 5)).orderBy("date").collect()
    want, last = [], 0.0
    for _ in range(5):
        last = 1.0 + 0.65 * last
        want.append(last)
    assert [r["ad_search"] for r in rows] == pytest.approx(want)
    assert [r["ad_social"] for r in rows] == [0.0] * 5


def test_zero_spend_and_negative_scores(spark):
    table = spark.createDataFrame([("a", 10.0, 0.0, None), ("b", -5.0, 10.0, -0.5)], "channel string, estimated_contribution double, total_spend double, estimated_roi double")
    rows = {r["channel"]: r for r in mix.allocate_budget(table).collect()}
    assert rows["a"]["recommended_spend"] == pytest.approx((9 - 0.5) / 2) and rows["b"]["recommended_spend"] == pytest.approx(0.5 + 4.25)
    kpi = {r["channel"]: r for r in mix.kpi_table(table).collect()}
    assert kpi["a"]["roas"] is None and kpi["a"]["roi"] is None and kpi["b"]["roas"] == -0.5


def test_mix_needs_its_columns(spark):
    with pytest.raises(ValueError):
        mix.load_mix_long(spark.createDataFrame([("2024-01-01", "x", 1.0)], "date string, channel string, spend double"))


def test_log_split(spark):
    log = lambda n: spark.createDataFrame([(i, f"2024-01-01 00:00:{i:02d}", 0.5) for i in range(n)], "key long, timestamp_utc string, churn_probability double")
    with pytest.raises(ValueError):
        quality.split_log(log(5))
    parts = quality.split_log(log(7)).groupBy("part").count().collect()
    assert {r["part"]: r["count"] for r in parts} == {"reference": 3, "current": 4}


def test_json_parsing(spark):
    texts = ['{"username": "a", "action": "view", "timestamp": 1.5, "event_date": "20240101", "extra": 1}', '{"username": "b"}', "no json"]
    raw = spark.createDataFrame([(t,) for t in texts], "value string")
    rows = ingest.parse_json_events(raw).collect()
    assert len(rows) == 3 and rows[0]["action"] == "view" and rows[1]["action"] is None and rows[2]["username"] is None
    good, dead = ingest.split_malformed(raw)
    assert good.count() == 2 and [r["raw"] for r in dead.collect()] == ["no json"]


def test_stream_continues_after_restart(spark, tmp_path):
    inbox, out, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    inbox.mkdir()
    (inbox / "a.json").write_text('{"username": "a", "action": "view"}\n')
    run = lambda: ingest.ingest_stream(readers.read_event_stream(spark, "text", path=str(inbox)), out, check, available_now=True).awaitTermination()
    run()
    (inbox / "b.json").write_text('{"username": "b", "action": "purchase"}\nbroken\n')
    run()
    run()
    rows = spark.read.parquet(out).collect()
    assert sorted(str(r["username"]) for r in rows) == ["None", "a", "b"]


def test_registry_takes_the_highest_number(spark):
    names = ["version-2", "version-9", "version-13", "tmp", "version-x"]
    entries = spark.createDataFrame([("m", n, True) for n in names] + [("m", "version-99", False)], "model string, name string, has_metadata boolean")
    assert registry.latest_versions(entries).first()["version"] == 13


def test_scored_log_schema_change(spark, tmp_path):
    path = str(tmp_path / "log")
    old, new = spark.range(3).withColumn("p", F.lit(0.1)), spark.range(2).withColumn("q", F.lit(0.2))
    assert sinks.append_scored(old, path) == path
    assert sinks.append_scored(old, path) == path and spark.read.parquet(path).count() == 6
    assert sinks.append_scored(new, path) == path + "_v2" and spark.read.parquet(path).count() == 6
    assert sinks.append_scored(new, path, reset=True) == path and spark.read.parquet(path).columns == ["id", "q"]


def test_positive_class_choice():
    assert scoring.positive_class(["No", "Yes"]) == (1, "Yes")
    assert scoring.positive_class(["1", "0"]) == (0, "1")
    assert scoring.positive_class(["a", "b", "c"]) == (2, "c")


def test_scored_log_schema_has_all_columns():
    assert len(schemas.TELCO_CUSTOMER) == 19 and schemas.SCORED_LOG.names[-1] == "churn_probability"


def test_isotonic_is_monotone_and_keeps_the_mean(spark):
    rows = [(i / 100, 1 if (i * 37) % 100 < i else 0) for i in range(100)]
    df = spark.createDataFrame(rows, "p double, label int")
    out = calibration.apply_isotonic(df, calibration.fit_isotonic(df)).orderBy("p").collect()
    values = [r["p_calibrated"] for r in out]
    assert values == sorted(values)
    assert sum(values) == pytest.approx(sum(r["label"] for r in out))


def test_platt_recovers_a_sigmoid(spark):
    df = spark.createDataFrame([(i / 200, 1 if (i * 7919) % 200 < i else 0) for i in range(200)], "p double, label int")
    slope, intercept = calibration.fit_platt(df)
    assert slope > 0 and -slope < intercept < 0


def test_logistic_penalty_mapping(spark):
    """The penalised optimum has a zero gradient: sum(x·(p−y)) + beta/C = 0."""
    rows = [(float(i % 7) - 3, 1.0 if (i * 31) % 10 < 3 + i % 7 else 0.0) for i in range(200)]
    df = models.assemble(spark.createDataFrame(rows, "x double, label double"), ["x"])
    model = models.logistic(200, c=0.5, max_iter=200).fit(df)
    scored = models.positive_probability(model, df)
    gradient = scored.agg(F.sum(F.col("x") * (F.col("p") - F.col("label")))).first()[0]
    assert gradient + model.coefficients[0] / 0.5 == pytest.approx(0, abs=0.05)


def test_gzip_touch_log_and_schema_evolution(spark, tmp_path):
    import gzip

    path = tmp_path / "log.tsv.gz"
    with gzip.open(path, "wt") as f:
        f.write("timestamp\tuid\tcampaign\tcost\tconversion\tconversion_timestamp\tconversion_id\n1\tu\tc\t0.1\t1\t5\t9\n")
    row = readers.read_touch_log(spark, str(path)).first()
    assert row["uid"] == "u" and row["conversion_id"] == "9"
    out = str(tmp_path / "table")
    spark.range(1).write.parquet(out)
    spark.range(1).withColumn("extra", F.lit("x")).write.mode("append").parquet(out)
    assert sinks.read_evolving(spark, out).columns == ["id", "extra"]


@pytest.mark.parametrize("name", ["mdl9_learning_curve", "cal3_fold_ensemble", "ops3_batch_scoring"])
def test_logistic_queries_run_to_the_default_iterations(spark, sf_dir, monkeypatch, name):
    from adweave.plans.catalog import QUERIES

    made, logistic = [], models.logistic
    monkeypatch.setattr(models, "logistic", lambda *a, **k: made.append(logistic(*a, **k)) or made[-1])
    QUERIES[name](spark, sf_dir)
    assert made and {m.getMaxIter() for m in made} == {100}


def test_wide_categories_become_sparse_vectors(spark):
    """5,000 levels: no column each, no list in one cell, and the same zeros and ones."""
    from adweave.operators import features

    rows = [(i, f"v{i % 5000:04d}", "x" if i % 3 else "y", float(i % 7)) for i in range(10_001)]
    train = spark.createDataFrame(rows, "key long, wide string, slim string, amount double")
    test = spark.createDataFrame([(1, "v0000", "x", 1.0), (2, "v0001", "y", 2.0), (3, "v4999", "x", 3.0), (4, "none", "x", None), (5, None, None, 0.0)], "key long, wide string, slim string, amount double")
    numbered = {r["value"]: (r["place"], r["size"], r["n"]) for r in features.number_categories(train, ["wide"]).collect()}
    assert numbered == {f"v{k:04d}": (k, 5000, 3 if k == 0 else 2) for k in range(5000)}
    ready, names = features.design_matrix(train, test, ["amount"], ["slim", "wide"])
    assert names == ["amount", "slim_y", "wide_levels"]
    got = {r["key"]: r["wide_levels"] for r in models.assemble(ready, names).collect()}
    assert {k: (v.size, list(v.indices)) for k, v in got.items()} == {1: (4999, []), 2: (4999, [4998]), 3: (4999, [0]), 4: (4999, []), 5: (4999, [])}
    plain, _ = features.sparse_dummies(test, features.number_categories(train, ["wide"]), ["wide"], impute=False)
    assert {r["key"]: r["wide_levels"].numNonzeros() for r in plain.collect()} == {1: 0, 2: 1, 3: 1, 4: 0, 5: 0}


def test_training_rows_are_dealt_by_their_number(spark):
    held = models.TRAIN_ROWS
    try:
        models.TRAIN_ROWS = 100
        rows = models.dealt(spark.range(1_000).coalesce(1), "id")
        assert rows.rdd.getNumPartitions() == 10 and rows.count() == 1_000 and rows.select("id").distinct().count() == 1_000
        assert models.dealt(spark.range(0), "id").count() == 0
    finally:
        models.TRAIN_ROWS = held


def test_growing_sides_are_not_broadcast(spark):
    """Sizes guessed from compressed files must not send running sums or an SVD's basis through the driver."""
    from adweave.operators import decomposition, scan

    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    run = scan.running(spark.range(50).select("id", (F.col("id") % 3).alias("g")), ["g"], [F.col("id")], {"n": F.lit(1)})
    assert "Broadcast" not in plan(run) and run.agg(F.max("n")).first()[0] == 17
    plans, held = [], decomposition.cut_lineage
    try:
        decomposition.cut_lineage = lambda df: plans.append(plan(df)) or held(df)
        cells = spark.createDataFrame([(k % 5, f"t{k % 7}", 1.0 + k) for k in range(20)], "row long, term string, weight double")
        assert decomposition.truncated_svd(cells, "row", 2, passes=1).count() == 5
    finally:
        decomposition.cut_lineage = held
    assert plans and not any("Broadcast" in p for p in plans)
