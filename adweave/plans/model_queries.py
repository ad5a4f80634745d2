"""Registered queries: estimators, calibration, uplift learners, model operations, streaming."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from adweave import schemas
from adweave.operators import calibration as cal
from adweave.operators import features as fea
from adweave.operators import metrics as met
from adweave.operators import models, registry, scoring, uplift
from adweave.operators import uplift_models as ulm
from adweave.operators.decomposition import truncated_svd
from adweave.operators.quality import split_log
from adweave.plans import fixtures as fx
from adweave.plans.mix_queries import CATEGORICAL, NUMERIC
from adweave.session import shared_folder
from adweave.sources import catalog, readers, sinks
from adweave.streaming import ingest

QUERIES, ORACLE = {}, {}


def _register(name, sql=None):
    def wrap(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return wrap


def _folder(spark, name: str) -> str:
    """A new folder of this run under the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


# ---- estimators --------------------------------------------------------------------------------


def _churn_split(spark, d):
    """Train and test rows of the churn table with features fitted on train."""
    table = fx.churn(spark, d).withColumn("label", F.when(F.col("Churn") == "Yes", 1.0).otherwise(0.0))
    table = fea.churn_features(table)
    numeric = [*NUMERIC, "tenure_log1p", "monthlycharges_sq", "tenure_x_monthlycharges", "avg_charge_per_tenure"]
    table = models.stratified_holdout(table, "customerID", "label", 0.20).persist()
    ready, columns = fea.design_matrix(table.where("not is_test"), table, numeric, CATEGORICAL)
    ready = models.assemble(ready, columns).select("customerID", "label", "is_test", "features", *columns)
    ready = models.dealt(ready, "customerID")
    return ready.where("not is_test"), ready.where("is_test"), columns


def _as_scored(df, model: str, p: str = "p"):
    return df.select(F.lit(model).alias("model"), F.col("customerID").alias("key"), F.col("label").cast("int").alias("label"), F.col(p).alias("p"))


# Rounds, depth and rate of the churn model.
CHURN_TREES = (250, 4, 0.05)


def _trees(train):
    return models.boosted_trees(*CHURN_TREES).fit(train)


@_register("mdl1_logistic_regression")
def _(spark, d):
    train, test, _ = _churn_split(spark, d)
    rows = train.count()
    plain = models.positive_probability(models.logistic(rows).fit(train), test)
    weighted = models.balanced_weights(train, "label")
    balanced = models.positive_probability(models.logistic(rows, weight="weight").fit(weighted), test)
    return models.evaluate(_as_scored(plain, "plain").unionByName(_as_scored(balanced, "balanced")))


@_register("mdl2_grid_search")
def _(spark, d):
    train, _, _ = _churn_split(spark, d)
    _, rows = models.grid_search_logistic(train, "customerID")
    return spark.createDataFrame([(r["c"], r["log_loss"]) for r in rows], "c double, log_loss double")


@_register("mdl3_boosted_trees")
def _(spark, d):
    train, test, _ = _churn_split(spark, d)
    return models.evaluate(_as_scored(models.positive_probability(_trees(train), test), "trees"))


@_register("mdl4_random_search")
def _(spark, d):
    train, _, _ = _churn_split(spark, d)
    space = dict(models.SEARCH_SPACE, maxIter=[4, 8], maxDepth=[2, 3])
    _, rows = models.random_search_trees(train, "customerID", draws=3, space=space)
    return spark.createDataFrame([(r["maxIter"], r["maxDepth"], r["stepSize"], r["roc_auc"]) for r in rows], "rounds int, depth int, rate double, roc_auc double")


@_register("mdl6_feature_importance")
def _(spark, d):
    train, _, columns = _churn_split(spark, d)
    return models.feature_importance(_trees(train), columns, spark)


@_register("mdl7_permutation_importance")
def _(spark, d):
    train, test, columns = _churn_split(spark, d)
    model = models.logistic(train.count()).fit(train)
    return models.permutation_importance(model, test, columns, "customerID")


@_register("mdl9_learning_curve")
def _(spark, d):
    train, _, _ = _churn_split(spark, d)
    return models.learning_curve(train, "customerID", lambda rows: models.logistic(rows.count()).fit(rows))


@_register("fea5_sparse_svd")
def _(spark, d):
    """Order lines as sparse part vectors per order, reduced to 32 coordinates."""
    rows = fx.table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("row"), F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("term"))
    return truncated_svd(rows.agg(F.sum("l_quantity").alias("weight")), "row", 32)


def _calibration_parts(spark, d):
    train, test, _ = _churn_split(spark, d)
    hold = models.holdout_flag("customerID", 0.25, "calibration")
    model = _trees(train.where(~hold))
    return models.positive_probability(model, train.where(hold)), models.positive_probability(model, test)


@_register("cal1_platt")
def _(spark, d):
    hold, test = _calibration_parts(spark, d)
    return cal.apply_platt(test, *cal.fit_platt(hold)).select("customerID", "label", "p", "p_calibrated")


@_register("cal2_isotonic")
def _(spark, d):
    hold, test = _calibration_parts(spark, d)
    return cal.apply_isotonic(test, cal.fit_isotonic(hold)).select("customerID", "label", "p", "p_calibrated")


@_register("cal3_fold_ensemble")
def _(spark, d):
    train, test, _ = _churn_split(spark, d)
    fit = lambda rows: models.logistic(rows.count()).fit(rows)
    return cal.fold_ensemble(train, test, "customerID", fit).select("customerID", "label", "p_calibrated")


# ---- uplift learners ---------------------------------------------------------------------------

_UPLIFT_COLUMNS = ["c_acctbal", "c_nationkey"]


def _uplift_parts(spark, d):
    table = models.dealt(models.assemble(fx.uplift(spark, d).drop("score"), _UPLIFT_COLUMNS), "key")
    test = models.holdout_flag("key", 0.3)
    return table.where(~test).persist(), table.where(test).persist()


def _fit_uplift(rows):
    return models.boosted_trees().fit(rows)


def _learner(name, run):
    @_register(name)
    def _(spark, d):
        train, test = _uplift_parts(spark, d)
        scored = run(train, test).select("key", "treatment", "outcome", "score").persist()
        return uplift.lift_summary(scored, model=name.split("_", 1)[1])


_learner("upl2_t_learner", lambda train, test: ulm.t_learner(train, test, _fit_uplift))
_learner("upl3_s_learner", lambda train, test: ulm.s_learner(train, test, _UPLIFT_COLUMNS, _fit_uplift))
_learner("upl4_x_learner", lambda train, test: ulm.x_learner(train, test, _fit_uplift))
_learner("upl5_r_learner", lambda train, test: ulm.r_learner(train, test, "key", _fit_uplift))


# ---- model operations --------------------------------------------------------------------------


@_register(
    "ops1_run_comparison",
    fx.with_ctes(["scored"], "SELECT model AS run_id, round(avg((p - label) * (p - label)), 6) AS brier, round(avg(label), 6) AS base_rate FROM scored GROUP BY model"),
)
def _(spark, d):
    losses = fx.scored(spark, d).groupBy("model").agg(F.avg(F.pow(F.col("p") - F.col("label"), F.lit(2.0))).alias("brier"), F.avg("label").alias("base_rate"))
    rows = losses.select(
        F.col("model").alias("run_id"), F.lit("metric").alias("kind"),
        F.expr("stack(2, 'brier', cast(brier as string), 'base_rate', cast(base_rate as string)) as (key, value)"),
    ).withColumn("ts", F.current_timestamp())
    path = _folder(spark, "runs")
    registry.log_run(rows, path)
    table = registry.compare_runs(spark.read.parquet(path), ["brier", "base_rate"])
    return table.select("run_id", F.round("brier", 6).alias("brier"), F.round("base_rate", 6).alias("base_rate"))


@_register(
    "ops2_latest_version",
    """SELECT p_brand AS model, CAST(max(n) AS INT) AS version FROM (SELECT p_brand, TRY_CAST(split_part(name, '-', 2) AS INT) AS n, has_metadata FROM (
      SELECT p_brand, CASE WHEN p_size > 45 THEN 'tmp' ELSE 'version-' || p_size END AS name, p_size BETWEEN 3 AND 40 AS has_metadata FROM part)) WHERE has_metadata GROUP BY 1""",
)
def _(spark, d):
    """Version folders derived from parts: some names are no version, some versions lack metadata."""
    name = F.when(F.col("p_size") > 45, "tmp").otherwise(F.concat(F.lit("version-"), F.col("p_size").cast("string")))
    entries = fx.table(spark, d, "part").select(F.col("p_brand").alias("model"), name.alias("name"), F.col("p_size").between(3, 40).alias("has_metadata"))
    return registry.latest_versions(entries)


def _pipeline(spark, d):
    table = fx.churn(spark, d)
    train = table.where(~models.holdout_flag("customerID", 0.2))
    estimator = models.logistic(train.count())
    model = scoring.scoring_pipeline(NUMERIC, CATEGORICAL, "Churn", estimator).fit(train)
    root = _folder(spark, "registry")
    registry.register_model(model, root, "churn", spark)
    return table, registry.load_latest(spark, root, "churn")[0]


@_register("ops3_batch_scoring")
def _(spark, d):
    table, model = _pipeline(spark, d)
    return scoring.score(model, table.drop("Churn"), ["customerID"])


@_register("ops4_scored_log")
def _(spark, d):
    table, model = _pipeline(spark, d)
    path = _folder(spark, "scored")
    sinks.append_scored(scoring.scored_log_rows(scoring.score(model, table.drop("Churn"))), path)
    return split_log(spark.read.parquet(path), key="customerID")


@_register("dq4_verification_checklist")
def _(spark, d):
    scored = fx.scored(spark, d).where("model = 'b'")
    best = met.threshold_scan(scored).where("best").first()
    capture = met.top_fraction_capture(scored, "key").first()
    auc = met.ranking_metrics(scored).first()
    rows = registry.run_rows(
        spark, "run-1", params={"scoring_model_used": "b"},
        metrics={"boosted_roc_auc": auc["roc_auc"], "best_threshold": best["threshold"], "best_profit": best["profit"], "risk_top20_capture_rate": capture["capture_rate"]},
    )
    return registry.verification_checklist(rows)


# ---- sources, sinks, catalog, streams ----------------------------------------------------------

_EVENT_ROWS = """SELECT 'u' || user_id AS username, event_type AS action, round(epoch_us(ts) / 1e6::DOUBLE, 3) AS timestamp, strftime(ts, '%Y%m%d') AS event_date FROM events"""


def _event_columns(df):
    micros = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    return df.select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("username"), F.col("event_type").alias("action"),
        (micros / 1e6).alias("timestamp"), F.date_format("ts", "yyyyMMdd").alias("event_date"), F.col("event_id"),
    )


def _json_folder(spark, d) -> str:
    """Events as JSON lines in two folders by id parity, as a stream would deliver them in two batches."""
    path = _folder(spark, "events")
    rows = _event_columns(fx.table(spark, d, "events")).withColumn("part", F.col("event_id") % 2)
    rows.select("part", F.to_json(F.struct("username", "action", "timestamp", "event_date")).alias("value")).write.partitionBy("part").text(path)
    return path


@_register("stm1_ingest_stream", _EVENT_ROWS)
def _(spark, d):
    source_path, out, check = _json_folder(spark, d), _folder(spark, "ingested"), _folder(spark, "offsets")
    source = readers.read_event_stream(spark, "text", {"recursiveFileLookup": "true"}, path=source_path)
    ingest.ingest_stream(source, out, check, available_now=True).awaitTermination()
    return sinks.read_evolving(spark, out).withColumn("timestamp", F.round("timestamp", 3))


@_register("stm2_score_stream")
def _(spark, d):
    table, model = _pipeline(spark, d)
    inbox, out, check = _folder(spark, "inbox"), _folder(spark, "scored"), _folder(spark, "offsets")
    table.drop("Churn").write.parquet(inbox)
    source = readers.read_event_stream(spark, "parquet", schema=table.drop("Churn").schema, path=inbox)
    scoring.score_stream(model, source, out, check, available_now=True).awaitTermination()
    return spark.read.parquet(out).select("customerID", "prediction_label", "churn_probability")


@_register("prj1_parse_json_events", "SELECT CAST(json_extract_string(props, '$.k') AS INT) AS k, count(*) AS n FROM events GROUP BY 1")
def _(spark, d):
    raw = fx.table(spark, d, "events").select(F.col("props").cast("binary").alias("value"))
    return ingest.parse_json_events(raw, schemas.struct("k int")).groupBy("k").agg(F.count(F.lit(1)).alias("n"))


@_register(
    "src2_read_touch_log",
    "SELECT CAST(user_id AS VARCHAR) AS uid, count(*) AS touches, count(*) FILTER (event_type = 'purchase') AS conversions FROM events GROUP BY 1",
)
def _(spark, d):
    path = _folder(spark, "touches")
    rows = fx.table(spark, d, "events").select(
        F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)").alias("timestamp"), F.col("user_id").alias("uid"), F.col("event_type").alias("campaign"),
        (F.col("event_type") == "purchase").cast("int").alias("conversion"), F.lit(-1).alias("conversion_timestamp"), F.col("event_id").alias("conversion_id"), F.lit(0).alias("cost"),
    )
    rows.write.option("sep", "\t").option("header", True).option("compression", "gzip").csv(path)
    log = readers.read_touch_log(spark, path)
    return log.groupBy("uid").agg(F.count(F.lit(1)).alias("touches"), F.count_if(F.col("conversion") == "1").alias("conversions"))


@_register("src3_read_csv_table", "SELECT o_orderkey, round(o_totalprice, 2) AS o_totalprice, o_orderpriority FROM orders")
def _(spark, d):
    path = _folder(spark, "orders-csv")
    fx.table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority").write.option("header", True).csv(path)
    table = readers.read_csv_table(spark, path, schemas.struct("o_orderkey long, o_totalprice double, o_orderpriority string"))
    return table.withColumn("o_totalprice", F.round("o_totalprice", 2))


@_register("src4_read_libsvm", "SELECT l_linenumber AS label, count(*) AS n, round(sum(l_quantity), 3) AS first_sum FROM lineitem GROUP BY 1")
def _(spark, d):
    from pyspark.ml.functions import vector_to_array

    path = _folder(spark, "libsvm")
    line = F.concat_ws(" ", F.col("l_linenumber").cast("string"), F.concat(F.lit("1:"), F.col("l_quantity").cast("string")), F.concat(F.lit("3:"), F.col("l_tax").cast("string")))
    fx.table(spark, d, "lineitem").select(line.alias("value")).write.text(path)
    rows = readers.read_libsvm(spark, path, num_features=3, max_features=2)
    first = vector_to_array("features")[0]
    return rows.groupBy(F.col("label").cast("int").alias("label")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(first), 3).alias("first_sum"))


@_register("src5_head_sample", "SELECT event_id, user_id, event_type FROM events ORDER BY event_id LIMIT 1000")
def _(spark, d):
    return readers.head_sample(fx.table(spark, d, "events").select("event_id", "user_id", "event_type"), 1000, ["event_id"])


@_register("src6_first_existing", "SELECT count(*) AS n FROM orders")
def _(spark, d):
    path = readers.first_existing(spark, [f"{d}/missing.parquet", f"{d}/orders.parquet"])
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n"))


@_register(
    "snk2_measurement_table",
    fx.with_ctes(["exposures", "conversions", "joined"], "SELECT 7 AS lookback_days, conversion_id, exposure_id, channel, round(hours, 6) AS hours_before_conversion FROM joined"),
)
def _(spark, d):
    from adweave.operators import joins

    path = _folder(spark, "measurement")
    sinks.write_measurement_table(joins.measurement_table(fx.exposures(spark, d), fx.conversions(spark, d), 7), path)
    return spark.read.parquet(path).select("lookback_days", "conversion_id", "exposure_id", "channel", F.round("hours_before_conversion", 6).alias("hours_before_conversion"))


@_register("cat1_register_table", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def _(spark, d):
    name = f"orders_{uuid.uuid4().hex[:8]}"
    table = catalog.register_table(spark, "adweave_demo", name, f"{d}/orders.parquet")
    rows = catalog.register_table(spark, "adweave_demo", name, f"{d}/orders.parquet") and spark.table(table)
    catalog.drop_table(spark, "adweave_demo", name)
    return rows.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@_register("cat2_list_tables", "SELECT count(*) AS rows, true AS listed FROM events")
def _(spark, d):
    name = f"events_{uuid.uuid4().hex[:8]}"
    catalog.register_table(spark, "adweave_demo", name, f"{d}/events.parquet")
    listed = name in catalog.list_tables(spark, "adweave_demo")
    counts = spark.table(f"adweave_demo.{name}").agg(F.count(F.lit(1)).alias("rows"))
    catalog.drop_table(spark, "adweave_demo", name)
    return counts.withColumn("listed", F.lit(listed))


@_register("cat2_preview", "SELECT least(10, count(*)) AS previewed FROM orders")
def _(spark, d):
    name = f"orders_{uuid.uuid4().hex[:8]}"
    table = catalog.register_table(spark, "adweave_demo", name, f"{d}/orders.parquet")
    rows = catalog.preview(spark, table)
    catalog.drop_table(spark, "adweave_demo", name)
    return rows.agg(F.count(F.lit(1)).alias("previewed"))
