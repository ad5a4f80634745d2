"""Deterministic splits, estimators, searches and learning curves."""

from __future__ import annotations

import itertools
import random
from collections.abc import Callable, Sequence

from pyspark.ml import Model
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adweave.operators.metrics import EPS_DOUBLE, log_loss_expr, loss_metrics, ranking_metrics

# Multipliers and modulus of the multiplicative key hash, one multiplier per split purpose.
HASH_SPACE = 4294967296
MULTIPLIERS = {"holdout": 2654435761, "calibration": 2246822519, "fold": 3266489917, "curve": 668265263}
REGULARISATION_GRID = [0.05, 0.1, 0.5, 1.0, 2.0]
TRAIN_ROWS = 50_000  # rows of a partition that estimators pass over many times


def hash_unit(key: str, purpose: str) -> Column:
    """Integer in [0, 2^32) from the low bits of a non-negative long key; independent per purpose."""
    return F.pmod(F.pmod(F.col(key).cast("long"), F.lit(HASH_SPACE // 2)) * F.lit(MULTIPLIERS[purpose]), F.lit(HASH_SPACE))


def holdout_flag(key: str, share: float, purpose: str = "holdout") -> Column:
    """True for about ``share`` of the keys; a row never changes side between runs."""
    return hash_unit(key, purpose) < F.lit(int(share * HASH_SPACE))


def stratified_holdout(df: DataFrame, key: str, label: str, share: float, purpose: str = "holdout") -> DataFrame:
    """Adds ``is_test``: the same hash threshold in every stratum, so each keeps its share in expectation."""
    flag = holdout_flag(key, share, purpose)
    return df.withColumn("is_test", F.when(F.col(label).isNotNull(), flag))


def fold_number(key: str, folds: int) -> Column:
    return F.floor(hash_unit(key, "fold") / (HASH_SPACE / folds)).cast("int")


def class_weight(df: DataFrame, label: str) -> float:
    """Negatives per positive."""
    row = df.agg(F.count_if(F.col(label) == 0).alias("n"), F.count_if(F.col(label) == 1).alias("p")).first()
    return row["n"] / max(row["p"], 1)


def balanced_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """n / (2·n_class) per row."""
    row = df.agg(F.count_if(F.col(label) == 0).alias("n0"), F.count_if(F.col(label) == 1).alias("n1")).first()
    n = row["n0"] + row["n1"]
    weight = F.when(F.col(label) == 1, F.lit(n / (2 * max(row["n1"], 1)))).otherwise(F.lit(n / (2 * max(row["n0"], 1))))
    return df.withColumn(name, weight)


def assemble(df: DataFrame, columns: Sequence[str], name: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=name, handleInvalid="error").transform(df)


def logistic(rows: int, c: float = 1.0, max_iter: int = 100, weight: str | None = None, label: str = "label") -> LogisticRegression:
    """L2 logistic regression with inverse penalty ``c``.

    Spark averages the loss over the total weight, so the penalty is 1/(c·rows); balanced weights sum to rows.
    """
    model = LogisticRegression(
        labelCol=label, featuresCol="features", maxIter=max_iter, regParam=1.0 / (c * max(rows, 1)), elasticNetParam=0.0, standardization=False
    )
    return model.setWeightCol(weight) if weight else model


def boosted_trees(
    rounds: int = 60, depth: int = 4, rate: float = 0.1, subsample: float = 0.8, columns: str = "auto",
    min_gain: float = 0.0, min_rows: int = 1, weight: str | None = None, label: str = "label", seed: int = 42,
) -> GBTClassifier:
    """Gradient-boosted trees with the reference's tree count, depth, rate and sampling as parameters."""
    model = GBTClassifier(
        labelCol=label, featuresCol="features", maxIter=rounds, maxDepth=depth, stepSize=rate, subsamplingRate=subsample,
        featureSubsetStrategy=columns, minInfoGain=min_gain, minInstancesPerNode=min_rows, seed=seed,
    )
    return model.setWeightCol(weight) if weight else model


def dealt(df: DataFrame, key: str) -> DataFrame:
    """``df`` in partitions of about ``TRAIN_ROWS`` rows by ``key``, kept in memory or on disk.

    A join leaves as many partitions as its bytes ask for, often one, and then every pass of an estimator is a single task. Their
    number grows with the rows here.
    """
    held = df.persist()
    return held.repartition(max(-(-held.count() // TRAIN_ROWS), 1), key).persist()


def positive_probability(model: Model, df: DataFrame, name: str = "p") -> DataFrame:
    """Scores with the class-1 probability as a plain column."""
    scored = model.transform(df)
    return scored.withColumn(name, vector_to_array("probability")[1]).drop("probability", "rawPrediction", "prediction")


def grid_search_logistic(train: DataFrame, key: str, grid: Sequence[float] = tuple(REGULARISATION_GRID), folds: int = 3, parallelism: int = 4, label: str = "label") -> tuple[CrossValidatorModel, list[dict]]:
    """Inverse penalties by mean fold log loss, refit on all rows. Returns the model and (c, log_loss) rows."""
    rows = train.count()
    base = logistic(int(rows * (folds - 1) / folds), label=label)
    params = ParamGridBuilder().addGrid(base.regParam, [1.0 / (c * rows * (folds - 1) / folds) for c in grid]).build()
    judge = MulticlassClassificationEvaluator(labelCol=label, metricName="logLoss", probabilityCol="probability")
    search = CrossValidator(estimator=base, estimatorParamMaps=params, evaluator=judge, numFolds=folds, foldCol="_fold", parallelism=parallelism)
    fitted = search.fit(train.withColumn("_fold", fold_number(key, folds)))
    return fitted, [{"c": c, "log_loss": float(m)} for c, m in zip(grid, fitted.avgMetrics)]


# Candidate lists of the boosted-tree random search.
SEARCH_SPACE = {
    "maxIter": [20, 40, 60],
    "maxDepth": [3, 4, 5],
    "stepSize": [0.03, 0.05, 0.1],
    "subsamplingRate": [0.7, 0.8, 1.0],
    "minInstancesPerNode": [1, 3, 5],
    "minInfoGain": [0.0, 0.01, 0.1],
}


def random_search_trees(train: DataFrame, key: str, draws: int = 20, folds: int = 3, seed: int = 42, parallelism: int = 4, label: str = "label", space: dict | None = None) -> tuple[CrossValidatorModel, list[dict]]:
    """``draws`` parameter sets picked without repetition by ``seed``, compared by mean fold ROC-AUC."""
    space = space or SEARCH_SPACE
    combos = [dict(zip(space, values)) for values in itertools.product(*space.values())]
    picked = random.Random(seed).sample(combos, min(draws, len(combos)))
    base = boosted_trees(label=label)
    params = [{getattr(base, k): v for k, v in combo.items()} for combo in picked]
    judge = BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC", numBins=0)
    search = CrossValidator(estimator=base, estimatorParamMaps=params, evaluator=judge, numFolds=folds, foldCol="_fold", parallelism=parallelism)
    fitted = search.fit(train.withColumn("_fold", fold_number(key, folds)))
    return fitted, [dict(combo, roc_auc=float(m)) for combo, m in zip(picked, fitted.avgMetrics)]


def feature_importance(model: Model, names: Sequence[str], spark, k: int = 10) -> DataFrame:
    """Top-k importances of a fitted tree model as (feature, importance)."""
    rows = [(n, float(v)) for n, v in zip(names, model.featureImportances.toArray())]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature").limit(k)


def permutation_importance(model: Model, df: DataFrame, columns: Sequence[str], key: str, label: str = "label", buckets: int = 4096) -> DataFrame:
    """Mean absolute change of the predicted probability when one column takes another row's value.

    It takes the place of per-row tree attributions. Each row is given the values of the row after it in a
    hash order inside hash buckets, so one shuffle serves all columns; take more ``buckets`` for more rows.
    """
    from pyspark.sql import Window

    bucket = F.pmod(F.xxhash64(key), F.lit(buckets))
    ring = Window.partitionBy("_b").orderBy(F.xxhash64(F.lit(7), F.col(key)), key)
    start = ring.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    neighbour = F.struct(*columns)
    paired = df.withColumn("_b", bucket).withColumn("_swap", F.coalesce(F.lead(neighbour).over(ring), F.first(neighbour).over(start)))
    score = lambda frame: positive_probability(model, assemble(frame.drop("features"), columns))
    frame = score(paired).withColumnRenamed("p", "_p0")
    for k, c in enumerate(columns):  # all changes of a row are scored in the same pass
        frame = score(frame.withColumnRenamed(c, "_own").withColumn(c, F.col(f"_swap.{c}")))
        frame = frame.withColumn(f"_change{k}", F.abs(F.col("p") - F.col("_p0"))).drop("p", c).withColumnRenamed("_own", c)
    means = frame.agg(*[F.avg(f"_change{k}").alias(f"_change{k}") for k in range(len(columns))])
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"_change{k}").alias("mean_abs_change")) for k, c in enumerate(columns)])
    return means.select(F.inline(cells))


def auc_gap(scored: DataFrame) -> DataFrame:
    """Train and test ROC-AUC and their difference per model; ``split`` is train or test."""
    aucs = ranking_metrics(scored, ("model", "split"))
    at = lambda s: F.max(F.when(F.col("split") == s, F.col("roc_auc")))
    return aucs.groupBy("model").agg(
        at("train").alias("train_auc"), at("test").alias("test_auc"), (at("train") - at("test")).alias("gap")
    )


def learning_curve(
    df: DataFrame, key: str, fit: Callable[[DataFrame], Model], sizes: Sequence[float] = (0.1, 0.325, 0.55, 0.775, 1.0),
    folds: int = 3, label: str = "label", eps: float = EPS_DOUBLE,
) -> DataFrame:
    """Mean train and validation log loss per training share; folds and shares come from key hashes."""
    spark = df.sparkSession
    tagged = df.withColumn("_fold", fold_number(key, folds)).withColumn("_u", hash_unit(key, "curve")).persist()
    rows = []
    for size in sizes:
        for fold in range(folds):
            train = tagged.where((F.col("_fold") != fold) & (F.col("_u") < int(size * HASH_SPACE)))
            model = fit(train)
            parts = train.withColumn("_s", F.lit("train")).unionByName(tagged.where(F.col("_fold") == fold).withColumn("_s", F.lit("valid")))
            scored = positive_probability(model, parts)
            losses = scored.groupBy("_s").agg(F.count(F.lit(1)).alias("n"), F.avg(log_loss_expr(F.col(label), F.col("p"), eps)).alias("ll")).collect()
            at = {r["_s"]: r for r in losses}
            rows.append((float(size), fold, int(at["train"]["n"]), float(at["train"]["ll"]), float(at["valid"]["ll"])))
    tagged.unpersist()
    table = spark.createDataFrame(rows, "train_share double, fold int, train_rows long, train_loss double, valid_loss double")
    return table.groupBy("train_share").agg(
        F.avg("train_rows").alias("train_rows"), F.avg("train_loss").alias("train_log_loss"), F.avg("valid_loss").alias("valid_log_loss")
    )


def evaluate(scored: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    return ranking_metrics(scored, by).join(loss_metrics(scored, by), list(by))


