"""Platt and isotonic calibration, single and fold ensembles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Model
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adweave.operators.models import fold_number, positive_probability


def fit_platt(holdout: DataFrame, score: str = "p", label: str = "label") -> tuple[float, float]:
    """(slope, intercept) of a sigmoid on held-out scores with smoothed targets.

    Each row stands for a positive and a negative example with weights t and 1-t, where t is
    (N₊+1)/(N₊+2) for positives and 1/(N₋+2) for negatives. Equal scores are merged first.
    """
    sizes = holdout.agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("n")).first()
    high, low = (sizes["p"] + 1) / (sizes["p"] + 2), 1 / (sizes["n"] + 2)
    target = F.when(F.col(label) == 1, F.lit(high)).otherwise(F.lit(low))
    merged = holdout.groupBy(F.col(score).alias("s")).agg(F.sum(target).alias("t1"), F.sum(1 - target).alias("t0"))
    rows = merged.select("s", F.expr("stack(2, 1.0D, t1, 0.0D, t0) as (y, w)"))
    ready = VectorAssembler(inputCols=["s"], outputCol="features").transform(rows)
    model = LogisticRegression(labelCol="y", weightCol="w", regParam=0.0, maxIter=100, tol=1e-9).fit(ready)
    return float(model.coefficients[0]), float(model.intercept)


def apply_platt(df: DataFrame, slope: float, intercept: float, score: str = "p", name: str = "p_calibrated") -> DataFrame:
    return df.withColumn(name, 1 / (1 + F.exp(-(F.lit(slope) * F.col(score) + F.lit(intercept)))))


def fit_isotonic(holdout: DataFrame, score: str = "p", label: str = "label"):
    """Monotone step-linear map of held-out scores; equal scores are merged with their weight first."""
    merged = holdout.groupBy(F.col(score).cast("double").alias("s")).agg(F.avg(F.col(label).cast("double")).alias("y"), F.count(F.lit(1)).cast("double").alias("w"))
    return IsotonicRegression(featuresCol="s", labelCol="y", weightCol="w", predictionCol="p_iso").fit(merged)


def apply_isotonic(df: DataFrame, model, score: str = "p", name: str = "p_calibrated") -> DataFrame:
    mapped = model.transform(df.withColumn("s", F.col(score).cast("double")))
    return mapped.withColumnRenamed("p_iso", name).drop("s")


def fold_ensemble(
    train: DataFrame, test: DataFrame, key: str, fit: Callable[[DataFrame], Model], folds: int = 3, method: str = "isotonic", label: str = "label"
) -> DataFrame:
    """``test`` with ``p_calibrated``: per fold a model on the other folds, calibrated on the fold, averaged."""
    tagged = train.withColumn("_fold", fold_number(key, folds))
    names = []
    for k in range(folds):
        model = fit(tagged.where(F.col("_fold") != k))
        held = positive_probability(model, tagged.where(F.col("_fold") == k))
        scored = positive_probability(model, test, "_p")
        name = f"_cal{k}"
        if method == "isotonic":
            test = apply_isotonic(scored, fit_isotonic(held, label=label), "_p", name)
        else:
            test = apply_platt(scored, *fit_platt(held, label=label), "_p", name)
        test = test.drop("_p")
        names.append(name)
    average = sum((F.col(n) for n in names), F.lit(0.0)) / len(names)
    return test.withColumn("p_calibrated", average).drop(*names)
