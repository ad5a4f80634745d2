"""Uplift learners. Each returns the scored rows with an added ``score`` column.

Input rows have ``features``, ``treatment`` and ``outcome``; treatment and outcome are never features.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adweave.operators.models import fold_number, positive_probability

Fit = Callable[[DataFrame], Model]


def _labelled(df: DataFrame) -> DataFrame:
    return df.withColumn("label", F.col("outcome").cast("double"))


def _arm(df: DataFrame, arm: int) -> DataFrame:
    return _labelled(df.where(F.col("treatment") == arm))


def forest(label: str, trees: int = 20, depth: int = 5, weight: str | None = None, seed: int = 42) -> RandomForestRegressor:
    model = RandomForestRegressor(featuresCol="features", labelCol=label, numTrees=trees, maxDepth=depth, seed=seed, predictionCol="_tau")
    return model.setWeightCol(weight) if weight else model


def t_learner(train: DataFrame, test: DataFrame, fit: Fit) -> DataFrame:
    """Difference of two models, one per arm."""
    scored = positive_probability(fit(_arm(train, 1)), test, "_p1")
    scored = positive_probability(fit(_arm(train, 0)), scored, "_p0")
    return scored.withColumn("score", F.col("_p1") - F.col("_p0")).drop("_p1", "_p0")


def s_learner(train: DataFrame, test: DataFrame, columns: Sequence[str], fit: Fit) -> DataFrame:
    """One model with the treatment as a feature, scored with 1 and with 0."""
    join = VectorAssembler(inputCols=[*columns, "_t"], outputCol="features")
    prepare = lambda df, t: join.transform(df.drop("features").withColumn("_t", t.cast("double")))
    model = fit(_labelled(prepare(train, F.col("treatment"))))
    first = positive_probability(model, prepare(test, F.lit(1)), "_p1").drop("features", "_t")
    both = positive_probability(model, prepare(first, F.lit(0)), "_p0").drop("features", "_t")
    return both.withColumn("score", F.col("_p1") - F.col("_p0")).drop("_p1", "_p0")


def x_learner(train: DataFrame, test: DataFrame, fit: Fit, trees: int = 20) -> DataFrame:
    """Imputed effects of each arm, weighted by the treated share of the training rows."""
    treated, control = _arm(train, 1), _arm(train, 0)
    d1 = positive_probability(fit(control), treated, "_m").withColumn("_d", F.col("label") - F.col("_m"))
    d0 = positive_probability(fit(treated), control, "_m").withColumn("_d", F.col("_m") - F.col("label"))
    tau1, tau0 = forest("_d", trees).fit(d1), forest("_d", trees).fit(d0)
    share = train.agg(F.avg(F.col("treatment").cast("double"))).first()[0]
    scored = tau1.transform(test).withColumnRenamed("_tau", "_t1")
    scored = tau0.transform(scored).withColumnRenamed("_tau", "_t0")
    return scored.withColumn("score", (1 - F.lit(share)) * F.col("_t1") + F.lit(share) * F.col("_t0")).drop("_t1", "_t0")


def r_learner(train: DataFrame, test: DataFrame, key: str, fit: Fit, folds: int = 2, trees: int = 20) -> DataFrame:
    """Cross-fitted residual learner with a weighted forest.

    It takes the place of the reference's optional causal forest; the forest is not honest, so the
    intervals of that method are not available.
    """
    tagged = _labelled(train).withColumn("_fold", fold_number(key, folds))
    share = train.agg(F.avg(F.col("treatment").cast("double"))).first()[0]
    parts = None
    for k in range(folds):
        held = positive_probability(fit(tagged.where(F.col("_fold") != k)), tagged.where(F.col("_fold") == k), "_m")
        parts = held if parts is None else parts.unionByName(held)
    residual = F.col("treatment") - F.lit(share)
    ready = parts.withColumns({"_target": (F.col("label") - F.col("_m")) / residual, "_w": residual * residual})
    return forest("_target", trees, weight="_w").fit(ready).transform(test).withColumnRenamed("_tau", "score")
