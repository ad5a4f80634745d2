"""Scoring with a fitted pipeline, the same for batch tables and streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, IndexToString, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from adweave.sources.sinks import append_stream


def scoring_pipeline(numeric: Sequence[str], categorical: Sequence[str], label: str, estimator) -> Pipeline:
    """Impute, encode, classify and turn the class index back into its label.

    Unknown categories go to their own level, so scoring never fails on a new value; rows without a label are not
    trained on. Numbers are scaled, so a penalty treats them alike.
    """
    numeric, categorical = list(numeric), list(categorical)
    stages = [
        StringIndexer(inputCol=label, outputCol="label", stringOrderType="alphabetAsc", handleInvalid="skip"),
        Imputer(inputCols=numeric, outputCols=[f"{c}_filled" for c in numeric], strategy="median", relativeError=0.001),
    ]
    if categorical:
        stages.append(StringIndexer(inputCols=categorical, outputCols=[f"{c}_ix" for c in categorical], stringOrderType="alphabetAsc", handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCols=[f"{c}_ix" for c in categorical], outputCols=[f"{c}_oh" for c in categorical]))
    stages += [VectorAssembler(inputCols=[f"{c}_filled" for c in numeric], outputCol="numbers"), StandardScaler(inputCol="numbers", outputCol="scaled", withMean=True)]
    inputs = ["scaled"] + [f"{c}_oh" for c in categorical]
    stages += [VectorAssembler(inputCols=inputs, outputCol="features"), estimator]
    return Pipeline(stages=stages)


def class_labels(model: PipelineModel) -> list[str]:
    return list(model.stages[0].labelsArray[0])


def positive_class(labels: Sequence[str]) -> tuple[int, str]:
    """Index and name of the class whose probability is reported: 'yes', else '1', else the last."""
    if not labels:
        return 1, "1"
    lower = [str(v).lower() for v in labels]
    index = lower.index("yes") if "yes" in lower else lower.index("1") if "1" in lower else len(labels) - 1
    return index, str(labels[index])


def score(model: PipelineModel, rows: DataFrame, keep: Sequence[str] | None = None) -> DataFrame:
    """Input columns plus ``prediction_label`` and ``churn_probability``; works on batch and stream."""
    labels = class_labels(model)
    index, _ = positive_class(labels)
    scoring = PipelineModel(model.stages[1:])
    named = IndexToString(inputCol="prediction", outputCol="prediction_label", labels=labels)
    out = named.transform(scoring.transform(rows))
    columns = list(keep) if keep is not None else rows.columns
    return out.select(*columns, "prediction_label", vector_to_array("probability")[index].alias("churn_probability"))


def scored_log_rows(scored: DataFrame) -> DataFrame:
    """Adds ``timestamp_utc`` in ISO form."""
    stamp = F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    return scored.withColumn("timestamp_utc", stamp)


def score_stream(model: PipelineModel, source: DataFrame, path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Scores a stream of customer rows into the scored log."""
    return append_stream(scored_log_rows(score(model, source)), path, checkpoint, available_now=available_now)
