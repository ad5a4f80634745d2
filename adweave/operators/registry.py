"""Run log and model registry kept as tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN_LOG = "run_id string, kind string, key string, value string"
CHECKLIST = ["scoring_model_used", "boosted_roc_auc", "best_threshold", "best_profit", "risk_top20_capture_rate", "uplift_data_source", "uplift_demo_only"]


def run_rows(spark: SparkSession, run_id: str, params: Mapping | None = None, metrics: Mapping | None = None, tables: Mapping[str, Sequence[Mapping]] | None = None) -> DataFrame:
    """(run_id, kind, key, value, ts) rows of one run; a table is stored as one JSON value per row."""
    import json

    rows = [(run_id, "param", k, str(v)) for k, v in (params or {}).items()]
    rows += [(run_id, "metric", k, repr(float(v))) for k, v in (metrics or {}).items()]
    for name, items in (tables or {}).items():
        rows += [(run_id, f"table:{name}", str(i), json.dumps(dict(item), default=str)) for i, item in enumerate(items)]
    return spark.createDataFrame(rows, RUN_LOG).withColumn("ts", F.current_timestamp())


def log_run(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def compare_runs(log: DataFrame, keys: Sequence[str], kind: str = "metric") -> DataFrame:
    """One row per run with the chosen metrics as columns."""
    chosen = log.where(F.col("kind") == kind)
    return chosen.groupBy("run_id").pivot("key", list(keys)).agg(F.max(F.col("value").try_cast("double")))


def latest_versions(entries: DataFrame) -> DataFrame:
    """(model, version): highest N of names ``version-N`` with metadata; other names are ignored."""
    number = F.regexp_extract("name", r"^version-(\d+)$", 1).try_cast("int")
    return entries.where(F.col("has_metadata")).select("model", number.alias("version")).where("version is not null").groupBy("model").agg(
        F.max("version").alias("version")
    )


def _entries(spark: SparkSession, root: str, model: str) -> DataFrame:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(f"{root}/{model}")
    system = folder.getFileSystem(conf)
    if not system.exists(folder):
        raise FileNotFoundError(f"no registered model at {root}/{model}")
    listed = [s.getPath() for s in system.listStatus(folder)]
    meta = lambda p: system.exists(jvm.org.apache.hadoop.fs.Path(p, "meta"))
    return spark.createDataFrame([(model, p.getName(), meta(p)) for p in listed], "model string, name string, has_metadata boolean")


def register_model(model: PipelineModel, root: str, name: str, spark: SparkSession, metadata: Mapping | None = None) -> int:
    """Saves the model as the next version; the metadata is written last, so a half-written version is never latest."""
    try:
        version = latest_version(spark, root, name) + 1
    except FileNotFoundError:
        version = 1
    target = f"{root}/{name}/version-{version}"
    model.write().overwrite().save(f"{target}/model")
    rows = [(str(k), str(v)) for k, v in {"name": name, "version": version, **(metadata or {})}.items()]
    spark.createDataFrame(rows, "key string, value string").coalesce(1).write.mode("overwrite").json(f"{target}/meta")
    return version


def latest_version(spark: SparkSession, root: str, name: str) -> int:
    row = latest_versions(_entries(spark, root, name)).first()
    if row is None:
        raise FileNotFoundError(f"no version with metadata under {root}/{name}")
    return row["version"]


def load_latest(spark: SparkSession, root: str, name: str) -> tuple[PipelineModel, int]:
    version = latest_version(spark, root, name)
    return PipelineModel.load(f"{root}/{name}/version-{version}/model"), version


def verification_checklist(log: DataFrame, keys: Sequence[str] = tuple(CHECKLIST)) -> DataFrame:
    """(item, value): the newest logged value of each key, 'not_set' when there is none."""
    newest = log.groupBy("key").agg(F.max_by("value", "ts").alias("value"))
    wanted = log.sparkSession.createDataFrame([(k,) for k in keys], "key string")
    return wanted.join(newest, "key", "left").select(F.col("key").alias("item"), F.coalesce("value", F.lit("not_set")).alias("value"))
