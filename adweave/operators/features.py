"""Model features: churn terms, imputation, scaling and explicit dummy columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adweave.operators import scan
from adweave.operators.ordered import exact_quantiles

MAX_CATEGORIES = 1_000  # levels up to which each has a column of its own
# Candidate column names for treatment and outcome, in order of preference.
TREATMENT_NAMES = ["treatment", "is_treated", "offer", "retention_offer", "campaign_flag"]
OUTCOME_NAMES = ["retained", "conversion", "responded", "response", "visit", "churn", "Churn"]


def churn_features(df: DataFrame) -> DataFrame:
    """Nonlinear terms of tenure and charges, each only when its source columns exist."""
    have = set(df.columns)
    terms = {}
    tenure, monthly = F.col("tenure").cast("double"), F.col("MonthlyCharges").cast("double")
    if "tenure" in have:
        terms["tenure_log1p"] = F.log1p(tenure)
    if "MonthlyCharges" in have:
        terms["monthlycharges_sq"] = monthly * monthly
    if {"tenure", "MonthlyCharges"} <= have:
        terms["tenure_x_monthlycharges"] = tenure * monthly
    if {"TotalCharges", "tenure"} <= have:
        terms["avg_charge_per_tenure"] = F.col("TotalCharges").cast("double") / F.when(tenure == 0, 1.0).otherwise(tenure)
    return df.withColumns(terms) if terms else df


def column_kinds(df: DataFrame, exclude: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """(numeric, categorical) column names; anything not numeric is categorical."""
    fields = [f for f in df.schema if f.name not in exclude]
    numeric = [f.name for f in fields if isinstance(f.dataType, T.NumericType)]
    return numeric, [f.name for f in fields if f.name not in numeric]


def detect_columns(columns: Sequence[str]) -> tuple[str | None, str | None]:
    """First known treatment and outcome name present."""
    first = lambda names: next((n for n in names if n in columns), None)
    return first(TREATMENT_NAMES), first(OUTCOME_NAMES)


def _long(df: DataFrame, columns: Sequence[str], kind: str) -> DataFrame:
    parts = ", ".join(f"'{c}', cast(`{c}` as {kind})" for c in columns)
    return df.select(F.expr(f"stack({len(columns)}, {parts}) as (column, value)"))


def fit_numeric(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, median, mean, deviation) of the training rows: exact median, then mean and population
    deviation of the imputed values. All columns are worked out together."""
    rows = _long(train, columns, "double")
    medians = exact_quantiles(rows, "value", [0.5], ["column"]).select("column", F.col("quantile").alias("median"))
    filled = rows.join(F.broadcast(medians), "column").withColumn("value", F.coalesce("value", "median"))  # one row per column
    return filled.groupBy("column").agg(
        F.max("median").alias("median"), F.avg("value").alias("mean"), F.stddev_pop("value").alias("deviation")
    )


def apply_numeric(df: DataFrame, stats: DataFrame) -> DataFrame:
    """Imputes and standardises the fitted columns in place; a constant column only loses its mean."""
    scaled = {}
    for r in stats.collect():  # one row per column
        scale = r["deviation"] if r["deviation"] else 1.0
        scaled[r["column"]] = (F.coalesce(F.col(r["column"]).cast("double"), F.lit(r["median"])) - r["mean"]) / scale
    return df.withColumns(scaled)


def number_categories(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n, place, size) of the training rows: the sorted levels of each column, numbered from 0.

    Any number of levels; the numbers come from an ordered scan, not from a window over a column.
    """
    counts = _long(train, columns, "string").where("value is not null").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    numbered = scan.running(counts, ["column"], [F.col("value")], {"_k": F.lit(1).cast("long")}, totals=True)
    return numbered.select("column", "value", "n", (F.col("_k") - 1).alias("place"), F.col("_k_all").alias("size"))


def fit_categories(train: DataFrame, columns: Sequence[str], max_categories: int = MAX_CATEGORIES) -> DataFrame:
    """(column, categories sorted, most_frequent) of the training rows; ties take the smaller value.

    ``categories`` is null for a column of more than ``max_categories`` levels: ``sparse_dummies`` encodes those.
    """
    counts = _long(train, columns, "string").where("value is not null").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    sizes = counts.groupBy("column").agg(F.count(F.lit(1)).alias("k"), F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("most_frequent"))
    narrow = counts.join(F.broadcast(sizes.where(F.col("k") <= max_categories).select("column")), "column")  # one row per column
    listed = narrow.groupBy("column").agg(F.sort_array(F.collect_list("value")).alias("categories"))
    return sizes.join(listed, "column", "left").select("column", "categories", "most_frequent")


def apply_categories(df: DataFrame, vocabulary: DataFrame, impute: bool = True) -> tuple[DataFrame, list[str]]:
    """0/1 column per category but the first. Unknown values give zeros; so do nulls unless imputed. Columns without listed categories are left."""
    columns = {}
    for r in sorted(vocabulary.where("categories is not null").collect(), key=lambda r: r["column"]):  # one row per column
        value = F.col(r["column"]).cast("string")
        if impute:
            value = F.coalesce(value, F.lit(r["most_frequent"]))
        for category in r["categories"][1:]:
            columns[f"{r['column']}_{category}"] = F.coalesce(value == category, F.lit(False)).cast("double")
    return df.withColumns(columns), list(columns)


def sparse_dummies(df: DataFrame, numbered: DataFrame, columns: Sequence[str], impute: bool = True) -> tuple[DataFrame, list[str]]:
    """One sparse vector column ``<column>_levels`` for each of ``columns``: a 1 at the place of the level, counted from 1 as the first is left out.

    The places come by a join with ``number_categories``, so the levels pass no driver. Unknown values give zeros; so do nulls
    unless imputed by the most frequent level. The level at place k stands at position size - 1 - k.
    """
    facts = numbered.groupBy("column").agg(F.max("size").alias("size"), F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("common"))
    sizes = {r["column"]: r for r in facts.collect()}  # one row per column
    names = []
    for c in columns:
        levels = numbered.where(F.col("column") == c).select(F.col("value").alias("_value"), F.col("place").alias("_place"))
        size, value = int(sizes[c]["size"]), F.col(c).cast("string")
        value = F.coalesce(value, F.lit(sizes[c]["common"])) if impute else value
        # the encoder leaves out the last place: that of the first level, of unknown values and of nulls
        meta = {"ml_attr": {"type": "nominal", "num_vals": max(size, 2), "name": c}}
        last = max(size, 2) - 1
        place = F.coalesce(F.lit(last) - F.col("_place"), F.lit(last)).cast("double")
        df = df.withColumn("_value", value).join(levels, "_value", "left").withColumn("_index", place.alias("_index", metadata=meta)).drop("_value", "_place")
        name = f"{c}_levels"
        encoder = OneHotEncoder(inputCols=["_index"], outputCols=[name], dropLast=True)
        df = encoder.fit(df).transform(df).drop("_index")
        names.append(name)
    return df, names


def design_matrix(train: DataFrame, apply_to: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """``apply_to`` with scaled numeric and dummy columns fitted on ``train``, and the feature names.

    Columns of more than ``MAX_CATEGORIES`` levels become one sparse vector column each.
    """
    encoded, dummies = apply_to, []
    if categorical:
        fitted = fit_categories(train, categorical)
        encoded, dummies = apply_categories(apply_to, fitted)
        wide = sorted(r["column"] for r in fitted.where("categories is null").select("column").collect())  # one row per column
        if wide:
            encoded, more = sparse_dummies(encoded, number_categories(train, wide), wide)
            dummies = [*dummies, *more]
    scaled = apply_numeric(encoded, fit_numeric(train, numeric)) if numeric else encoded
    return scaled, [*numeric, *dummies]
