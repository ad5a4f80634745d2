"""Marketing mix: daily tables, adstock, regression, contribution, budget and KPI tables.

Raw spend rows are summed per day first (partial aggregation), so everything after that has one row per
day and series and its windows are bounded by the calendar.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adweave.functions.scalar import lookup, normalize_channel, safe_ratio

CHANNELS = ("search", "social", "display", "email")
# Carry-over per channel, order value behind conversions, budget share and channel floor.
ALPHAS = {"search": 0.65, "social": 0.55, "display": 0.45, "email": 0.30}
ORDER_VALUE = 120.0
BUDGET_SHARE = 0.90
FLOOR_SHARE = 0.05
TRAIN_SHARE = 0.8
REMAINDER = 1e-18


def _named(df: DataFrame, name: str) -> str | None:
    return next((c for c in df.columns if c.strip().lower() == name), None)


def _require(df: DataFrame, name: str) -> str:
    found = _named(df, name)
    if found is None:
        raise ValueError(f"input needs a `{name}` column, found {df.columns}")
    return found


def _numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c).try_cast("double"), F.lit(0.0)) for c in columns})


def load_mix_wide(df: DataFrame) -> DataFrame:
    """Sums revenue and the four spend columns per date; date and revenue are found in any letter case."""
    date, revenue = _require(df, "date"), _require(df, "revenue")
    spends = [f"spend_{c}" for c in CHANNELS]
    typed = df.select(F.to_date(F.col(date)).alias("date"), F.col(revenue).alias("revenue"), *spends)
    typed = _numbers(typed, ["revenue", *spends])
    return typed.groupBy("date").agg(*[F.sum(c).alias(c) for c in ["revenue", *spends]])


def load_mix_long(df: DataFrame) -> DataFrame:
    """(date, channel, spend, revenue or conversions) → the wide daily table.

    Channel text is normalised; a missing channel is 0. Without revenue, conversions times the order value
    stand in for it. Unknown channels count for revenue but have no spend column.
    """
    date, channel, spend = (_require(df, c) for c in ("date", "channel", "spend"))
    revenue, conversions = _named(df, "revenue"), _named(df, "conversions")
    if revenue is None and conversions is None:
        raise ValueError("need either `revenue` or `conversions`")
    value = F.col(revenue).try_cast("double") if revenue else F.col(conversions).try_cast("double") * ORDER_VALUE
    rows = df.select(
        F.to_date(F.col(date)).alias("date"),
        normalize_channel(F.col(channel)).alias("channel"),
        F.col(spend).try_cast("double").alias("spend"),
        value.alias("value"),
    )
    by_channel = lambda c: F.coalesce(F.sum(F.when(F.col("channel") == c, F.col("spend"))), F.lit(0.0))
    return rows.groupBy("date").agg(
        F.coalesce(F.sum("value"), F.lit(0.0)).alias("revenue"), *[by_channel(c).alias(f"spend_{c}") for c in CHANNELS]
    )


def _series(by: Sequence[str]) -> Window:
    return Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))


def calendar_features(daily: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Adds ``day_idx``, the 0-based row number by date, and ``dow`` with Monday = 0."""
    return daily.withColumn("day_idx", F.row_number().over(_series(by).orderBy("date")) - 1).withColumn("dow", F.weekday("date"))


def adstock(value: str, alpha: float, by: Sequence[str] = (), order: str = "date") -> Column:
    """out[i] = x[i] + alpha·out[i-1] over the rows of a series.

    The frame ends where alpha^k drops under 1e-18, so it holds at most about 100 rows for the usual rates.
    """
    if alpha <= 0:
        return F.col(value).cast("double")
    reach = math.ceil(math.log(REMAINDER) / math.log(alpha))
    frame = _series(by).orderBy(order).rowsBetween(-reach, Window.currentRow)
    recent = F.collect_list(F.coalesce(F.col(value).cast("double"), F.lit(0.0))).over(frame)
    return F.aggregate(recent, F.lit(0.0), lambda total, x: total * F.lit(alpha) + x)


def with_adstock(daily: DataFrame, alphas: Mapping[str, float] = ALPHAS, by: Sequence[str] = ()) -> DataFrame:
    return daily.withColumns({f"ad_{c}": adstock(f"spend_{c}", a, by) for c, a in alphas.items()})


def prepare(daily: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Daily table with calendar and adstock columns."""
    return with_adstock(calendar_features(daily, by), by=by)


def chronological_split(daily: DataFrame, share: float = TRAIN_SHARE, by: Sequence[str] = ()) -> DataFrame:
    """Adds ``is_train`` for the first int(share·n) rows by date."""
    n = F.count(F.lit(1)).over(_series(by))
    return daily.withColumn("is_train", F.row_number().over(_series(by).orderBy("date")) <= F.floor(F.lit(share) * n))


def regression_features() -> list[str]:
    return [*[f"ad_{c}" for c in CHANNELS], "day_idx"]


def _fit(train: DataFrame, columns: Sequence[str], target: str) -> LinearRegressionModel:
    rows = VectorAssembler(inputCols=list(columns), outputCol="features").transform(train)
    return LinearRegression(featuresCol="features", labelCol=target, solver="normal", regParam=0.0).fit(rows)


def regression_quality(scored: DataFrame, target: str = "revenue") -> DataFrame:
    """R² and mean absolute error of ``prediction``."""
    y, p = F.col(target), F.col("prediction")
    sums = scored.agg(F.sum((y - p) * (y - p)).alias("rss"), (F.var_pop(y) * F.count(y)).alias("tss"), F.avg(F.abs(y - p)).alias("mae"))
    return sums.select((1 - F.col("rss") / F.nullif(F.col("tss"), F.lit(0.0))).alias("r2"), "mae")


def fit_regression(prepared: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Least squares of revenue on four adstocks and the day index.

    Returns coefficients (feature, coefficient) sorted descending, and test-period R² and MAE.
    """
    split = chronological_split(prepared)
    columns = regression_features()
    model = _fit(split.where("is_train"), columns, "revenue")
    test = VectorAssembler(inputCols=columns, outputCol="features").transform(split.where("not is_train"))
    rows = list(zip(columns, [float(c) for c in model.coefficients]))
    table = prepared.sparkSession.createDataFrame(rows, "feature string, coefficient double").orderBy(F.desc("coefficient"))
    return table, regression_quality(model.transform(test))


def channel_contribution(prepared: DataFrame, coefficients: Mapping[str, float]) -> DataFrame:
    """(channel, estimated_contribution, total_spend, estimated_roi) over all rows; no spend → null ROI."""
    parts = ", ".join(f"'{c}', ad_{c} * {float(coefficients[f'ad_{c}'])!r}D, spend_{c}" for c in CHANNELS)
    rows = prepared.select(F.expr(f"stack({len(CHANNELS)}, {parts}) as (channel, contribution, spend)"))
    table = rows.groupBy("channel").agg(F.sum("contribution").alias("estimated_contribution"), F.sum("spend").alias("total_spend"))
    roi = F.when(F.col("total_spend") > 0, F.col("estimated_contribution") / F.col("total_spend"))
    return table.withColumn("estimated_roi", roi)


def roi_ranking(contribution: DataFrame) -> DataFrame:
    """Dense rank of ROI, highest first."""
    order = Window.partitionBy(F.lit(0)).orderBy(F.desc("estimated_roi"))
    return contribution.where(F.col("estimated_roi").isNotNull()).select("channel", "estimated_roi", F.dense_rank().over(order).alias("rank"))


def allocate_budget(
    contribution: DataFrame, uplift: Mapping[str, float] | None = None, share: float = BUDGET_SHARE, floor: float = FLOOR_SHARE
) -> DataFrame:
    """Splits ``share`` of the current budget: a floor per channel, the rest by positive effective ROI.

    With no positive score the rest is split equally.
    """
    everyone = Window.partitionBy(F.lit(0))  # one row per channel
    table = contribution.withColumn("uplift_multiplier", lookup("channel", uplift or {}, 1.0))
    table = table.withColumn("effective_roi", F.col("estimated_roi") * F.col("uplift_multiplier"))
    score = F.greatest(F.col("effective_roi"), F.lit(0.0))
    table = table.withColumn("_score", F.when(F.col("effective_roi").isNotNull(), score))
    floors = F.col("total_spend") * floor
    rest = F.greatest(F.sum("total_spend").over(everyone) * share - F.sum(floors).over(everyone), F.lit(0.0))
    all_scores = F.coalesce(F.sum("_score").over(everyone), F.lit(0.0))
    variable = F.when(all_scores > 0, rest * F.col("_score") / F.nullif(all_scores, F.lit(0.0))).otherwise(
        rest / F.count(F.lit(1)).over(everyone)
    )
    table = table.withColumn("recommended_spend", floors + variable)
    return table.select(
        "channel", "total_spend", "recommended_spend",
        (F.col("recommended_spend") - F.col("total_spend")).alias("budget_shift"),
        "estimated_roi", "uplift_multiplier", "effective_roi",
        (F.col("recommended_spend") * F.col("effective_roi")).alias("expected_incremental_return"),
    )


def kpi_table(contribution: DataFrame, allocation: DataFrame | None = None, order_value: float = ORDER_VALUE) -> DataFrame:
    """ROAS, ROI, conversion and CPA proxies per channel; a zero denominator gives null."""
    revenue, spend = F.col("attributed_revenue_proxy"), F.col("total_spend")
    table = contribution.withColumnRenamed("estimated_contribution", "attributed_revenue_proxy").withColumns(
        {
            "roas": safe_ratio(revenue, spend),
            "roi": safe_ratio(revenue - spend, spend),
            "estimated_conversions_proxy": revenue / order_value,
            "cpa_proxy": safe_ratio(spend, revenue / order_value),
        }
    )
    if allocation is None:
        return table
    extra = allocation.select("channel", "recommended_spend", "budget_shift", "expected_incremental_return")
    return table.join(extra, "channel", "left")


def seasonal_forecast(prepared: DataFrame, season: int = 7) -> tuple[DataFrame, DataFrame]:
    """One-step-ahead forecast from lag 1, lag ``season`` and the adstocks by least squares.

    This stands in for the reference's seasonal state-space model; it is a different estimator, so its
    numbers are not comparable. Returns the scored test rows and their R² and MAE.
    """
    order = Window.partitionBy(F.lit(0)).orderBy("date")
    lagged = prepared.withColumns({"lag_1": F.lag("revenue", 1).over(order), "lag_season": F.lag("revenue", season).over(order)})
    split = chronological_split(lagged).where(F.col("lag_season").isNotNull())
    columns = ["lag_1", "lag_season", *[f"ad_{c}" for c in CHANNELS]]
    model = _fit(split.where("is_train"), columns, "revenue")
    test = VectorAssembler(inputCols=columns, outputCol="features").transform(split.where("not is_train"))
    scored = model.transform(test).select("date", "revenue", "prediction")
    return scored, regression_quality(scored)


def date_summary(daily: DataFrame) -> DataFrame:
    return daily.agg(F.count(F.lit(1)).alias("rows"), F.min("date").cast("string").alias("date_min"), F.max("date").cast("string").alias("date_max"))
