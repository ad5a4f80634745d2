"""Data quality: log halves, drift report and batch profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adweave.operators.features import _long
from adweave.operators.ordered import exact_quantiles, positional_rank, quantiles_of_counts, running_totals
from adweave.session import cut_lineage

# Columns compared between the halves of a scored log, and the fewest rows for it.
LOG_COLUMNS = ["SeniorCitizen", "tenure", "MonthlyCharges", "TotalCharges", "churn_probability"]
MIN_LOG_ROWS = 6
DRIFT_LIMIT = 0.1
PSI_BINS = 10
FLOOR = 1e-6


def split_log(log: DataFrame, time: str = "timestamp_utc", key: str = "key", columns: Sequence[str] = tuple(LOG_COLUMNS)) -> DataFrame:
    """Adds ``part``: the first n div 2 rows by (time, key) are 'reference', the others 'current'.

    Needs at least six rows and one of the numeric columns; only those, the key and the part are kept.
    """
    present = [c for c in columns if c in log.columns]
    if not present:
        raise ValueError("no numeric columns available for a drift report")
    if log.limit(MIN_LOG_ROWS).count() < MIN_LOG_ROWS:
        raise ValueError(f"need at least {MIN_LOG_ROWS} scored rows before a drift report")
    timed = log.withColumn("_t", F.col(time).cast("timestamp").cast("double"))
    ranked = positional_rank(timed, "_t", key, descending=False)
    part = F.when(F.col("rank") <= F.floor(F.col("rank_all") / 2), "reference").otherwise("current")
    return ranked.select(key, *present, part.alias("part"))


def _counts(df: DataFrame, columns: Sequence[str], kind: str) -> DataFrame:
    parts = ", ".join(f"'{c}', cast(`{c}` as {kind})" for c in columns)
    rows = df.select("part", F.expr(f"stack({len(columns)}, {parts}) as (column, value)")).where("value is not null")
    of = lambda p: F.count_if(F.col("part") == p)
    return rows.groupBy("column", "value").agg(of("reference").alias("r"), of("current").alias("c"))


def _divergences(table: DataFrame) -> DataFrame:
    """PSI and Jensen-Shannon distance (base 2) per column from counts r and c of its cells."""
    totals = table.groupBy("column").agg(F.sum("r").alias("nr"), F.sum("c").alias("nc"))
    shares = table.join(totals, "column").select(
        "column",
        (F.col("r") / F.col("nr")).alias("p"),
        (F.col("c") / F.col("nc")).alias("q"),
    )
    p, q = F.col("p"), F.col("q")
    pf, qf = F.greatest(p, F.lit(FLOOR)), F.greatest(q, F.lit(FLOOR))
    m = (p + q) / 2
    half = lambda x: F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)
    return shares.groupBy("column").agg(
        F.sum((pf - qf) * F.ln(pf / qf)).alias("psi"),
        F.sqrt(F.greatest(F.sum((half(p) + half(q)) / 2), F.lit(0.0))).alias("js_distance"),
    )


def numeric_drift(df: DataFrame, columns: Sequence[str], bins: int = PSI_BINS) -> DataFrame:
    """KS statistic, Wasserstein distance over the reference deviation, PSI and Jensen-Shannon per column.

    ``part`` is reference or current. Equal values are counted first and ordered once; both distribution functions, the
    reference's quantiles for the PSI bins and its deviation all come from these counts.
    """
    counts = _counts(df, columns, "double")
    cum = cut_lineage(
        running_totals(counts, "value", None, {"cr": F.col("r"), "cc": F.col("c"), "vr": F.col("r") * F.col("value")}, ["column"], descending=False, next_score="_to")
    )
    gap = F.abs(F.col("cr") / F.col("cr_all") - F.col("cc") / F.col("cc_all"))
    off = F.col("value") - F.col("vr_all") / F.col("cr_all")
    distances = cum.groupBy("column").agg(
        F.max(gap).alias("ks"), F.sum(gap * (F.coalesce("_to", "value") - F.col("value"))).alias("w1"), F.sqrt(F.sum(F.col("r") * off * off) / F.max("cr_all")).alias("sd")
    )
    edges = quantiles_of_counts(cum.where("r > 0"), "column", "value", "r", "cr", "cr_all", [i / bins for i in range(1, bins)])
    edges = edges.groupBy("column").agg(F.sort_array(F.collect_list("quantile")).alias("_e"))  # one short array per column
    binned = (
        cum.join(F.broadcast(edges), "column")
        .groupBy("column", F.size(F.filter("_e", lambda e: e < F.col("value"))).alias("value"))
        .agg(F.sum("r").alias("r"), F.sum("c").alias("c"))
    )
    return distances.join(_divergences(binned), "column").select(
        "column", "ks", (F.col("w1") / F.nullif(F.col("sd"), F.lit(0.0))).alias("wasserstein_norm"), "psi", "js_distance"
    )


def categorical_drift(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Chi-square statistic with its degrees of freedom, PSI and Jensen-Shannon per column."""
    counts = _counts(df, columns, "string")
    totals = counts.groupBy("column").agg(F.sum("r").alias("nr"), F.sum("c").alias("nc"), F.count(F.lit(1)).alias("k"))
    n = F.col("nr") + F.col("nc")
    cell = F.col("r") + F.col("c")
    off = lambda seen, side: F.pow(F.col(seen) - cell * F.col(side) / n, F.lit(2)) / (cell * F.col(side) / n)
    chi = counts.join(totals, "column").groupBy("column").agg(
        F.sum(off("r", "nr") + off("c", "nc")).alias("chi_square"), (F.max("k") - 1).alias("degrees")
    )
    return chi.join(_divergences(counts), "column").select("column", "chi_square", "degrees", "psi", "js_distance")


def drift_report(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = (), limit: float = DRIFT_LIMIT) -> DataFrame:
    """One row per column with its deciding score, a drift flag and the share of drifted columns.

    Numeric columns are judged by the normalised Wasserstein distance, categorical ones by the
    Jensen-Shannon distance; the limit is ours.
    """
    from pyspark.sql import Window

    parts = []
    if numeric:
        parts.append(numeric_drift(df, numeric).select("column", F.lit("numeric").alias("kind"), F.col("wasserstein_norm").alias("score")))
    if categorical:
        parts.append(categorical_drift(df, categorical).select("column", F.lit("categorical").alias("kind"), F.col("js_distance").alias("score")))
    table = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    flagged = table.withColumn("drifted", F.col("score") >= limit)
    return flagged.withColumn("drifted_share", F.avg(F.col("drifted").cast("double")).over(Window.partitionBy(F.lit(0))))


def profile_exact(df: DataFrame, numeric: Sequence[str], probs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Count, nulls, min, max, mean, sample deviation and exact quantiles per numeric column."""
    rows = _long(df, numeric, "double")
    basics = rows.groupBy("column").agg(
        F.count(F.lit(1)).alias("count"),
        F.count_if(F.col("value").isNull()).alias("nulls"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
    )
    quantiles = exact_quantiles(rows, "value", probs, ["column"]).groupBy("column").agg(
        *[F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(f"q{round(p * 100)}") for p in probs]
    )
    return basics.join(quantiles, "column")


def profile_sketch(df: DataFrame, columns: Sequence[str] | None = None, top: int = 5) -> DataFrame:
    """One-pass profile of any columns: exact counts, approximate distinct count, quantiles and top items."""
    rows = _long(df, list(columns or df.columns), "string")
    number = F.col("value").try_cast("double")
    return rows.groupBy("column").agg(
        F.count(F.lit(1)).alias("count"),
        F.count_if(F.col("value").isNull()).alias("nulls"),
        F.approx_count_distinct("value").alias("distinct_estimate"),
        F.percentile_approx(number, [0.05, 0.25, 0.5, 0.75, 0.95], 10_000).alias("quantile_estimates"),
        F.expr(f"approx_top_k(value, {top})").alias("frequent_items"),
    )
