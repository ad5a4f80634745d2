"""Ranking, probability and decision metrics. Input rows are (model, label 0/1, p[, key]).

Every operator evaluates all models together. Ranking metrics first count positives and negatives per
distinct score, so the ordered step handles each score once.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adweave.operators.ordered import exact_quantiles, positional_rank, running_totals

# Scan start, step and count of the profit threshold scan.
SCAN = [0.1 + i * 0.05 for i in range(17)]
# Machine epsilon of double and single precision scores.
EPS_DOUBLE = float(np.finfo(np.float64).eps)
EPS_SINGLE = float(np.finfo(np.float32).eps)


def _cumulative(scored: DataFrame, by: Sequence[str]) -> DataFrame:
    pos = F.sum(F.col("label").cast("long"))
    per_score = scored.groupBy(*by, "p").agg(pos.alias("pos"), (F.count(F.lit(1)) - pos).alias("neg"))
    return running_totals(per_score, "p", None, {"tp": F.col("pos"), "fp": F.col("neg")}, by)


def ranking_metrics(scored: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """ROC-AUC (ties count half) and PR-AUC as average precision, per model."""
    cum = _cumulative(scored, by)
    # a positive at this score beats every negative below it and half of those level with it
    beaten = F.col("pos") * (F.col("fp_all") - F.col("fp") + F.col("neg") / 2.0)
    precision = F.col("tp") / (F.col("tp") + F.col("fp"))
    return cum.groupBy(*by).agg(
        (F.sum(beaten) / F.nullif(F.max("tp_all") * F.max("fp_all").cast("double"), F.lit(0.0))).alias("roc_auc"),
        F.sum(F.col("pos") / F.nullif(F.col("tp_all"), F.lit(0)) * precision).alias("pr_auc"),
    )


def log_loss_expr(label: Column, p: Column, eps: float = EPS_DOUBLE) -> Column:
    q = F.least(F.greatest(p, F.lit(eps)), F.lit(1 - eps))
    return -(label * F.ln(q) + (1 - label) * F.ln(1 - q))


def loss_metrics(scored: DataFrame, by: Sequence[str] = ("model",), eps: float = EPS_DOUBLE) -> DataFrame:
    """Log loss (clipped) and Brier score per model."""
    label, p = F.col("label"), F.col("p")
    return scored.groupBy(*by).agg(
        F.avg(log_loss_expr(label, p, eps)).alias("log_loss"), F.avg(F.pow(p - label, F.lit(2.0))).alias("brier")
    )


def expected_calibration_error(
    scored: DataFrame, bins: int = 15, by: Sequence[str] = ("model",), include_one: bool = False
) -> DataFrame:
    """ECE over equal bins [a, b). p = 1.0 is in no bin but counts in n, unless ``include_one``."""
    edges = [float(e) for e in np.linspace(0, 1, bins + 1)]
    p = F.col("p")
    slot = F.lit(-1)
    for e in edges[:-1]:
        slot = slot + (p >= e).cast("int")
    slot = F.when(p < edges[-1], slot).when((p == 1.0) & F.lit(include_one), F.lit(bins - 1)).otherwise(F.lit(-1))
    table = scored.withColumn("_bin", slot).groupBy(*by, "_bin").agg(
        F.count(F.lit(1)).alias("n"), F.avg("p").alias("conf"), F.avg("label").alias("acc")
    )
    gap = F.when(F.col("_bin") >= 0, F.col("n") * F.abs(F.col("acc") - F.col("conf"))).otherwise(0.0)
    return table.groupBy(*by).agg((F.sum(gap) / F.sum("n")).alias("ece"))


def comparison_table(scored: DataFrame, by: Sequence[str] = ("model",), eps: float = EPS_DOUBLE) -> DataFrame:
    """log_loss, brier, roc_auc, pr_auc and ece per model; ``selected`` marks the lowest log loss."""
    table = (
        loss_metrics(scored, by, eps)
        .join(ranking_metrics(scored, by), list(by))
        .join(expected_calibration_error(scored, by=by), list(by))
    )  # one row per model from here on
    best = Window.partitionBy(F.lit(0)).orderBy("log_loss", *by)
    return table.withColumn("selected", F.row_number().over(best) == 1)


def reliability_curve(scored: DataFrame, bins: int = 12, by: Sequence[str] = ("model",)) -> DataFrame:
    """Quantile-bin reliability: mean p and observed rate per non-empty bin.

    Edges are linear-interpolated percentiles; a row's bin is the number of inner edges below its p.
    """
    by = list(by)
    probs = [i / bins for i in range(1, bins)]
    edges = exact_quantiles(scored, "p", probs, by).groupBy(*by).agg(F.sort_array(F.collect_list("quantile")).alias("_e"))
    edges = edges.select(*by, "_e")  # one short array per model
    below = F.size(F.filter(F.col("_e"), lambda e: e < F.col("p")))
    return (
        scored.join(F.broadcast(edges), by)
        .groupBy(*by, below.alias("bin"))
        .agg(F.avg("p").alias("mean_predicted"), F.avg("label").alias("fraction_positive"), F.count(F.lit(1)).alias("n"))
    )


def confusion(scored: DataFrame, threshold: float, by: Sequence[str] = ("model",), strict: bool = True) -> DataFrame:
    """tp, fp, fn, tn at ``p > threshold`` (``strict``) or ``p ≥ threshold``."""
    hit = F.col("p") > threshold if strict else F.col("p") >= threshold
    pos = F.col("label") == 1
    return scored.groupBy(*by).agg(
        F.count_if(hit & pos).alias("tp"),
        F.count_if(hit & ~pos).alias("fp"),
        F.count_if(~hit & pos).alias("fn"),
        F.count_if(~hit & ~pos).alias("tn"),
    )


def classification_report(counts: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """Per-class precision, recall, F1 and support, plus accuracy, macro and weighted averages."""
    by = list(by)
    zero = lambda a, b: F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0))
    sides = counts.select(
        *by,
        F.expr("stack(2, '1', tp, fp, fn, tn, '0', tn, fn, fp, tp) as (class, hit, wrong, missed, rest)"),
    )
    hit, wrong, missed = F.col("hit"), F.col("wrong"), F.col("missed")
    classes = sides.select(
        *by,
        "class",
        zero(hit, hit + wrong).alias("precision"),
        zero(hit, hit + missed).alias("recall"),
        zero(2 * hit, 2 * hit + wrong + missed).alias("f1"),
        (hit + missed).alias("support"),
        "hit",
    )
    all_n = F.sum("support")
    names = ("precision", "recall", "f1")
    summary = classes.groupBy(*by).agg(
        all_n.alias("n"),
        (F.sum("hit") / all_n).alias("acc"),
        *[F.avg(c).alias(f"m_{c}") for c in names],
        *[(F.sum(F.col(c) * F.col("support")) / all_n).alias(f"w_{c}") for c in names],
    )
    averages = summary.select(
        *by,
        F.expr(
            "stack(3, 'accuracy', acc, acc, acc, n, 'macro avg', m_precision, m_recall, m_f1, n, "
            "'weighted avg', w_precision, w_recall, w_f1, n) as (class, precision, recall, f1, support)"
        ),
    )
    return classes.drop("hit").unionByName(averages)


def profit_expr(tp: float = 100, tn: float = 0, fp: float = -10, fn: float = -100) -> Column:
    return F.col("tp") * tp + F.col("tn") * tn + F.col("fp") * fp + F.col("fn") * fn


def threshold_scan(
    scored: DataFrame, thresholds: Sequence[float] = tuple(SCAN), by: Sequence[str] = ("model",), **value
) -> DataFrame:
    """Confusion counts and profit at every threshold from one pass.

    A row passes the first k thresholds, so rows are counted per k and summed from the top down. ``best``
    marks the highest profit; ties go to the lowest threshold. Thresholds are reported to 2 places.
    """
    by = list(by)
    passed = F.lit(0)
    for t in thresholds:
        passed = passed + (F.col("p") > F.lit(float(t))).cast("int")
    pos = F.sum(F.col("label").cast("long"))
    slots = scored.groupBy(*by, passed.alias("passed")).agg(pos.alias("pos"), (F.count(F.lit(1)) - pos).alias("neg"))
    # at most 18 rows per model from here on
    grid = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(round(float(t), 2)).alias("threshold")) for i, t in enumerate(thresholds)])
    cells = slots.withColumn("_c", F.explode(grid))
    over = F.col("passed") > F.col("_c.i")
    counts = cells.groupBy(*by, F.col("_c.threshold").alias("threshold")).agg(
        F.sum(F.when(over, F.col("pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(over, F.col("neg")).otherwise(0)).alias("fp"),
        F.sum(F.when(over, 0).otherwise(F.col("pos"))).alias("fn"),
        F.sum(F.when(over, 0).otherwise(F.col("neg"))).alias("tn"),
    )
    best = Window.partitionBy(*by).orderBy(F.desc("profit"), "threshold")
    return counts.withColumn("profit", profit_expr(**value)).withColumn("best", F.row_number().over(best) == 1)


def top_fraction_capture(scored: DataFrame, key: str, fraction: float = 0.20, by: Sequence[str] = ("model",)) -> DataFrame:
    """Positives captured by the top ``max(1, int(fraction·n))`` rows by score; ties by key."""
    ranked = positional_rank(scored, "p", key, by)
    size = F.greatest(F.lit(1), F.floor(F.lit(fraction) * F.col("rank_all")))
    inside = F.col("rank") <= size
    table = ranked.groupBy(*by).agg(
        F.max(size).alias("top_segment_size"),
        F.sum("label").cast("long").alias("total_positives"),
        F.sum(F.when(inside, F.col("label")).otherwise(0)).cast("long").alias("captured_positives"),
    )
    rate = F.coalesce(F.col("captured_positives") / F.nullif(F.col("total_positives"), F.lit(0)), F.lit(0.0))
    return table.withColumn("capture_rate", rate)


def bidding_report(scored: DataFrame, value_per_click: float = 2.0, cost_per_impression: float = 0.01, by: Sequence[str] = ("model",)) -> DataFrame:
    """Buy when p·value > cost: volume, realised click rate, revenue, cost and profit per model."""
    buy = F.col("p") * value_per_click > cost_per_impression
    table = scored.groupBy(*by).agg(
        F.count_if(buy).alias("impressions_bought"),
        F.sum(F.when(buy, F.col("label")).otherwise(0)).alias("_clicks"),
        F.count(F.lit(1)).alias("_n"),
    )
    bought, clicks = F.col("impressions_bought"), F.col("_clicks")
    return table.select(
        *by,
        "impressions_bought",
        (bought / F.col("_n")).alias("buy_rate"),
        F.coalesce(clicks / F.nullif(bought, F.lit(0)), F.lit(0.0)).alias("realized_ctr"),
        (clicks * value_per_click).alias("revenue"),
        (bought * cost_per_impression).alias("cost"),
        (clicks * value_per_click - bought * cost_per_impression).alias("profit"),
    )


def scoring_checks(scored: DataFrame, expected_rows: int | None = None, labels: Sequence[str] | None = None, threshold: float | None = None) -> DataFrame:
    """(check, violations): probability range, binary labels, row count, allowed model names, decisions.

    ``prediction``, if present, must equal ``p > threshold``.
    """
    checks = {
        "probability_out_of_range": F.count_if(F.col("p").isNull() | (F.col("p") < 0) | (F.col("p") > 1)),
        "label_not_binary": F.count_if(F.col("label").isNull() | ~F.col("label").isin(0, 1)),
    }
    if expected_rows is not None:
        checks["row_count_difference"] = F.abs(F.count(F.lit(1)) - F.lit(expected_rows))
    if labels is not None:
        checks["unknown_model"] = F.count_if(~F.col("model").isin(*labels))
    if threshold is not None and "prediction" in scored.columns:
        checks["prediction_not_from_threshold"] = F.count_if(F.col("prediction") != (F.col("p") > threshold).cast("int"))
    wide = scored.agg(*[e.cast("long").alias(n) for n, e in checks.items()])
    pairs = ", ".join(f"'{n}', {n}" for n in checks)
    return wide.select(F.expr(f"stack({len(checks)}, {pairs}) as (check, violations)"))


# Multipliers of a 32-bit finaliser.
MIX = (0x85EBCA6B, 0xC2B2AE35)
# How many of 65,536 equally likely values give 0, at most 1, at most 2, … events of a Poisson variable with mean 1.
POISSON_STEPS = [round(65_536 * math.exp(-1.0) * sum(1 / math.factorial(j) for j in range(k + 1))) for k in range(8)]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint32(16))) * np.uint32(MIX[0])
    x = (x ^ (x >> np.uint32(13))) * np.uint32(MIX[1])
    return x ^ (x >> np.uint32(16))


def paired_bootstrap(paired: DataFrame, replicates: int = 2000, seed: int = 42) -> DataFrame:
    """Bootstrap of loss differences between two scores of the same rows.

    Input (key long, label, p_base, p_new). Each task gives its rows Poisson(1) weights that depend only on
    (row key, replicate) and emits one partial sum per replicate, so the shuffle carries replicates, not
    rows, and a re-run task repeats its numbers. A 32-bit hash gives two replicates, 16 bits each. Result: metric,
    median_delta, ci95_low, ci95_high, significant_improvement (lower bound above 0).
    """
    label = F.col("label").cast("double")
    delta = paired.select(
        F.col("key").cast("long").alias("key"),
        (log_loss_expr(label, F.col("p_base")) - log_loss_expr(label, F.col("p_new"))).alias("d_ll"),
        (F.pow(F.col("p_base") - label, F.lit(2.0)) - F.pow(F.col("p_new") - label, F.lit(2.0))).alias("d_br"),
    )
    events = np.searchsorted(np.asarray(POISSON_STEPS), np.arange(65_536), side="right").astype(np.float32)
    pairs = -(-replicates // 2)
    salts = _mixed(np.arange(pairs, dtype=np.uint32) + np.uint32(seed % 2**32))

    def partial(batches):
        sums = np.zeros((3, 2 * pairs))
        for frame in batches:
            key = frame["key"].to_numpy().astype(np.uint64)
            low, high = key.astype(np.uint32), (key >> np.uint64(32)).astype(np.uint32)
            values = np.stack([np.ones(len(frame)), frame["d_ll"].to_numpy(), frame["d_br"].to_numpy()])
            for start in range(0, len(frame), 512):
                part = slice(start, start + 512)
                bits = _mixed(_mixed(low[part, None] ^ salts) ^ high[part, None])
                sums[:, :pairs] += values[:, part] @ events[bits & np.uint32(0xFFFF)]
                sums[:, pairs:] += values[:, part] @ events[bits >> np.uint32(16)]
        yield pd.DataFrame({"replicate": np.arange(replicates), "w": sums[0, :replicates], "ll": sums[1, :replicates], "br": sums[2, :replicates]})

    parts = delta.mapInPandas(partial, "replicate int, w double, ll double, br double")
    reps = parts.groupBy("replicate").agg(
        (F.sum("ll") / F.sum("w")).alias("ll"), (F.sum("br") / F.sum("w")).alias("br")
    )  # `replicates` rows
    cuts = reps.agg(
        F.percentile("ll", F.array(F.lit(0.025), F.lit(0.5), F.lit(0.975))).alias("ll"),
        F.percentile("br", F.array(F.lit(0.025), F.lit(0.5), F.lit(0.975))).alias("br"),
    )
    rows = cuts.select(F.expr("stack(2, 'log_loss', ll, 'brier', br) as (metric, q)"))
    return rows.select(
        "metric",
        F.col("q")[1].alias("median_delta"),
        F.col("q")[0].alias("ci95_low"),
        F.col("q")[2].alias("ci95_high"),
        (F.col("q")[0] > 0).alias("significant_improvement"),
    )


def value_share(df: DataFrame, column: str) -> DataFrame:
    """Share of each value of a column."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(0))))


def row_crosstab(df: DataFrame, row: str, column: str, values: Sequence) -> DataFrame:
    """Row-normalised cross table with fixed columns."""
    table = df.groupBy(row).pivot(column, list(values)).count().fillna(0)
    total = sum((F.col(f"`{v}`") for v in values), F.lit(0))
    return table.select(row, *[(F.col(f"`{v}`") / total).alias(str(v)) for v in values])


def box_quartiles(df: DataFrame, group: str, value: str) -> DataFrame:
    """min, quartiles, median and max of ``value`` per group."""
    rows = exact_quantiles(df, value, [0.0, 0.25, 0.5, 0.75, 1.0], [group])
    names = {0.0: "min", 0.25: "q1", 0.5: "median", 0.75: "q3", 1.0: "max"}
    return rows.groupBy(group).agg(*[F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(n) for p, n in names.items()])
