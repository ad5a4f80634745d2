"""Uplift evaluation: audits, lift tables, Qini curves and learner comparison.

Input rows are (key, treatment 0/1, outcome 0/1, score).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adweave.operators.ordered import positional_rank, running_totals

# Ten cut-offs, with the doubles that 0.1 + i * 0.1 gives.
FRACTIONS = [0.1 + i * 0.1 for i in range(10)]


def treatment_audit(df: DataFrame) -> DataFrame:
    """Size, outcome rate and share of each arm."""
    arms = df.groupBy("treatment").agg(F.count(F.lit(1)).alias("group_size"), F.avg("outcome").alias("outcome_rate"))
    return arms.select(
        F.when(F.col("treatment") == 1, "treated").otherwise("control").alias("group_label"),
        "treatment",
        "group_size",
        "outcome_rate",
        (F.col("group_size") / F.sum("group_size").over(Window.partitionBy(F.lit(0)))).alias("share"),
    )


def _rate(arm: int) -> Column:
    suffix = {1: ("y1", "n1"), 0: ("y0", "n0")}[arm]
    return F.col(suffix[0]) / F.nullif(F.col(suffix[1]), F.lit(0))


def _prefix_counts(ranked: DataFrame, upto: Column, cells: Column) -> DataFrame:
    """Arm sizes and outcomes of the first ``upto`` rows, for each cell of the grid.

    Rows are first counted per earliest cell that holds them (ten groups), then summed over later cells.
    """
    first = F.array_min(F.filter(cells, lambda c: F.col("rank") <= upto(c)).getField("i"))
    t, y = F.col("treatment"), F.col("outcome")
    slots = ranked.groupBy(first.alias("slot")).agg(
        F.max("rank_all").alias("total"),
        F.sum(t).alias("t1"), F.sum(1 - t).alias("t0"), F.sum(t * y).alias("o1"), F.sum((1 - t) * y).alias("o0"),
    )
    table = slots.withColumn("_c", F.explode(cells))
    inside = F.col("slot") <= F.col("_c.i")
    add = lambda c: F.sum(F.when(inside, F.col(c)).otherwise(0))
    return table.groupBy(F.col("_c.i").alias("i"), F.col("_c.f").alias("f")).agg(
        F.max("total").alias("total"), add("t1").alias("n1"), add("t0").alias("n0"), add("o1").alias("y1"), add("o0").alias("y0"),
    )


def lift_table(df: DataFrame, key: str = "key") -> DataFrame:
    """Ten cumulative cut-offs: rates per arm, incremental lift, random line, Qini gain and coefficient.

    The cut holds ``max(1, int(N·fraction))`` rows by score. A rate is null when its arm is empty. The
    coefficient is the trapezoid over the ten points, which start at 0.1 and not at the origin.
    """
    ranked = positional_rank(df, "score", key)
    cells = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(f).alias("f")) for i, f in enumerate(FRACTIONS)])
    size = lambda c: F.greatest(F.lit(1), F.floor(F.col("rank_all") * c["f"]))
    counts = _prefix_counts(ranked, size, cells)  # ten rows from here on
    n = F.greatest(F.lit(1), F.floor(F.col("total") * F.col("f")))
    table = counts.select(
        (F.col("i") + 1).alias("decile"),
        F.round("f", 2).alias("top_fraction"),
        n.alias("segment_size"),
        _rate(1).alias("treated_rate"),
        _rate(0).alias("control_rate"),
    ).withColumn("incremental_lift", (F.col("treated_rate") - F.col("control_rate")) * F.col("segment_size"))
    whole = Window.partitionBy(F.lit(0))
    ordered = whole.orderBy("decile")
    table = table.withColumn(
        "random_incremental_lift", F.col("top_fraction") * F.max_by("incremental_lift", "decile").over(whole)
    ).withColumn("qini_gain", F.col("incremental_lift") - F.col("random_incremental_lift"))
    step = (
        (F.col("qini_gain") + F.lag("qini_gain").over(ordered)) / 2 * (F.col("top_fraction") - F.lag("top_fraction").over(ordered))
    )
    return table.withColumn("_s", step).withColumn("qini_coefficient", F.sum("_s").over(whole)).drop("_s")


def lift_summary(df: DataFrame, key: str = "key", model: str = "model") -> DataFrame:
    """Top-20 % rates, lift and capture share, top-decile lift and Qini coefficient in one row."""
    table = lift_table(df, key)
    pick = lambda c, d: F.max(F.when(F.col("decile") == d, F.col(c)))
    final = F.nullif(pick("incremental_lift", 10), F.lit(0.0))
    return table.agg(
        F.lit(model).alias("model"),
        pick("segment_size", 2).alias("top20_segment_size"),
        pick("treated_rate", 2).alias("top20_treated_rate"),
        pick("control_rate", 2).alias("top20_control_rate"),
        pick("incremental_lift", 2).alias("top20_incremental_lift"),
        (pick("incremental_lift", 2) / final).alias("top20_capture_share"),
        pick("incremental_lift", 1).alias("top_decile_incremental_lift"),
        F.max("qini_coefficient").alias("qini_coefficient"),
    )


def qini_curve(df: DataFrame, key: str = "key") -> DataFrame:
    """Per-row curve: rank, arm rates so far, lift, random line and gain."""
    t, y = F.col("treatment"), F.col("outcome")
    sums = {
        "rank": F.lit(1).cast("long"), "n1": t.cast("long"), "n0": (1 - t).cast("long"),
        "y1": (t * y).cast("long"), "y0": ((1 - t) * y).cast("long"),
    }
    cum = running_totals(df, "score", key, sums)
    rates = cum.withColumns(
        {
            "top_fraction": F.col("rank") / F.col("rank_all"),
            "treated_rate": _rate(1),
            "control_rate": _rate(0),
            "final": (
                F.col("y1_all") / F.nullif(F.col("n1_all"), F.lit(0)) - F.col("y0_all") / F.nullif(F.col("n0_all"), F.lit(0))
            )
            * F.col("rank_all"),
        }
    )
    lift = (F.col("treated_rate") - F.col("control_rate")) * F.col("rank")
    return rates.select(
        key, "score", "treatment", "outcome", "rank", F.col("rank_all").alias("n"), "top_fraction", "treated_rate",
        "control_rate", lift.alias("incremental_lift"),
        (F.col("top_fraction") * F.col("final")).alias("random_incremental_lift"),
        (lift - F.col("top_fraction") * F.col("final")).alias("qini_gain"),
    )


def qini_summary(curve: DataFrame) -> DataFrame:
    """Qini coefficient of a per-row curve and top-20 % rates and lift.

    Points are 1/n apart, so the trapezoid is the sum of all gains less half of the first and last, over n;
    a null gain counts as 0.
    """
    gain = F.coalesce("qini_gain", F.lit(0.0))
    ends = (F.col("rank") == 1).cast("int") + (F.col("rank") == F.col("n")).cast("int")
    top = F.col("top_fraction") <= 0.20
    t = F.col("treatment") == 1
    lift = (F.col("top20_treated_rate") - F.col("top20_control_rate")) * F.col("_top")
    return curve.agg(
        (F.sum(gain * (1 - ends / 2)) / F.max("n")).alias("qini_coefficient"),
        F.avg(F.when(top & t, F.col("outcome"))).alias("top20_treated_rate"),
        F.avg(F.when(top & ~t, F.col("outcome"))).alias("top20_control_rate"),
        F.count_if(top).alias("_top"),
    ).select("qini_coefficient", "top20_treated_rate", "top20_control_rate", lift.alias("top20_incremental_lift"))


def qini_deciles(curve: DataFrame) -> DataFrame:
    """Ceil-deciles of the curve. ``treated_rate`` is the share treated, as in the original report."""
    return curve.groupBy(F.ceil(F.col("top_fraction") * 10).cast("int").alias("decile")).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("treatment").alias("treated_rate"),
        F.avg("outcome").alias("outcome_rate"),
        F.avg("score").alias("avg_uplift_score"),
    )


def compare_learners(summaries: DataFrame) -> DataFrame:
    """Learner summaries ordered by (Qini, top-20 lift) descending, nulls last; rank 1 is recommended."""
    order = Window.partitionBy(F.lit(0)).orderBy(
        F.desc_nulls_last("qini_coefficient"), F.desc_nulls_last("top20_incremental_lift"), "model"
    )
    ranked = summaries.withColumn("position", F.row_number().over(order))  # one row per learner
    return ranked.withColumn("recommended", F.col("position") == 1)
