"""Eight credit rules over the measurement table, their robustness grid, segment slices and coverage.

The pairs are first reduced to one row per (conversion, channel), with partial aggregation before the
shuffle. A conversion then has at most as many rows as there are channels, so the per-conversion windows
stay small even for a conversion with a huge number of touches.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

METHODS = (
    "last_touch", "first_touch", "linear", "time_decay", "u_shape", "w_shape", "markov_proxy", "shapley_proxy",
)
WINDOWS = (1, 3, 7, 14, 30)
LAGS = (0, 6, 24)


def _per_channel(joined: DataFrame, keys: list[str], half_life: float) -> DataFrame:
    """Pairs reduced to (keys…, user, conversion, channel); all buffers are plain numbers, so it hashes.

    The user is a key although the conversion implies it: after a join on user the rows are already
    where this aggregate and the windows after it need them.
    """
    decay = F.exp(F.lit(-math.log(2) / half_life) * F.col("hours_before_conversion"))
    position = F.col("touch_pos")
    return joined.groupBy(*keys, "user_id", "conversion_id", "channel").agg(
        F.max("conversion_value").alias("value"),
        F.count(F.lit(1)).alias("touches"),
        F.sum(decay).alias("decay"),
        F.min(position).alias("lo"),
        F.max(position).alias("hi"),
        # latest touch that comes first among the user's touches of the same instant (lowest exposure id)
        F.max(F.when(position == F.col("peer_pos"), position)).alias("latest"),
    )


def _merge(parts: DataFrame, keys: list[str]) -> DataFrame:
    return parts.groupBy(*keys, "user_id", "conversion_id", "channel").agg(
        F.max("value").alias("value"),
        F.sum("touches").alias("touches"),
        F.sum("decay").alias("decay"),
        F.min("lo").alias("lo"),
        F.max("hi").alias("hi"),
        F.max("latest").alias("latest"),
    )


def _with_middle(table: DataFrame, joined: DataFrame, touches: DataFrame | None) -> DataFrame:
    """Adds the channel at position n div 2, looked up by (user, position).

    ``touches`` are the ranked exposures; without them the positions are looked up in the pairs, which
    evaluates the join once more.
    """
    source = joined if touches is None else touches
    spots = source.select("user_id", F.col("touch_pos").alias("mid_pos"), F.col("channel").alias("mid_channel"))
    if touches is None:
        spots = spots.distinct()
    middle = F.when(F.col("n") > 2, F.col("first_pos") + F.floor(F.col("n") / 2))
    return table.withColumn("mid_pos", middle).join(spots, ["user_id", "mid_pos"], "left")


def conversion_credit(
    joined: DataFrame,
    methods: Sequence[str] = METHODS,
    by: Sequence[str] = (),
    half_life_hours: float = 48.0,
    renormalize_w: bool = False,
    carry: Sequence[str] = (),
    expand: Callable[[DataFrame], DataFrame] | None = None,
    touches: DataFrame | None = None,
) -> DataFrame:
    """One row per (by…, user, conversion, channel) with one credit column per method.

    ``markov_proxy`` holds the presence flag and ``shapley_proxy`` the share, both skipping null channels.
    With three touches ``w_shape`` hands out only 0.9 of the value; ``renormalize_w`` hands out all of it.

    Slices are made from the reduced rows, not from pairs: pairs are reduced per (carry…, conversion,
    channel), ``expand`` turns the carried columns into the ``by`` columns, and the parts are merged.
    """
    by = list(by)
    conv = [*by, "user_id", "conversion_id"]
    if expand is None:
        table = _per_channel(joined, by, half_life_hours)
    else:
        table = _merge(expand(_per_channel(joined, list(carry), half_life_hours)), by)
    whole = Window.partitionBy(*conv)
    table = table.select(
        "*",
        F.sum("touches").over(whole).alias("n"),
        F.sum("decay").over(whole).alias("all_decay"),
        F.min("lo").over(whole).alias("first_pos"),
        F.max("hi").over(whole).alias("last_pos"),
        F.max("latest").over(whole).alias("last_row"),
        F.count("channel").over(whole).alias("channels"),
    )
    need_middle = "w_shape" in methods
    if need_middle:
        table = _with_middle(table, joined, touches)
    value, n, touches = F.col("value"), F.col("n"), F.col("touches")
    is_first = (F.col("lo") == F.col("first_pos")).cast("int")
    is_last = (F.col("hi") == F.col("last_pos")).cast("int")
    weights: dict[str, Column] = {
        "last_touch": value * (F.col("latest") == F.col("last_row")).cast("int"),
        "first_touch": value * is_first,
        "linear": value * touches / n,
        "time_decay": value
        * F.when(F.col("all_decay") > 0, F.col("decay") / F.col("all_decay")).otherwise(touches / n),
        "u_shape": value
        * F.when(n <= 2, touches / n).otherwise(
            0.4 * (is_first + is_last) + 0.2 / F.nullif(n - 2, F.lit(0)) * (touches - is_first - is_last)
        ),
        "markov_proxy": F.col("channel").isNotNull().cast("int"),
        "shapley_proxy": F.when(F.col("channel").isNotNull(), value / F.nullif(F.col("channels"), F.lit(0))),
    }
    if need_middle:
        # n = 3: the middle (3 div 2 = 1) is its own anchor, so there are always three anchors
        is_mid = F.coalesce(F.col("channel").eqNullSafe(F.col("mid_channel")), F.lit(False)).cast("int")
        anchors = is_first + is_last + is_mid
        share = 0.3 / (0.9 if renormalize_w else 1.0)
        three = share * anchors
        more = 0.3 * anchors + 0.1 / F.nullif(n - 3, F.lit(0)) * (touches - anchors)
        weights["w_shape"] = value * F.when(n <= 2, touches / n).when(n == 3, three).otherwise(more)
    return table.select(*conv, "channel", "value", *[weights[m].alias(m) for m in methods])


def attribute(joined: DataFrame, methods: Sequence[str] = METHODS, by: Sequence[str] = (), **kwargs) -> DataFrame:
    """(by…, method, channel, credit) for all ``methods`` in one pass; null channels get no row."""
    by = list(by)
    rows = conversion_credit(joined, methods, by, **kwargs)
    plain = [m for m in methods if m != "markov_proxy"]
    sums = [F.sum(m).alias(m) for m in methods]
    if "markov_proxy" in methods:
        # value of a conversion, counted once: spread over its rows (null channels included)
        per_conv = Window.partitionBy(*by, "user_id", "conversion_id")
        rows = rows.withColumn("_part", F.col("value") / F.count(F.lit(1)).over(per_conv))
        sums.append(F.sum("_part").alias("_value"))
    per_channel = rows.groupBy(*by, "channel").agg(*sums)  # (slices × channels) rows from here on
    if "markov_proxy" in methods:
        group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
        score = F.sum("markov_proxy").over(group)
        paths = F.sum("_value").over(group)
        per_channel = per_channel.withColumn("markov_proxy", F.col("markov_proxy") / F.nullif(score, F.lit(0)) * paths)
    per_channel = per_channel.where(F.col("channel").isNotNull())
    stack = ", ".join(f"'{m}', cast({m} as double)" for m in [*plain, *(["markov_proxy"] if "markov_proxy" in methods else [])])
    return per_channel.select(*by, "channel", F.expr(f"stack({len(methods)}, {stack}) as (method, credit)")).select(
        *by, "method", "channel", "credit"
    ).where(F.col("credit").isNotNull())


def credit_for(joined: DataFrame, method: str, **kwargs) -> DataFrame:
    """(channel, credit) of one rule; channels the rule gives nothing are left out as in a per-rule sum."""
    if method not in METHODS:
        raise ValueError(f"unknown method {method!r}; choose from {METHODS}")
    return attribute(joined, [method], **kwargs).select("channel", "credit").where("credit <> 0")


def method_pivot(credits: DataFrame, methods: Sequence[str] = METHODS) -> DataFrame:
    """channel × method table, missing → 0."""
    return credits.groupBy("channel").pivot("method", list(methods)).agg(F.sum("credit")).fillna(0.0)


def robustness_grid(
    joined: DataFrame,
    total_conversions: int,
    windows: Sequence[int] = WINDOWS,
    lags: Sequence[int] = LAGS,
    methods: Sequence[str] = METHODS,
    touches: DataFrame | None = None,
) -> DataFrame:
    """Credit total, coverage and top channel per (window, lag, method) from one join at the widest window.

    Windows and lags must be ascending. Pairs are reduced per first window and lag they meet, and those parts
    are summed into the cells that hold them; cells without pairs are absent.
    Ties for the top channel go to the smaller name.
    """
    hours = F.col("hours_before_conversion")
    inside = sum(((hours > w * 24.0).cast("int") for w in windows), F.lit(0))  # first window that holds the pair
    late = sum(((hours >= float(lag)).cast("int") for lag in lags), F.lit(0))  # lags that the pair meets
    marked = joined.withColumns({"_w": inside, "_l": late})
    cell = ["window_days", "min_lag"]

    def cells(parts: DataFrame) -> DataFrame:
        grid = F.array(
            *[
                F.when(
                    (F.col("_w") <= i) & (F.col("_l") > k),
                    F.struct(F.lit(w).alias("window_days"), F.lit(lag).alias("min_lag")),
                )
                for i, w in enumerate(windows)
                for k, lag in enumerate(lags)
            ]
        )
        return parts.withColumn("_cell", F.explode(F.array_compact(grid))).select("*", "_cell.*").drop("_cell", "_w", "_l")

    credits = attribute(marked, methods, by=cell, carry=["_w", "_l"], expand=cells, touches=touches)
    seen = marked.select("conversion_id", "_w", "_l").distinct()
    covered = cells(seen).groupBy(*cell).agg(F.count_distinct("conversion_id").alias("covered"))
    return grid_report(credits, covered, total_conversions)


def grid_report(credits: DataFrame, covered: DataFrame, total_conversions: int) -> DataFrame:
    """Grid rows from credit per (window_days, min_lag, method, channel) and covered conversions per cell."""
    cell = ["window_days", "min_lag"]
    report = credits.groupBy(*cell, "method").agg(
        F.sum("credit").alias("total_credit"),
        F.min_by("channel", F.struct(-F.round("credit", 9), "channel")).alias("top_channel"),
    )
    pct = F.round(100.0 * F.col("covered") / max(total_conversions, 1), 2)
    return report.join(covered, cell).select(
        "window_days",
        F.col("min_lag").alias("min_lag_hours"),
        "method",
        "total_credit",
        pct.alias("coverage_pct"),
        "top_channel",
    )


def stability(grid: DataFrame) -> DataFrame:
    """Per method: mean coverage, distinct top channels, sample deviation of the credit total."""
    return grid.groupBy("method").agg(
        F.avg("coverage_pct").alias("avg_coverage_pct"),
        F.count_distinct("top_channel").alias("top_channel_nunique"),
        F.stddev_samp("total_credit").alias("total_credit_std"),
    )


def segment_slices(
    joined: DataFrame, segment_cols: Sequence[str], methods: Sequence[str] = METHODS, touches: DataFrame | None = None
) -> DataFrame:
    """All rules inside each value of each segment column; a missing segment is the value 'nan'."""
    value = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("nan"))

    def slices(parts: DataFrame) -> DataFrame:
        labels = F.array(*[F.struct(F.lit(c).alias("segment_col"), value(c).alias("segment_value")) for c in segment_cols])
        return parts.withColumn("_s", F.explode(labels)).select("*", "_s.*").drop("_s", *segment_cols)

    return attribute(joined, methods, by=["segment_col", "segment_value"], carry=list(segment_cols), expand=slices, touches=touches)


def top_channel_per_slice(slices: DataFrame) -> DataFrame:
    """Highest-credit channel per (segment, method); ties go to the smaller name."""
    best = F.min_by(F.struct("channel", "credit"), F.struct(-F.round("credit", 9), "channel")).alias("b")
    return slices.groupBy("segment_col", "segment_value", "method").agg(best).select(
        "segment_col", "segment_value", "method", "b.channel", "b.credit"
    )


def coverage_summary(per_conversion: DataFrame, lookback_days: int) -> DataFrame:
    """Total and matched conversions and the matched percentage (2 places).

    ``per_conversion`` is (conversion_id, n) from ``window_counts``, so no pair is built.
    """
    counts = per_conversion.agg(F.count(F.lit(1)).alias("t"), F.count_if(F.col("n") > 0).alias("m"))
    return counts.select(
        F.lit(lookback_days).alias("lookback_days"),
        F.col("t").alias("total_conversions"),
        F.col("m").alias("matched_conversions"),
        F.round(100.0 * F.col("m") / F.greatest("t", F.lit(1)), 2).alias("coverage_pct"),
    )


def coverage_operations(per_conversion: DataFrame, per_exposure: DataFrame, days: int) -> DataFrame:
    """Nine (metric, value) rows: conversions, users and exposures, total, matched and unmatched.

    Inputs are the two tables of ``window_counts``.
    """
    side = lambda df, kind: df.groupBy("user_id").agg(
        F.count(F.lit(1)).alias(f"{kind}_all"), F.count_if(F.col("n") > 0).alias(f"{kind}_hit")
    )
    users = side(per_conversion, "c").join(side(per_exposure, "e"), "user_id", "full").fillna(0)
    matched = F.col("c_hit") > 0
    less = lambda a, b: F.sum(a) - F.sum(b)
    wide = users.agg(
        F.sum("c_all").alias("conversions_total"),
        F.sum("c_hit").alias(f"conversions_attributed_{days}d"),
        less("c_all", "c_hit").alias(f"conversions_unattributed_{days}d"),
        F.count(F.lit(1)).alias("users_total_union"),
        F.count_if(matched).alias(f"users_matched_{days}d"),
        F.count_if(~matched).alias(f"users_unmatched_{days}d"),
        F.sum("e_all").alias("exposure_events_total"),
        F.sum("e_hit").alias(f"exposure_events_matched_{days}d"),
        less("e_all", "e_hit").alias(f"exposure_events_unmatched_{days}d"),
    )
    pairs = ", ".join(f"'{c}', {c}" for c in wide.columns)
    return wide.select(F.expr(f"stack({len(wide.columns)}, {pairs}) as (metric, value)"))
