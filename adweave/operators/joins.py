"""Exposure to conversion joins, cohort restriction and small-table joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adweave.functions.scalar import hours_between
from adweave.operators.ordered import rank_in_groups

HOT_ROWS = 200_000
JOINED = [
    "lookback_days", "min_lag_hours", "conversion_id", "user_id", "ts_conversion", "conversion_value",
    "exposure_id", "channel", "ts_exposure", "hours_before_conversion",
]


def _in_window(lookback_days: float, min_lag_hours: float) -> Column:
    hours = hours_between("ts_exposure", "ts_conversion")
    return (hours >= F.lit(float(min_lag_hours))) & (hours <= F.lit(float(lookback_days) * 24))


def _shape(pairs: DataFrame, lookback_days: int, min_lag_hours: float) -> DataFrame:
    extra = [c for c in ("touch_pos", "peer_pos") if c in pairs.columns]
    return pairs.select(
        F.lit(lookback_days).alias("lookback_days"),
        F.lit(float(min_lag_hours)).alias("min_lag_hours"),
        *JOINED[2:-1],
        hours_between("ts_exposure", "ts_conversion").alias("hours_before_conversion"),
        *extra,
    )


def _in_blocks(left: DataFrame, right: DataFrame, keys: Sequence[str], left_id: str, right_id: str, rows: int) -> DataFrame:
    """The equi-join on ``keys`` with both sides of a large key cut into blocks of about ``rows``.

    Each block of the left side meets each block of the right side in one place, so every pair comes out once and no
    task has more than a block of either side for one key.
    """
    key = list(keys)
    blocks = lambda df, name: df.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / rows).cast("int").alias(name)).where(F.col(name) > 1)
    cuts = blocks(left, "_lb").join(blocks(right, "_rb"), key, "full").select(*key, F.coalesce("_lb", F.lit(1)).alias("_lb"), F.coalesce("_rb", F.lit(1)).alias("_rb"))

    def dealt(df: DataFrame, own: str, own_blocks: str, id_col: str, other: str, other_blocks: str) -> DataFrame:
        marked = df.join(cuts, key, "left")
        marked = marked.withColumn(own, F.pmod(F.xxhash64(id_col), F.coalesce(own_blocks, F.lit(1))).cast("int"))
        return marked.withColumn(other, F.explode(F.sequence(F.lit(0), F.coalesce(other_blocks, F.lit(1)) - 1))).drop("_lb", "_rb")

    return dealt(left, "_l", "_lb", left_id, "_r", "_rb").join(dealt(right, "_r", "_rb", right_id, "_l", "_lb"), [*key, "_l", "_r"]).drop("_l", "_r")


def window_join(
    exposures: DataFrame, conversions: DataFrame, lookback_days: int, min_lag_hours: float = 0.0, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Pairs of the same user with ``min_lag ≤ hours between ≤ lookback*24``, both ends inclusive.

    One equi-join on user with the range as a residual join condition, so non-matching pairs are never
    materialised; users with more than ``hot_rows`` on a side are cut into blocks. Row order is not part of a
    DataFrame; sort by (conversion_id, ts_exposure) to present.
    """
    pairs = _in_blocks(exposures, conversions, ["user_id"], "exposure_id", "conversion_id", hot_rows)
    return _shape(pairs.where(_in_window(lookback_days, min_lag_hours)), lookback_days, min_lag_hours)


def bucketed_window_join(
    exposures: DataFrame,
    conversions: DataFrame,
    lookback_days: int,
    min_lag_hours: float = 0.0,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Same rows as :func:`window_join`, spread over time buckets, and over blocks for heavy (user, bucket)s.

    The bucket is as wide as the lookback, so a conversion can only see its own bucket and the one before.
    """
    width = int(lookback_days * 86_400_000_000)
    micros = lambda ts: F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP'1970-01-01 00:00:00', {ts})")
    touches = exposures.withColumn("_bucket", F.floor(micros("ts_exposure") / width))
    own = F.floor(micros("ts_conversion") / width)
    seekers = conversions.withColumn("_bucket", F.explode(F.array(own, own - 1)))
    pairs = _in_blocks(touches, seekers, ["user_id", "_bucket"], "exposure_id", "conversion_id", hot_rows)
    return _shape(pairs.where(_in_window(lookback_days, min_lag_hours)), lookback_days, min_lag_hours)


def rank_touches(exposures: DataFrame) -> DataFrame:
    """Exposures with ``touch_pos``, the position in the user's history, and ``peer_pos``, the position of the
    user's first touch of the same instant."""
    return rank_in_groups(exposures, "user_id", "ts_exposure", "exposure_id", peers="peer_pos")


def measurement_table(
    exposures: DataFrame,
    conversions: DataFrame,
    lookback_days: int,
    min_lag_hours: float = 0.0,
    bucketed: bool = True,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Window join plus the positions of :func:`rank_touches` (worked out here unless they are present).

    The touches of one conversion are neighbours in that history, so ``touch_pos`` gives every position rule
    its answer from per-conversion minima and counts, with no sort of the pairs.
    """
    ranked = exposures if "touch_pos" in exposures.columns else rank_touches(exposures)
    if bucketed:
        return bucketed_window_join(ranked, conversions, lookback_days, min_lag_hours, hot_rows)
    return window_join(ranked, conversions, lookback_days, min_lag_hours)


def restrict_to_converters(touches: DataFrame) -> DataFrame:
    """All rows of users with at least one conversion row (``conversion`` = 1)."""
    users = touches.where(F.col("conversion") == 1).select("user_id").distinct()
    return touches.join(users, "user_id", "left_semi")


def attach_labels(df: DataFrame, labels: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Left join of a label or recommendation table; label columns the left side already has are skipped."""
    keys = [on] if isinstance(on, str) else list(on)
    extra = [c for c in labels.columns if c not in keys and c not in df.columns]
    return df.join(labels.select(*keys, *extra), keys, "left")


def shape_touch_log(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Raw touch log → (exposures, conversions), with ids from the rows' own values, not row numbers.

    Numeric text is coerced; rows without time, user or campaign go; a conversion needs flag 1 and a
    conversion time not before its touch, and is one row per distinct (user, id, time).
    """
    typed = raw.select(
        F.col("timestamp").try_cast("double").alias("timestamp"),
        F.col("uid").cast("string").alias("user_id"),
        F.col("campaign").cast("string").alias("channel"),
        F.coalesce(F.col("conversion").try_cast("double"), F.lit(0)).cast("int").alias("conversion"),
        F.col("conversion_timestamp").try_cast("double").alias("conversion_timestamp"),
        F.col("conversion_id").try_cast("double").cast("long").alias("conversion_id"),
    ).dropna(subset=["timestamp", "user_id", "channel"])
    stamp = lambda c: F.timestamp_micros((F.col(c) * 1e6).cast("long"))
    exposures = typed.select(
        "user_id", "channel", "timestamp", stamp("timestamp").alias("ts_exposure"),
        F.xxhash64("user_id", "timestamp", "channel", "conversion_id").alias("exposure_id"),
    )
    conversions = (
        typed.where((F.col("conversion") == 1) & (F.col("conversion_timestamp") >= F.col("timestamp")))
        .select("user_id", F.col("conversion_id").alias("source_id"), "conversion_timestamp")
        .distinct()
        .select(
            "user_id",
            F.xxhash64("user_id", "source_id", "conversion_timestamp").alias("conversion_id"),
            "conversion_timestamp",
            stamp("conversion_timestamp").alias("ts_conversion"),
            F.lit(1.0).alias("conversion_value"),
        )
    )
    return exposures, conversions
