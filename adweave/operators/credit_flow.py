"""Attribution without pairs: all eight rules from sorted timelines, linear in exposures plus conversions.

The window join has one row per (exposure, conversion) in the lookback, which is quadratic for a user who
holds much of the data. Here nothing is paired. The touches of a conversion are a run of neighbours in the
user's history, so their number, decay total and distinct channels are differences of running sums; and
the credit of an exposure is a sum over the conversions that can see it, again a difference of running
sums. First, last and middle touch are looked up by position. The running sums are those of ``scan.running``, which cuts
a timeline anywhere, so no task needs the whole of one user or of one of a user's days. Decay totals are as of the asking
row's own time, so a history may be of any length.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adweave.operators import scan
from adweave.operators.attribution import LAGS, METHODS, WINDOWS, grid_report
from adweave.session import cut_lineage

DAY = 86_400_000_000
HOUR = 3_600_000_000
PASS_ROWS = 50_000_000  # exposures and conversions times cells that go through the passes together
SUMMED = [*METHODS, "seen", "firsts", "lasts", "all_value", "covered"]


def _micros(ts: str) -> Column:
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP'1970-01-01 00:00:00', {ts})")


def _touches(exposures: DataFrame) -> DataFrame:
    """Exposures with 0-based position, the channel of the first touch at the same instant, and the time of
    the user's next touch of the same channel."""
    base = exposures.select("user_id", "exposure_id", "channel", _micros("ts_exposure").alias("t"))
    order = [F.col("t"), F.col("exposure_id")]
    placed = scan.running(base, ["user_id"], order, {"pos": F.lit(1).cast("long")}).withColumn("pos", F.col("pos") - 1)
    placed = scan.running(placed, ["user_id", "channel"], order, {}, following={"next_t": ("t", False)})
    peers = base.groupBy("user_id", "t").agg(F.min_by("channel", "exposure_id").alias("peer_channel"))
    return placed.join(peers.hint("merge"), ["user_id", "t"])


def _conversion_stats(touches: DataFrame, conversions: DataFrame, reach: Column, lag: Column, half_life: float) -> DataFrame:
    """(user_id, conversion_id, value, first_pos, n, decay, channels) of conversions with a touch.

    ``reach`` and ``lag`` are columns of both sides, in microseconds. ``decay`` is as of the latest moment that a touch may have.
    """
    known = F.col("channel").isNotNull()
    none = F.lit(None).cast("string")
    zero = F.lit(0.0)
    shape = lambda axis, turn, count, decay, alive: [
        "user_id", axis.alias("axis"), F.lit(turn).alias("turn"), F.col("exposure_id").alias("tie"), F.lit(None).cast("long").alias("id"), none.alias("kind"),
        zero.alias("amount"), zero.alias("span"), count.alias("count"), decay.alias("decay"), alive.alias("alive"),
    ]
    starts = touches.select(*shape(F.col("t"), 1, F.lit(1.0), F.lit(1.0), known.cast("double")))
    # a touch stands for its channel until the lookback has passed or the channel is touched again
    over = F.least(F.col("t") + reach - lag + 1, F.col("next_t"))
    ends = touches.where(known).select(*shape(over, 1, zero, zero, F.lit(-1.0)))
    at = _micros("ts_conversion")
    marks = F.explode(
        F.array(
            F.struct((at - reach).alias("axis"), F.lit(0).alias("turn"), F.lit("lo").alias("kind")),
            F.struct((at - lag).alias("axis"), F.lit(2).alias("turn"), F.lit("hi").alias("kind")),
        )
    )
    seekers = conversions.select("user_id", "conversion_id", "conversion_value", (reach - lag).cast("double").alias("span"), marks.alias("m")).select(
        "user_id", "m.axis", "m.turn", F.col("conversion_id").alias("tie"), F.col("conversion_id").alias("id"), "m.kind", F.col("conversion_value").cast("double").alias("amount"),
        "span", zero.alias("count"), zero.alias("decay"), zero.alias("alive"),
    )
    sums = _running(starts.unionByName(ends).unionByName(seekers), ["count", "alive"], ["decay"], half_life)
    pick = lambda kind, c: F.max(F.when(F.col("kind") == kind, F.col(c)))
    return (
        sums.groupBy("user_id", F.col("id").alias("conversion_id"))
        .agg(
            F.max("amount").alias("value"),
            pick("lo", "count").cast("long").alias("first_pos"),
            (pick("hi", "count") - pick("lo", "count")).cast("long").alias("n"),
            (pick("hi", "decay") - pick("lo", "decay") * F.pow(F.lit(2.0), -F.max("span") / half_life)).alias("decay"),
            F.round(pick("hi", "alive")).cast("long").alias("channels"),
        )
        .where("n > 0")
    )


def _running(rows: DataFrame, sums: Sequence[str], decays: Sequence[str] = (), half_life: float | None = None) -> DataFrame:
    """Running values of ``sums`` and ``decays`` per user in (axis, turn) order in the rows that ask (those with a kind), replacing the values."""
    named = rows.select(*[c for c in rows.columns if c not in (*sums, *decays)], *[F.col(c).alias(f"_{c}") for c in (*sums, *decays)])
    order = [F.col("axis"), F.col("turn"), F.col("tie")]
    run = scan.running(named, ["user_id"], order, {c: F.col(f"_{c}") for c in sums}, {c: F.col(f"_{c}") for c in decays}, "axis", half_life)
    return run.where("kind is not null")


def window_counts(exposures: DataFrame, conversions: DataFrame, lookback_days: float, min_lag_hours: float = 0.0) -> tuple[DataFrame, DataFrame]:
    """How many partners each conversion and each exposure has in the window, without pairing them.

    Returns (user_id, conversion_id, n) and (user_id, exposure_id, n), zero counts included.
    """
    reach, lag = int(lookback_days * DAY), int(min_lag_hours * HOUR)

    def counts(points: DataFrame, seekers: DataFrame, low: Column, high: Column) -> DataFrame:
        mark = lambda kind, axis, turn: F.struct(F.lit(kind).alias("kind"), axis.alias("axis"), F.lit(turn).alias("turn"))
        asked = seekers.select("user_id", "id", F.explode(F.array(mark("lo", low, 0), mark("hi", high, 2))).alias("m")).select(
            "user_id", "m.axis", "m.turn", F.col("id").alias("tie"), "id", "m.kind", F.lit(0.0).alias("count")
        )
        given = points.select(
            "user_id", F.col("t").alias("axis"), F.lit(1).alias("turn"), F.col("id").alias("tie"), F.lit(None).cast("long").alias("id"), F.lit(None).cast("string").alias("kind"),
            F.lit(1.0).alias("count"),
        )
        sums = _running(given.unionByName(asked), ["count"])
        signed = F.when(F.col("kind") == "hi", F.col("count")).otherwise(-F.col("count"))
        return sums.groupBy("user_id", "id").agg(F.greatest(F.sum(signed), F.lit(0.0)).cast("long").alias("n"))

    shown = exposures.select("user_id", F.col("exposure_id").alias("id"), _micros("ts_exposure").alias("t"))
    bought = conversions.select("user_id", F.col("conversion_id").alias("id"), _micros("ts_conversion").alias("t"))
    t = F.col("t")
    per_conversion = counts(shown, bought.withColumns({"lo": t - reach, "hi": t - lag}), F.col("lo"), F.col("hi"))
    per_exposure = counts(bought, shown.withColumns({"lo": t + lag, "hi": t + reach}), F.col("lo"), F.col("hi"))
    return per_conversion.withColumnRenamed("id", "conversion_id"), per_exposure.withColumnRenamed("id", "exposure_id")


def _rest_shares(stats: DataFrame) -> DataFrame:
    """Adds what a touch that is no anchor gets under the two position rules."""
    n, value = F.col("n"), F.col("value")
    return stats.withColumns(
        {
            "u_rest": F.when(n <= 2, value / n).otherwise(0.2 * value / F.nullif(n - 2, F.lit(0))),
            "w_rest": F.when(n <= 2, value / n).when(n == 3, 0.0).otherwise(0.1 * value / F.nullif(n - 3, F.lit(0))),
        }
    )


def _anchor_credit(stats: DataFrame, touches: DataFrame) -> DataFrame:
    """Credit by position: first and last touch, and the anchors' surplus over the rest share."""
    spot = lambda kind, pos: F.struct(F.lit(kind).alias("spot"), pos.cast("long").alias("pos"))
    first, n = F.col("first_pos"), F.col("n")
    spots = F.array(
        spot("first", first), spot("last", first + n - 1), F.when(n > 2, spot("mid", first + F.floor(n / 2)))
    )
    wanted = stats.select("user_id", "value", "n", "u_rest", "w_rest", F.explode(F.array_compact(spots)).alias("s")).select("*", "s.*")
    found = wanted.join(touches.select("user_id", "pos", "channel", "peer_channel").hint("merge"), ["user_id", "pos"])
    value, many = F.col("value"), F.col("n") > 2
    is_first, is_last = F.col("spot") == "first", F.col("spot") == "last"
    ends = is_first | is_last
    own = found.select(
        "user_id",
        "channel",
        F.when(is_first, value).alias("first_touch"),
        F.when(is_first, 1.0).alias("firsts"),
        F.when(many & ends, 0.4 * value - F.col("u_rest")).alias("u_shape"),
        F.when(many, 0.3 * value - F.col("w_rest")).alias("w_shape"),
    )
    last = found.where(is_last).select("user_id", F.col("peer_channel").alias("channel"), F.col("value").alias("last_touch"), F.lit(1.0).alias("lasts"))
    return own.unionByName(last, allowMissingColumns=True)


def _exposure_credit(stats: DataFrame, conversions: DataFrame, touches: DataFrame, reach: Column, lag: Column, half_life: float) -> DataFrame:
    """Credit each exposure collects from the conversions that can see it, summed from the latest backwards (the axis is time with its sign turned)."""
    times = conversions.select("user_id", "conversion_id", (-_micros("ts_conversion")).alias("axis"))
    names = ["linear", "u_shape", "w_shape", "seen", "shapley_proxy", "markov_proxy"]
    value, some = F.col("value"), F.col("channels") > 0
    none = F.lit(None)
    givers = stats.join(times.hint("merge"), ["user_id", "conversion_id"]).select(
        "user_id", "axis", F.lit(0).alias("turn"), F.col("conversion_id").alias("tie"), none.cast("long").alias("id"), none.cast("string").alias("kind"), F.lit(0.0).alias("span"),
        (value / F.col("n")).alias("linear"), (value / F.col("decay")).alias("time_decay"), F.col("u_rest").alias("u_shape"), F.col("w_rest").alias("w_shape"), F.lit(1.0).alias("seen"),
        F.when(some, value / F.nullif(F.col("channels"), F.lit(0))).otherwise(0.0).alias("shapley_proxy"), some.cast("double").alias("markov_proxy"),
    )
    t = F.col("t")
    beyond = t + reach + 1
    mark = lambda kind, axis: F.struct(F.lit(kind).alias("kind"), (-axis).alias("axis"))
    marks = F.array(mark("from", t + lag), mark("past", beyond), mark("gone", F.least(beyond, F.col("next_t") + lag)))
    takers = touches.select("user_id", F.col("exposure_id").alias("id"), (reach + 1 - lag).cast("double").alias("span"), F.explode(marks).alias("m")).select(
        "user_id", "m.axis", F.lit(1).alias("turn"), F.col("id").alias("tie"), "id", "m.kind", "span", *[F.lit(0.0).alias(n) for n in ("time_decay", *names)]
    )
    sums = _running(givers.unionByName(takers), names, ["time_decay"], half_life)
    at = lambda kind, c: F.max(F.when(F.col("kind") == kind, F.col(c)))
    every = [(at("from", c) - at("past", c)).alias(c) for c in names[:4]]
    once = [(at("from", c) - at("gone", c)).alias(c) for c in names[4:]]
    faded = at("from", "time_decay") - at("past", "time_decay") * F.pow(F.lit(2.0), -F.max("span") / half_life)
    per_touch = sums.groupBy("user_id", F.col("id").alias("exposure_id")).agg(faded.alias("time_decay"), *every, *once)
    known = touches.select("user_id", "exposure_id", "channel").where(F.col("channel").isNotNull())
    return per_touch.join(known.hint("merge"), ["user_id", "exposure_id"]).select("user_id", "channel", "time_decay", *names)


def _placed(exposures: DataFrame, conversions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Touches with their places, and conversions, written once for all branches and cells."""
    return cut_lineage(_touches(exposures)), cut_lineage(conversions.select("user_id", "conversion_id", "conversion_value", "ts_conversion"))


def _credit_rows(placed: tuple[DataFrame, DataFrame], cells: Sequence[tuple[float, float]], half_life_hours: float) -> DataFrame:
    """Rows (user_id, cell, channel, one column per rule, all_value, covered) whose sums are the credit.

    A cell is a lookback in days and a least lag in hours. All cells go through the same passes: a (cell, user) takes the
    place of a user. The conversions' statistics are written once and read by all branches.
    """
    half_life = half_life_hours * HOUR
    grid = F.array(*[F.struct(F.lit(k).alias("cell"), F.lit(int(days * DAY)).alias("reach"), F.lit(int(hours * HOUR)).alias("lag")) for k, (days, hours) in enumerate(cells)])

    def in_cells(rows: DataFrame) -> DataFrame:
        wide = rows.select("*", F.explode(grid).alias("_c"))
        others = [c for c in rows.columns if c != "user_id"]
        return wide.select(F.struct(F.col("_c.cell").alias("cell"), F.col("user_id").alias("user")).alias("user_id"), *others, "_c.reach", "_c.lag")

    touches, conversions = map(in_cells, placed)
    reach, lag = F.col("reach"), F.col("lag")
    stats = cut_lineage(_rest_shares(_conversion_stats(touches, conversions, reach, lag, half_life)))
    rows = _exposure_credit(stats, conversions, touches, reach, lag, half_life)
    rows = rows.unionByName(_anchor_credit(stats, touches), allowMissingColumns=True)
    rows = rows.unionByName(stats.select("user_id", F.col("value").alias("all_value"), F.lit(1).alias("covered")), allowMissingColumns=True)
    return rows.withColumn("cell", F.col("user_id.cell")).withColumn("user_id", F.col("user_id.user"))


def _credit_table(rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by…, method, channel, credit, covered) from credit rows; ``covered`` counts matched conversions.

    Whether a channel has a row is decided by counts of its touches, which are exact, and not by the size of its credit.
    """
    by = list(by)
    table = rows.groupBy(*by, "channel").agg(*[F.sum(m).alias(m) for m in SUMMED])
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))  # one row per channel of a slice
    presence = F.nullif(F.sum("markov_proxy").over(group), F.lit(0.0))
    table = table.withColumns(
        {
            "markov_proxy": F.col("markov_proxy") / presence * F.sum("all_value").over(group),
            "covered": F.sum("covered").over(group),
        }
    )
    support = {"first_touch": "firsts", "last_touch": "lasts"}
    pairs = ", ".join(f"'{m}', {m}, {support.get(m, 'seen')}" for m in METHODS)
    known = table.where(F.col("channel").isNotNull())
    stacked = known.select(*by, "channel", "covered", F.expr(f"stack({len(METHODS)}, {pairs}) as (method, credit, touches)"))
    return stacked.where("touches > 0.5").select(*by, "method", "channel", "credit", "covered")


def attribute_timelines(
    exposures: DataFrame, conversions: DataFrame, lookback_days: float, min_lag_hours: float = 0.0, half_life_hours: float = 48.0
) -> DataFrame:
    """(method, channel, credit) of all eight rules, equal to ``attribute`` over the window join.

    ``exposure_id`` and ``conversion_id`` must be unique. Histories may be of any length, and one user may hold all rows.
    """
    rows = _credit_rows(_placed(exposures, conversions), [(lookback_days, min_lag_hours)], half_life_hours)
    return _credit_table(rows).drop("covered")


def slices_timelines(
    exposures: DataFrame, conversions: DataFrame, labels: DataFrame, segment_cols: Sequence[str], lookback_days: float, min_lag_hours: float = 0.0,
    half_life_hours: float = 48.0,
) -> DataFrame:
    """``segment_slices`` without pairs, for user-level segment labels; a missing label is 'nan'."""
    rows = _credit_rows(_placed(exposures, conversions), [(lookback_days, min_lag_hours)], half_life_hours)
    per_user = rows.groupBy("user_id", "channel").agg(*[F.sum(m).alias(m) for m in SUMMED])
    named = per_user.join(labels.select("user_id", *segment_cols), "user_id", "left")
    value = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("nan"))
    cells = F.array(*[F.struct(F.lit(c).alias("segment_col"), value(c).alias("segment_value")) for c in segment_cols])
    sliced = named.withColumn("_s", F.explode(cells)).select("*", "_s.*").drop("_s", *segment_cols)
    return _credit_table(sliced, ["segment_col", "segment_value"]).drop("covered")


def credit_by_channel(exposures: DataFrame, conversions: DataFrame, lookback_days: int, min_lag_hours: float = 0.0, methods: Sequence[str] = METHODS) -> DataFrame:
    """(method, channel, credit) of the chosen rules, from timelines."""
    return attribute_timelines(exposures, conversions, lookback_days, min_lag_hours).where(F.col("method").isin(*methods))


def credit_by_segment(exposures: DataFrame, conversions: DataFrame, labels: DataFrame, segment_cols: Sequence[str], lookback_days: int) -> DataFrame:
    """Segment slices, from timelines."""
    return slices_timelines(exposures, conversions, labels, segment_cols, lookback_days)


def robustness(
    exposures: DataFrame, conversions: DataFrame, windows: Sequence[int] = WINDOWS, lags: Sequence[int] = LAGS, half_life_hours: float = 48.0
) -> DataFrame:
    """Robustness grid without pairs. Touches are placed once; as many cells go through the passes together as make PASS_ROWS rows, and
    of each such group only the sums are kept, so the disk that is used does not grow with the number of cells."""
    total = conversions.select(F.count_distinct("conversion_id")).first()[0]
    grid = [(w, lag) for w in windows for lag in lags]
    placed = _placed(exposures, conversions)
    step = max(1, PASS_ROWS // max(sum(p.count() for p in placed), 1))

    def sums(k: int) -> DataFrame:
        table = _credit_table(_credit_rows(placed, grid[k : k + step], half_life_hours), ["cell"]).withColumn("cell", F.col("cell") + k)
        return cut_lineage(table) if step < len(grid) else table

    table = reduce(DataFrame.unionByName, [sums(k) for k in range(0, len(grid), step)])
    pick = lambda k: F.element_at(F.array(*[F.lit(c[k]) for c in grid]), F.col("cell") + 1)
    cells = table.select(pick(0).alias("window_days"), pick(1).alias("min_lag"), "method", "channel", "credit", "covered")
    covered = cells.groupBy("window_days", "min_lag").agg(F.max("covered").alias("covered"))
    return grid_report(cells, covered, total)
