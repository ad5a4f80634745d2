"""Whole-table order without a single-task sort: running totals, positional ranks, exact quantiles.

Order comes from ``scan.running``, which deals rows to tasks by ranges that may cut a group or a tie. Quantiles need no
order of the table: a sketch gives a bracket for each, one scan counts what lies outside the brackets and keeps the
distinct values inside, and only those are ordered.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adweave.operators import scan
from adweave.session import cut_lineage

ACCURACY = 1_000  # a bracket reaches two of the sketch's rank errors, 1 / ACCURACY of the rows each, to either side
BROADCAST_GROUPS = 10_000  # most groups whose brackets are broadcast


def running_totals(
    df: DataFrame, score: str, key: str | None, totals: Mapping[str, Column], by: Sequence[str] = (), descending: bool = True, next_score: str | None = None,
) -> DataFrame:
    """Adds, per group ``by``, the inclusive running total of each expression in (score, key) order.

    For every ``name`` in ``totals`` the result has ``name`` and the group total ``name_all``. ``key`` breaks
    ties ascending and must be unique within equal scores; None says that scores are already distinct. Rows with a null
    score are left out. ``next_score`` names a column for the score of the following row (null at the end). Groups
    may be many or large.
    """
    order = [F.col(score).desc() if descending else F.col(score).asc(), *([F.col(key).asc()] if key else [])]
    following = {next_score: (score, descending)} if next_score else None
    return scan.running(df.where(F.col(score).isNotNull()), by, order, totals, following=following, totals=True)


def positional_rank(df: DataFrame, score: str, key: str, by: Sequence[str] = (), descending: bool = True, name: str = "rank") -> DataFrame:
    """1-based position in (score, key) order over the whole table, plus the row count as ``<name>_all``."""
    return running_totals(df, score, key, {name: F.lit(1).cast("long")}, by, descending)


def _beside_brackets(rows: DataFrame, brackets: DataFrame) -> DataFrame:
    """``rows`` with the brackets of their group. A few brackets, counted first, are broadcast: dealt by group, the rows of one would be one task's."""
    return rows.join(brackets.hint("broadcast" if brackets.count() <= BROADCAST_GROUPS else "merge"), "_g")


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Linear-interpolated quantiles as rows (by…, prob, quantile), for any number of groups.

    The table is read twice, and shuffled only if it has more than ``BROADCAST_GROUPS`` groups: for the sketch, and for the counts of the
    distinct values in the brackets and of everything between two brackets. Groups are told apart with nulls as a value of their own.
    """
    by, probs = list(by), [float(p) for p in probs]
    named = F.struct(*by) if by else F.lit(0)
    rows = df.where(F.col(value).isNotNull()).select(named.alias("_g"), F.col(value).cast("double").alias("_value"))
    reach = 2 / ACCURACY
    edges = [max(p - reach, 0.0) for p in probs] + [min(p + reach, 1.0) for p in probs]
    sketch = rows.groupBy("_g").agg(F.percentile_approx("_value", edges, ACCURACY).alias("_e"), F.min("_value").alias("_least"), F.max("_value").alias("_most"), (F.count(F.lit(1)) < 4 * ACCURACY).alias("_few"))
    k = len(probs)
    low = [F.col("_least") if edges[i] == 0 else F.when(F.col("_few"), F.col("_least")).otherwise(F.col("_e")[i]) for i in range(k)]
    high = [F.col("_most") if edges[k + i] == 1 else F.when(F.col("_few"), F.col("_most")).otherwise(F.col("_e")[k + i]) for i in range(k)]
    brackets = cut_lineage(sketch.select("_g", *[c.alias(f"_lo{i}") for i, c in enumerate(low)], *[c.alias(f"_hi{i}") for i, c in enumerate(high)]))
    # values between two bracket ends share a slot, and slots rise with the values
    over = lambda i: (F.col("_value") >= F.col(f"_lo{i}"))
    past = lambda i: (F.col("_value") > F.col(f"_hi{i}"))
    slot = sum((over(i).cast("int") + past(i).cast("int") for i in range(k)), F.lit(0))
    inside = F.lit(False)
    for i in range(k):
        inside = inside | (over(i) & ~past(i))
    counts = _beside_brackets(rows, brackets).select("_g", slot.alias("_slot"), F.when(inside, F.col("_value")).alias("_value")).groupBy("_g", "_slot", "_value").agg(F.count(F.lit(1)).alias("_n"))
    ranked = scan.running(counts, ["_g"], [F.col("_slot"), F.col("_value")], {"_cum": F.col("_n")}, totals=True).where("_value is not null")
    picked = quantiles_of_counts(ranked, "_g", "_value", "_n", "_cum", "_cum_all", probs)
    return picked.select(*[F.col(f"_g.{c}").alias(c) for c in by], "prob", "quantile")


def quantiles_of_counts(ranked: DataFrame, by: str, value: str, n: str, upto: str, every: str, probs: Sequence[float]) -> DataFrame:
    """(by, prob, quantile), interpolated, of values that occur ``n`` times, ``upto`` of ``every`` up to and with them."""
    first, last = F.col(upto) - F.col(n), F.col(upto) - 1
    position = lambda p: p * (F.col(every) - 1)
    covers = lambda at: (at >= first) & (at <= last)
    grid = F.array(*[F.lit(float(p)) for p in probs])
    hits = ranked.withColumn("prob", F.explode(F.filter(grid, lambda p: covers(F.floor(position(p))) | covers(F.ceil(position(p))))))
    at = position(F.col("prob"))
    picked = hits.groupBy(by, "prob").agg(
        F.max(F.when(covers(F.floor(at)), F.col(value))).alias("_lo"), F.max(F.when(covers(F.ceil(at)), F.col(value))).alias("_hi"), F.max(at - F.floor(at)).alias("_frac"),
    )
    return picked.select(by, "prob", (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_frac")).alias("quantile"))


def rank_in_groups(df: DataFrame, group: str, time: str, key: str, name: str = "touch_pos", peers: str | None = None) -> DataFrame:
    """1-based position of each row within its group by (time, key), for any number and size of groups.

    ``peers`` names a column for the position of the first row of the same time.
    """
    ranked = scan.running(df, [group], [F.col(time), F.col(key)], {name: F.lit(1).cast("long")})
    if not peers:
        return ranked
    first = ranked.groupBy(F.struct(group, time).alias("_at")).agg(F.min(name).alias(peers))
    return ranked.withColumn("_at", F.struct(group, time)).join(first, "_at").drop("_at")
