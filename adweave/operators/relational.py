"""Small relational helpers behind the generic operators: sets, tops, group windows, cross tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adweave.operators.ordered import rank_in_groups


def drop_null_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Rows without a null in any column, or in ``subset``."""
    return df.dropna("any", subset=list(subset) if subset else None)


def coerce_numeric(df: DataFrame, columns: Sequence[str], fill: float | None = None, kind: str = "double") -> DataFrame:
    """Text to number in place; bad text becomes null or ``fill``."""
    parsed = {c: F.col(c).try_cast("double") for c in columns}
    return df.withColumns({c: (e if fill is None else F.coalesce(e, F.lit(float(fill)))).cast(kind) for c, e in parsed.items()})


def top_k(df: DataFrame, k: int, *order) -> DataFrame:
    """First k rows of an order; Spark keeps k rows per task and merges them."""
    return df.orderBy(*order).limit(k)


def stack_tables(tables: Sequence[DataFrame]) -> DataFrame:
    """Union by column name, keeping duplicates."""
    result = tables[0]
    for t in tables[1:]:
        result = result.unionByName(t)
    return result


def distinct_union(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.select(key).union(right.select(key)).distinct()


def difference(everyone: DataFrame, matched: DataFrame, key: str) -> DataFrame:
    """Rows of ``everyone`` whose key is not in ``matched``."""
    return everyone.join(matched.select(key), key, "left_anti")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key in ``order``, found by a partial aggregate and not by sorting groups."""
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(first).select(*keys, "_row.*")


def group_shares(df: DataFrame, group: str, time: str, key: str, value: str) -> DataFrame:
    """0-based position, size, sum and normalised value of each row in its group.

    Sizes and sums come from an aggregate joined back (one row per group), so a large group is not held in
    one window; a group that sums to nothing is shared equally.
    """
    totals = df.groupBy(group).agg(F.count(F.lit(1)).alias("group_n"), F.sum(value).alias("group_sum"))
    ranked = rank_in_groups(df, group, time, key, "_pos")
    share = F.when(F.col("group_sum") > 0, F.col(value) / F.col("group_sum")).otherwise(1.0 / F.col("group_n"))
    return ranked.join(totals, group).withColumn("pos", F.col("_pos") - 1).withColumn("share", share).drop("_pos")


def percent_rank_average(df: DataFrame, value: str) -> DataFrame:
    """(value, pct): average-tie percent rank of each distinct value, from the histogram of values."""
    from adweave.operators.ordered import running_totals

    histogram = df.groupBy(value).agg(F.count(F.lit(1)).alias("n"))
    cum = running_totals(histogram, value, None, {"upto": F.col("n")}, descending=False)
    return cum.select(value, ((F.col("upto") - F.col("n") + (F.col("n") + 1) / 2) / F.col("upto_all")).alias("pct"))


def pivot_sum(df: DataFrame, rows: str, columns: str, values: Sequence[str], amount: str, normalise: bool = False) -> DataFrame:
    """Pivot with a fixed column list, missing → 0, optionally as shares of each row's total."""
    table = df.groupBy(rows).pivot(columns, list(values)).agg(F.sum(amount)).fillna(0.0)
    if not normalise:
        return table
    total = sum((F.col(f"`{v}`") for v in values), F.lit(0.0))
    return table.select(rows, *[(F.col(f"`{v}`") / F.nullif(total, F.lit(0.0))).alias(v) for v in values])


def dense_ranks(df: DataFrame, by: Sequence[str], order, name: str = "rank") -> DataFrame:
    """Dense rank inside small groups (channels of a report, rows per model)."""
    return df.withColumn(name, F.dense_rank().over(Window.partitionBy(*by).orderBy(order)))
