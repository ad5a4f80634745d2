"""Running sums over an order that no single task has to hold.

Rows are dealt to tasks by ranges of (group, order), so a range may begin or end inside a group, inside a day, or
inside a run of equal values. Sums run inside (group, range); what earlier ranges of the same group add comes from a
table with one row per group and range, worked out by Spark. The dealt rows are written once, so a task that runs again
sees the same ranges.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adweave.session import cut_lineage

BLOCK_HALF_LIVES = 200  # a decaying sum is scaled to the start of a block; 2^200 is far from the ends of a double
FAR_BLOCKS = 6  # what lies 1,200 half-lives back is zero in a double


def _group(by: Sequence[str]) -> Column:
    """The group as one value that equals itself whatever is null in it."""
    return F.struct(*by) if by else F.lit(0)


def running(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[Column],
    sums: Mapping[str, Column],
    decays: Mapping[str, Column] | None = None,
    time: str | None = None,
    half_life: float | None = None,
    following: Mapping[str, tuple[str, bool]] | None = None,
    totals: bool = False,
) -> DataFrame:
    """Adds the inclusive running value of each of ``sums`` and ``decays`` per group ``by`` in ``order``.

    ``order`` ends with columns that are unique within a group (rows that agree in all of it get their sums in any
    order). A null summand counts 0. A decaying sum halves every ``half_life`` of ``time``, which leads the order, ascending; it
    is as of the row's own time, over any span of time. ``following`` names columns for the value in the next row of the
    group: name: (column, whether it is the largest of the rows after, else the smallest), for a column that leads the
    order. With ``totals`` there is ``<name>_all`` for each sum, its total in the group. Any number of groups, of any size.
    """
    by, decays, following = list(by), dict(decays or {}), dict(following or {})
    width = BLOCK_HALF_LIVES * half_life if decays else None
    block = F.floor(F.col(time) / F.lit(width)).cast("long") if decays else F.lit(0).cast("long")
    age = (F.col(time) - F.col("_scan_block") * F.lit(width)) / F.lit(half_life) if decays else F.lit(0.0)  # half-lives since the block began
    marked = df.select("*", _group(by).alias("_scan_group"), block.alias("_scan_block"), *[e.alias(f"_v_{n}") for n, e in sums.items()])
    marked = marked.select("*", *[(e * F.pow(F.lit(2.0), age)).alias(f"_v_{n}") for n, e in decays.items()])
    dealt = cut_lineage(marked.repartitionByRange("_scan_group", *order).withColumn("_scan_range", F.spark_partition_id()))

    segment = ["_scan_group", "_scan_block", "_scan_range"]
    names = [*sums, *decays]
    edge = {n: (F.max if largest else F.min)(c) for n, (c, largest) in following.items()}
    parts = dealt.groupBy(*segment).agg(*[F.sum(f"_v_{n}").alias(f"_s_{n}") for n in names], *[e.alias(f"_e_{n}") for n, e in edge.items()], F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy("_scan_group").orderBy("_scan_block", "_scan_range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("_scan_group")
    in_block = Window.partitionBy("_scan_group", "_scan_block").orderBy("_scan_range").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0)
    carried = parts.select(
        *segment,
        *[F.coalesce(F.sum(f"_s_{n}").over(before), zero).alias(f"_c_{n}") for n in sums],
        *[F.coalesce(F.sum(f"_s_{n}").over(in_block), F.lit(0.0)).alias(f"_c_{n}") for n in decays],
        *([F.coalesce(F.sum(f"_s_{n}").over(whole), zero).alias(f"{n}_all") for n in sums] if totals else []),
        *[F.lead(f"_e_{n}").over(Window.partitionBy("_scan_group").orderBy("_scan_block", "_scan_range")).alias(f"_e_{n}") for n in following],
    )
    if decays:
        blocks = parts.groupBy("_scan_group", "_scan_block").agg(F.struct(*[F.coalesce(F.sum(f"_s_{n}"), F.lit(0.0)).alias(n) for n in decays]).alias("_u"))
        far = Window.partitionBy("_scan_group").orderBy("_scan_block").rangeBetween(-FAR_BLOCKS, -1)
        earlier = blocks.select("_scan_group", "_scan_block", F.collect_list(F.struct("_scan_block", "_u")).over(far).alias("_u"))

        def faded(n: str) -> Column:
            add = lambda total, x: total + x["_u"][n] * F.pow(F.lit(2.0), (x["_scan_block"] - F.col("_scan_block")) * F.lit(float(BLOCK_HALF_LIVES)))
            return F.aggregate("_u", F.lit(0.0), add)

        carried = carried.join(earlier.hint("merge"), ["_scan_group", "_scan_block"]).withColumns({f"_c_{n}": F.col(f"_c_{n}") + faded(n) for n in decays}).drop("_u")

    inside = Window.partitionBy(*segment).orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = dealt.select(
        "*", *[F.coalesce(F.sum(f"_v_{n}").over(upto), zero).alias(f"_r_{n}") for n in names], *[F.lead(c).over(inside).alias(f"_l_{n}") for n, (c, _) in following.items()]
    )
    joined = run.join(carried.hint("merge"), segment)  # dealt by segment already; sizes guessed from compressed files would broadcast it
    return joined.select(
        *df.columns,
        *[(F.col(f"_r_{n}") + F.col(f"_c_{n}")).alias(n) for n in sums],
        *[((F.col(f"_r_{n}") + F.col(f"_c_{n}")) * F.pow(F.lit(2.0), -age)).alias(n) for n in decays],
        *([f"{n}_all" for n in sums] if totals else []),
        *[F.coalesce(f"_l_{n}", f"_e_{n}").alias(n) for n in following],
    )
