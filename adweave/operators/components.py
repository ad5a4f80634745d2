"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adweave.session import cut_lineage


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def connected_components(nodes: DataFrame, edges: DataFrame, node_id: str = "record_id", max_rounds: int = 50) -> DataFrame:
    """(node_id, resolved_id) with the smallest id of each component; isolated nodes keep their own.

    Each round replaces edges by edges to smaller neighbours, which flattens chains in a logarithmic number
    of rounds. Per-node minima are partial aggregates; the join back has one row per node on one side, so
    an adaptive plan can split the partition of a hub. Every round is checkpointed.
    """
    lower = F.least("i", "j").alias("dst")
    upper = F.greatest("i", "j").alias("src")
    current = cut_lineage(edges.select(upper, lower).where("src <> dst").distinct())
    before = _signature(current)
    for _ in range(max_rounds):
        # large star: every larger neighbour of a node is tied to the smallest of the node's neighbourhood
        both = current.unionByName(current.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        least = both.groupBy("src").agg(F.min("dst").alias("low")).withColumn("low", F.least("low", "src"))
        large = both.where("dst > src").join(least, "src").select(F.col("dst").alias("src"), F.col("low").alias("dst")).distinct()
        # small star: a node and its smaller neighbours are tied to the smallest of them
        least = large.groupBy("src").agg(F.min("dst").alias("low"))
        tied = large.join(least, "src")
        small = (
            tied.select(F.explode(F.array("src", "dst")).alias("src"), F.col("low").alias("dst")).where("src <> dst").distinct()
        )
        current = cut_lineage(small)
        after = _signature(current)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return (
        nodes.select(node_id)
        .join(current.select(F.col("src").alias(node_id), F.col("dst").alias("_low")), node_id, "left")
        .select(node_id, F.coalesce("_low", node_id).alias("resolved_id"))
    )
