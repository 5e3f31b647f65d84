"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courier.sources.scratch import materialise


def _stars(edges: DataFrame) -> DataFrame:
    """One round: every node hangs its larger, then its smaller neighbours on its smallest.

    The smallest neighbour is a partial aggregate and is joined back, so a node with
    any number of neighbours never meets in one task.
    """
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    large = (
        both.where("v > u")
        .join(least, "u")
        .select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
        .where("u <> v")
        .distinct()
    )
    low = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(low, "u").select(
        F.explode(
            F.array(
                F.struct(F.col("u"), F.col("m").alias("v")),
                F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            )
        ).alias("e")
    )
    return small.select("e.u", "e.v").where("u <> v").distinct()


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node, root`` for every linked node: the smallest node it can reach.

    ``links`` holds bigint pairs, in any direction and with repeats.  Null ends and
    self-links are passed over.  A root appears as its own node.  No links give no rows.
    Each round is written to the shared scratch folder, which cuts the lineage.
    """
    pair = links.select(F.col(a).cast("bigint").alias("u"), F.col(b).cast("bigint").alias("v"))
    edges = pair.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = materialise(
        edges.where(pair.u.isNotNull() & pair.v.isNotNull()).where("u <> v").distinct(), "links"
    )
    state = _state(edges)
    while state[0]:
        edges = materialise(_stars(edges), "stars")
        after = _state(edges)
        if after == state:
            break
        state = after
    roots = edges.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _state(edges: DataFrame) -> tuple:
    """Number of edges and an order-free hash of them."""
    return tuple(
        edges.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
    )
