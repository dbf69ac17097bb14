"""Connected components of an edge list, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import stored


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One contraction of (a, b) edges with a > b.  Large: every larger neighbour
    of a node is linked to the node's least neighbour (or itself).  Small: every
    smaller neighbour, and the node, are linked to its least neighbour."""
    both = edges.union(edges.select("b", "a")).toDF("u", "v") if large else edges.toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
    joined = both.join(least, "u")
    if large:
        out = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.where(F.col("v") != F.col("m")).select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.toDF("a", "b"))
    return out.where(F.col("a") != F.col("b")).distinct()


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (two columns of one orderable
    type) but the roots themselves; the root is the least node of the component.

    Each round joins the edges with per-node minima that were pre-aggregated, so
    a hub is a skewed join at most; rounds are logarithmic in practice.  Every
    round is written to the shared folder, which cuts the lineage.
    """
    a, b = edges.columns
    now = stored(edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), "edges")
    size = _digest(now)
    for _ in range(most_rounds):
        if not size[0]:
            break
        now = stored(_stars(_stars(now, large=True), large=False), "edges")
        before, size = size, _digest(now)
        if size == before:
            break
    else:
        raise RuntimeError("components did not settle")
    return now.toDF("node", "root")


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.pmod(F.xxhash64("b", "a"), F.lit(1 << 31)))).first())
