"""Transaction-graph operators: degrees, hubs, neighbour profiles.

All are partial+final aggregations (map-side combine before the shuffle, so a
hub node collapses before it is shuffled) or lookups against the class table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.rules import class_label
from ledgerlens.operators.cases import neighbour_counts
from ledgerlens.operators.class_bitmap import classes_of
from ledgerlens.operators.profile import histogram
from ledgerlens.operators.sampling import smallest_hashes
from ledgerlens.sources.schemas import ILLICIT


def out_degree(edges: DataFrame) -> DataFrame:
    """txId, out_degree (multi-edges counted)."""
    return edges.groupBy(F.col("txId1").alias("txId")).agg(F.count(F.lit(1)).alias("out_degree"))


def in_degree(edges: DataFrame) -> DataFrame:
    """txId, in_degree."""
    return edges.groupBy(F.col("txId2").alias("txId")).agg(F.count(F.lit(1)).alias("in_degree"))


def total_degree(edges: DataFrame) -> DataFrame:
    """txId, degree = out + in; nodes without any edge are absent.

    Both ends come from one scan (explode of the pair), then one aggregation.
    """
    ends = edges.select(F.explode(F.array("txId1", "txId2")).alias("txId"))
    return ends.groupBy("txId").agg(F.count(F.lit(1)).alias("degree"))


def degree_stats(degrees: DataFrame, col: str = "degree") -> DataFrame:
    """nodes, max_degree, mean_degree, stdev_degree (population), 6 d.p."""
    return degrees.agg(F.count(F.lit(1)).alias("nodes"),
                       F.max(col).alias("max_degree"),
                       F.round(F.avg(col), 6).alias("mean_degree"),
                       F.round(F.stddev_pop(col), 6).alias("stdev_degree"))


def degree_sample(degrees: DataFrame, n: int = 50000, id_col: str = "txId", digits: int = 4, most: int = 100_000) -> DataFrame:
    """Up to n nodes without replacement, reproducible for any partitioning:
    the n smallest (md5 of id, id).  See ``sampling.smallest_hashes``."""
    return smallest_hashes(degrees, n, id_col, digits, most)


def degree_histogram(degrees: DataFrame, bins: int = 60, col: str = "degree") -> DataFrame:
    return histogram(degrees, col, bins)


def degree_distribution(edges: DataFrame) -> DataFrame:
    """direction ('in'/'out'), degree, nodes: how many nodes have each degree."""
    o = out_degree(edges).groupBy(F.col("out_degree").alias("degree")).agg(
        F.count(F.lit(1)).alias("nodes")).withColumn("direction", F.lit("out"))
    i = in_degree(edges).groupBy(F.col("in_degree").alias("degree")).agg(
        F.count(F.lit(1)).alias("nodes")).withColumn("direction", F.lit("in"))
    return o.unionByName(i).select("direction", "degree", "nodes")


def top_hubs(degrees: DataFrame, k: int = 20, col: str = "degree") -> DataFrame:
    """k nodes of highest degree, id breaks ties (TakeOrderedAndProject)."""
    return degrees.orderBy(F.desc(col), "txId").limit(k)


def label_hubs(hubs: DataFrame, classes: DataFrame) -> DataFrame:
    """txId, degree, label for the hubs (missing class -> unknown).

    The class table is first reduced to the k hub ids by a semi-join with the
    broadcast hub list (k rows), so the left join is small on both sides.
    """
    ids = F.broadcast(hubs.select("txId"))
    cls = classes.join(ids, "txId", "left_semi").select("txId", "class")
    return (hubs.join(cls, "txId", "left")
                .select("txId", "degree", class_label("class").alias("label"))
                .orderBy(F.desc("degree"), "txId"))


def hub_class_share(labelled_hubs: DataFrame) -> DataFrame:
    """label, hubs, total: how many of the top-k hubs carry each label ("5/20")."""
    from pyspark.sql import Window
    total = F.sum("hubs").over(Window.partitionBy().rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing))   # <= 3 rows
    return (labelled_hubs.groupBy("label").agg(F.count(F.lit(1)).alias("hubs"))
            .withColumn("total", total))


def edges_with_classes(edges: DataFrame, classes: DataFrame, bitmap: DataFrame | None = None) -> DataFrame:
    """txId1, txId2, c1, c2: class of both ends (missing -> null), by left joins or,
    with a ``class_bitmap``, without shuffling the edges."""
    if bitmap is not None:
        both = classes_of(classes_of(edges.select("txId1", "txId2"), "txId1", bitmap, "c1"), "txId2", bitmap, "c2")
        return both.select("txId1", "txId2", "c1", "c2")
    c1 = classes.select(F.col("txId").alias("txId1"), F.col("class").alias("c1"))
    c2 = classes.select(F.col("txId").alias("txId2"), F.col("class").alias("c2"))
    return edges.join(c1, "txId1", "left").join(c2, "txId2", "left").select(
        "txId1", "txId2", "c1", "c2")


def neighbour_profile(edges: DataFrame, classes: DataFrame, direction: str = "out") -> DataFrame:
    """txId1, c1, total_nb, illicit_nb, illicit_nb_ratio (4 d.p.) for every node
    with a neighbour.  Aggregated per node before the source class is attached."""
    return profile_from_counts(neighbour_counts(edges, classes, direction), classes)


def profile_from_counts(counts: DataFrame, classes: DataFrame) -> DataFrame:
    """``neighbour_profile`` from precomputed ``cases.neighbour_counts``."""
    c1 = classes.select(F.col("txId").alias("txId1"), F.col("class").alias("c1"))
    return (counts.join(c1, "txId1", "left")
                  .select("txId1", "c1", "total_nb", "illicit_nb",
                          F.round(F.try_divide(F.col("illicit_nb"), F.col("total_nb")), 4)
                           .alias("illicit_nb_ratio")))


def top_neighbour_ratio(profile: DataFrame, k: int = 500) -> DataFrame:
    """The k illicit nodes with the highest illicit-neighbour ratio (id tie-break)."""
    return (profile.where(F.col("c1") == ILLICIT)
                   .orderBy(F.desc("illicit_nb_ratio"), "txId1").limit(k))


def neighbour_ratio_histogram(profile: DataFrame, bins: int = 30) -> DataFrame:
    """Histogram of the illicit-neighbour ratio over all illicit nodes."""
    return histogram(profile.where(F.col("c1") == ILLICIT), "illicit_nb_ratio", bins)

