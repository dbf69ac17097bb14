"""Samples of an exact size that are the same for any partitioning or retry."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def smallest_hashes(df: DataFrame, n: int, id_col: str = "txId", digits: int = 4, most: int = 100_000) -> DataFrame:
    """The n rows with the smallest (md5 of id, id); all rows if there are fewer.

    A histogram of the first md5 digits finds the bucket in which the n-th row
    lies (16^digits counts at most, one row to the driver); while that bucket holds
    more than ``most`` rows, its next digits are counted.  All rows before it are
    taken by comparing the md5, and only its own rows are ordered.  Runs one job per
    histogram when called.  The ids should be unique: rows with equal ids are
    cut arbitrarily at the n-th place.
    """
    if n <= 0:
        return df.where(F.lit(False))
    keyed = df.withColumn("_md5", F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    bucket, left, width = "", n, 0
    while width < 32:
        width = min(32, width + digits)
        inside = keyed.where(F.col("_md5").startswith(bucket)) if bucket else keyed
        counts = inside.groupBy(F.substring("_md5", 1, width).alias("b")).agg(F.count(F.lit(1)).alias("c"))
        upto = F.sum("c").over(Window.orderBy("b"))          # one row per bucket
        cut = counts.withColumn("u", upto).where(F.col("u") >= left).orderBy("b").limit(1).first()
        if cut is None:                                      # fewer rows than asked for
            return df
        bucket, left = cut.b, left - (cut.u - cut.c)
        if cut.c <= most:
            break
    before = keyed.where(F.col("_md5") < bucket)
    rank = F.row_number().over(Window.partitionBy(F.substring("_md5", 1, width)).orderBy("_md5", id_col))   # one bucket
    edge = keyed.where(F.col("_md5").startswith(bucket)).withColumn("_rn", rank).where(F.col("_rn") <= left).drop("_rn")
    return before.unionByName(edge).drop("_md5")


def exact_strata(ds: DataFrame, sizes: Mapping[int, int], label_col: str = "label", id_col: str = "txId", **options) -> DataFrame:
    """``sizes[label]`` rows of each label named (all, if fewer), those with the
    smallest hashes of the id; labels not named, null among them, are kept whole."""
    named = F.coalesce(F.col(label_col).isin(list(sizes)), F.lit(False))
    out = ds.where(~named)
    for label, n in sizes.items():
        out = out.unionByName(smallest_hashes(ds.where(F.col(label_col) == label), n, id_col, **options))
    return out


def balanced(ds: DataFrame, ratio: float = 1.0, label_col: str = "label", id_col: str = "txId", **options) -> DataFrame:
    """Every minority row (label 1) and exactly round(``ratio`` x as many) majority
    rows (label 0; all, if fewer).  Counts the labels when called."""
    minority = ds.agg(F.count_if(F.col(label_col) == 1)).first()[0]
    return exact_strata(ds, {0: round(minority * ratio)}, label_col, id_col, **options)
