"""Class labels, class counts, imbalance and the side-by-side distribution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.rules import class_label
from ledgerlens.sources.schemas import LABEL_ORDER


def labelled(df: DataFrame, class_col: str = "class") -> DataFrame:
    """Add ``label`` (illicit / licit / unknown) from the class code."""
    return df.withColumn("label", class_label(class_col))


def class_counts(df: DataFrame, class_col: str = "class") -> DataFrame:
    """label, count; most frequent first (partial aggregation, 3 groups)."""
    return (df.groupBy(class_label(class_col).alias("label"))
              .agg(F.count(F.lit(1)).alias("count"))
              .orderBy(F.desc("count"), "label"))


def class_imbalance(df: DataFrame, class_col: str = "class") -> DataFrame:
    """illicit, licit, illicit_pct of labelled (2 d.p.), licit_to_illicit (1 d.p.).

    The ratio divides by max(illicit, 1) as analysed; the percentage is null
    when nothing is labelled (no division by zero under ANSI).
    """
    lab = class_label(class_col)
    counts = df.agg(F.count_if(lab == "illicit").alias("illicit"),
                    F.count_if(lab == "licit").alias("licit"))
    return counts.select(
        "illicit", "licit",
        F.round(F.try_divide(F.col("illicit") * 100.0, F.col("illicit") + F.col("licit")), 2)
         .alias("illicit_pct"),
        F.round(F.col("licit") / F.greatest(F.col("illicit"), F.lit(1)), 1).alias("licit_to_illicit"))


def class_distribution(txs: DataFrame, wallets: DataFrame, class_col: str = "class") -> DataFrame:
    """class, tx_count, tx_pct, wallet_count, wallet_pct for the three labels.

    A label absent from a table gets count 0 (the 3-row label frame drives
    the left joins; both count tables have at most 3 rows).
    """
    spark = txs.sparkSession

    def shares(df, prefix):
        c = df.groupBy(class_label(class_col).alias("class")).agg(
            F.count(F.lit(1)).alias(f"{prefix}_count"))
        total = F.sum(f"{prefix}_count").over(_all_rows())
        return c.withColumn(f"{prefix}_pct", F.round(F.col(f"{prefix}_count") * 100.0 / total, 2))

    frame = spark.createDataFrame([(lbl,) for lbl in LABEL_ORDER], "class string")
    out = (frame.join(F.broadcast(shares(txs, "tx")), "class", "left")
                .join(F.broadcast(shares(wallets, "wallet")), "class", "left"))
    return out.select(
        "class",
        F.coalesce("tx_count", F.lit(0)).alias("tx_count"),
        F.coalesce("tx_pct", F.lit(0.0)).alias("tx_pct"),
        F.coalesce("wallet_count", F.lit(0)).alias("wallet_count"),
        F.coalesce("wallet_pct", F.lit(0.0)).alias("wallet_pct")).orderBy("class")


def _all_rows():
    from pyspark.sql import Window
    # used only over the <= 3 label rows of a count table
    return Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
