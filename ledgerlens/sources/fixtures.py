"""Reference-shaped tables derived from the TPC-H-like test tables.

The analysed workload reads a transaction graph (classes, edges, time steps)
and a wallet graph (classes, wallet->tx, tx->wallet, wallet->wallet).  These
functions derive tables of exactly that shape from ``orders``, ``lineitem``,
``customer``, ``documents`` and ``labels`` so every query's work grows with the
given tables.  The DuckDB twins of these definitions live in
``ledgerlens.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.ordering import next_in_group
from ledgerlens.sources.schemas import ILLICIT, LICIT, N_TIME_STEPS, UNKNOWN

# Fixed values of the derivation (shared with the oracle SQL).
STEP_EPOCH = "1995-01-01"    # first order date
STEP_SPAN_DAYS = 2405        # days covered by the order dates
RECEIVE_ONLY_EVERY = 4       # every 4th supplier is an 'S' wallet (receives only)
PUNCT_CLASS = r"[!-/:-@\[-`{-~]"   # ASCII punctuation


def tx_classes(orders: DataFrame) -> DataFrame:
    """txId, class: F -> 1 (illicit), O -> 2 (licit), P -> 3."""
    status = F.col("o_orderstatus")
    cls = (F.when(status == "F", F.lit(ILLICIT))
            .when(status == "O", F.lit(LICIT))
            .otherwise(F.lit(UNKNOWN)))
    return orders.select(F.col("o_orderkey").alias("txId"), cls.cast("int").alias("class"))


def tx_edges(lineitem: DataFrame) -> DataFrame:
    """txId1 -> txId2: an order points to the next order shipping the same part,
    distinct, no self-edges."""
    nxt = next_in_group(lineitem, "l_partkey", ["l_shipdate", "l_orderkey", "l_linenumber"], "l_orderkey",
                        coarse=F.trunc(F.col("l_shipdate").cast("date"), "month"), name="b")
    return (nxt.where(F.col("l_orderkey") != F.col("b"))
               .select(F.col("l_orderkey").alias("txId1"), F.col("b").alias("txId2"))
               .distinct())


def tx_steps(orders: DataFrame) -> DataFrame:
    """txId, time_step 1..49 from the order date."""
    days = F.datediff(F.col("o_orderdate"), F.to_date(F.lit(STEP_EPOCH)))
    step = (F.lit(1) + F.floor(days * N_TIME_STEPS / STEP_SPAN_DAYS)).cast("int")
    return orders.select(F.col("o_orderkey").alias("txId"), step.alias("time_step"))


def wallet_classes(customer: DataFrame) -> DataFrame:
    """address 'W<custkey>', class from market segment (the 'S' wallets of
    ``tx_addr`` have none)."""
    seg = F.col("c_mktsegment")
    cls = (F.when(seg == "BUILDING", F.lit(ILLICIT))
            .when(seg.isin("AUTOMOBILE", "FURNITURE"), F.lit(LICIT))
            .otherwise(F.lit(UNKNOWN)))
    return customer.select(F.concat(F.lit("W"), F.col("c_custkey").cast("string")).alias("address"),
                           cls.cast("int").alias("class"))


def addr_tx(orders: DataFrame) -> DataFrame:
    """input_address -> txId (the ordering customer's wallet)."""
    return orders.select(F.concat(F.lit("W"), F.col("o_custkey").cast("string")).alias("input_address"),
                         F.col("o_orderkey").alias("txId"))


def tx_addr(lineitem: DataFrame) -> DataFrame:
    """txId -> output_address (the supplier's wallet; every 4th is receive-only 'S')."""
    prefix = F.when(F.col("l_suppkey") % RECEIVE_ONLY_EVERY == 0, F.lit("S")).otherwise(F.lit("W"))
    return lineitem.select(F.col("l_orderkey").alias("txId"),
                           F.concat(prefix, F.col("l_suppkey").cast("string")).alias("output_address"))


def addr_addr(addr_tx_df: DataFrame, tx_addr_df: DataFrame) -> DataFrame:
    """input_address -> output_address through a shared transaction (multi-edges kept)."""
    return addr_tx_df.join(tx_addr_df, "txId").select("input_address", "output_address")


def doc_features(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """A txs_features-shaped table with a learnable, imbalanced class.

    quality 0 -> class 1 (illicit), quality 1 -> class 2, unlabelled -> class 3.
    Returns txId, time_step, class, f_chars, f_words, f_digit_ratio,
    f_punct_ratio, f_distinct_ratio.
    """
    pieces = F.split(F.col("text"), " ")
    n_chars = F.col("n_chars")
    # counting matches avoids building a filtered copy of every text
    digits = F.regexp_count(F.col("text"), F.lit("[0-9]"))
    punct = F.regexp_count(F.col("text"), F.lit(PUNCT_CLASS))
    digit_ratio = F.round(F.try_divide(digits, n_chars), 6)
    cls = (F.when(F.col("quality") == 0, F.lit(ILLICIT))
            .when(F.col("quality") == 1, F.lit(LICIT))
            .otherwise(F.lit(UNKNOWN)))
    # text -> a few numbers inside the scan tasks; only those meet the labels,
    # so no document text is ever shuffled for the join
    feats = documents.select(
        "doc_id",
        n_chars.cast("double").alias("f_chars"),
        F.size(pieces).cast("double").alias("f_words"),
        digit_ratio.alias("f_digit_ratio"),
        F.round(F.try_divide(punct, n_chars), 6).alias("f_punct_ratio"),
        F.round(F.size(F.array_distinct(pieces)) / F.size(pieces), 6).alias("f_distinct_ratio"))
    lab = labels.select("doc_id", "quality")
    return (feats.join(lab, "doc_id", "left")
            .select(F.col("doc_id").alias("txId"),
                    (F.lit(1) + F.col("doc_id") % N_TIME_STEPS).cast("int").alias("time_step"),
                    cls.cast("int").alias("class"), *DOC_FEATURE_COLS))


DOC_FEATURE_COLS = ["f_chars", "f_words", "f_digit_ratio", "f_punct_ratio", "f_distinct_ratio"]
