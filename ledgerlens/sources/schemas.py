"""Explicit schemas of the reference-shaped tables and the class domain."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values of the class domain and the temporal split (must equal the
# analysed workload for equal results).
ILLICIT = 1
LICIT = 2
UNKNOWN = 3
CLASS_LABELS = {ILLICIT: "illicit", LICIT: "licit", UNKNOWN: "unknown"}
LABEL_ORDER = ["illicit", "licit", "unknown"]
N_TIME_STEPS = 49
TRAIN_CUTOFF = 34

TXS_CLASSES = T.StructType([
    T.StructField("txId", T.LongType()),
    T.StructField("class", T.IntegerType()),
])
TXS_EDGELIST = T.StructType([
    T.StructField("txId1", T.LongType()),
    T.StructField("txId2", T.LongType()),
])
WALLETS_CLASSES = T.StructType([
    T.StructField("address", T.StringType()),
    T.StructField("class", T.IntegerType()),
])
ADDR_ADDR = T.StructType([
    T.StructField("input_address", T.StringType()),
    T.StructField("output_address", T.StringType()),
])
ADDR_TX = T.StructType([
    T.StructField("input_address", T.StringType()),
    T.StructField("txId", T.LongType()),
])
TX_ADDR = T.StructType([
    T.StructField("txId", T.LongType()),
    T.StructField("output_address", T.StringType()),
])

# Name -> schema of every table the workload reads (features are caller-typed).
REFERENCE_TABLES = {
    "txs_classes": TXS_CLASSES,
    "txs_edgelist": TXS_EDGELIST,
    "wallets_classes": WALLETS_CLASSES,
    "addr_addr": ADDR_ADDR,
    "addr_tx": ADDR_TX,
    "tx_addr": TX_ADDR,
}


def features_schema(feature_cols: list[str], time_col: str = "time_step") -> T.StructType:
    """Schema of a transaction feature table: id, time step, double features."""
    return T.StructType(
        [T.StructField("txId", T.LongType()), T.StructField(time_col, T.IntegerType())]
        + [T.StructField(c, T.DoubleType()) for c in feature_cols])
