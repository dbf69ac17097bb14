"""Load a labelled transaction-graph dataset laid out as header CSV files.

File names and headers follow the dataset the analysed script reads (fixed
values below).  Every table gets an explicit schema; the transaction feature
file is read by header, its ``Time step`` column renamed to ``time_step`` and
every other column cast to double, so no inference pass runs over the data.

``CsvTables`` exposes the same attributes as ``plans.tables.Tables``
(tx_classes, tx_edges, tx_steps, wallet_classes, addr_tx, tx_addr, addr_addr,
txs_features, doc_classes), so the operators and the report run on either.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.sources import schemas
from ledgerlens.sources.catalog import Quarantined, read_optional, read_quarantined, read_table, strict_cast

# File names of the dataset layout.
FILES = {
    "tx_classes": "txs_classes.csv",
    "tx_edges": "txs_edgelist.csv",
    "txs_features": "txs_features.csv",
    "wallet_classes": "wallets_classes.csv",
    "addr_addr": "AddrAddr_edgelist.csv",
    "addr_tx": "AddrTx_edgelist.csv",
    "tx_addr": "TxAddr_edgelist.csv",
    "wallets_features": "wallets_features.csv",
    "wallets_features_combined": "wallets_features_classes_combined.csv",
}
OPTIONAL_WALLET_TABLES = ("wallets_features", "wallets_features_combined")
TIME_STEP_HEADER = "Time step"


class CsvTables:
    """``quarantine``: set malformed rows aside instead of failing; ``set_aside`` then
    holds the rejected rows and counts per file of every table read so far."""

    def __init__(self, spark: SparkSession, base_dir: str, quarantine: bool = False):
        self.spark = spark
        self.base = base_dir.rstrip("/")
        self.quarantine = quarantine
        self.set_aside: dict[str, Quarantined] = {}

    def _path(self, key: str) -> str:
        return f"{self.base}/{FILES[key]}"

    def _csv(self, key: str, schema) -> DataFrame:
        if self.quarantine:
            self.set_aside[key] = read_quarantined(self.spark, self._path(key), schema)
            return self.set_aside[key].rows
        return read_table(self.spark, self._path(key), schema, fmt="csv")

    @cached_property
    def tx_classes(self) -> DataFrame:
        return self._csv("tx_classes", schemas.TXS_CLASSES)

    @cached_property
    def tx_edges(self) -> DataFrame:
        return self._csv("tx_edges", schemas.TXS_EDGELIST)

    @cached_property
    def wallet_classes(self) -> DataFrame:
        return self._csv("wallet_classes", schemas.WALLETS_CLASSES)

    @cached_property
    def addr_addr(self) -> DataFrame:
        return self._csv("addr_addr", schemas.ADDR_ADDR)

    @cached_property
    def addr_tx(self) -> DataFrame:
        return self._csv("addr_tx", schemas.ADDR_TX)

    @cached_property
    def tx_addr(self) -> DataFrame:
        return self._csv("tx_addr", schemas.TX_ADDR)

    @cached_property
    def txs_features(self) -> DataFrame | None:
        """txId, time_step, every feature as double; None when the file is absent."""
        raw = read_optional(self.spark, self._path("txs_features"), fmt="csv")
        if raw is None:
            return None
        if self.quarantine:
            kinds = {"txId": T.LongType(), TIME_STEP_HEADER: T.IntegerType()}
            rows = self._csv("txs_features", T.StructType([T.StructField(c, kinds.get(c, T.DoubleType())) for c in raw.columns]))
            return rows.withColumnRenamed(TIME_STEP_HEADER, "time_step")
        cols = []
        for c in raw.columns:
            src = F.col(f"`{c}`")
            if c == "txId":
                cols.append(strict_cast(src, "bigint", "txId"))
            elif c == TIME_STEP_HEADER:
                cols.append(strict_cast(src, "int", "time_step"))
            else:
                cols.append(strict_cast(src, "double", c))
        return raw.select(*cols)

    def _wallet_table(self, key: str) -> DataFrame | None:
        """address as it is, every other column as double; None when absent."""
        raw = read_optional(self.spark, self._path(key), fmt="csv")
        if raw is None:
            return None
        if self.quarantine:
            return self._csv(key, T.StructType([T.StructField(c, T.StringType() if c == "address" else T.DoubleType()) for c in raw.columns]))
        return raw.select(*[F.col("address") if c == "address" else strict_cast(F.col(f"`{c}`"), "double", c) for c in raw.columns])

    @cached_property
    def wallets_features(self) -> DataFrame | None:
        return self._wallet_table("wallets_features")

    @cached_property
    def wallets_features_combined(self) -> DataFrame | None:
        return self._wallet_table("wallets_features_combined")

    @cached_property
    def tx_steps(self) -> DataFrame | None:
        f = self.txs_features
        return None if f is None else f.select("txId", "time_step")

    @cached_property
    def doc_classes(self) -> DataFrame:
        """Classes of the feature rows (the transaction classes)."""
        return self.tx_classes

    def reference_tables(self) -> dict[str, DataFrame]:
        out = {"txs_classes": self.tx_classes, "txs_edgelist": self.tx_edges,
               "wallets_classes": self.wallet_classes, "addr_addr": self.addr_addr,
               "addr_tx": self.addr_tx, "tx_addr": self.tx_addr}
        if self.txs_features is not None:
            out["txs_features"] = self.txs_features
        for key in OPTIONAL_WALLET_TABLES:
            if getattr(self, key) is not None:
                out[key] = getattr(self, key)
        return out
