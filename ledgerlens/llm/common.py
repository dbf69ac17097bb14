"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.session import stored  # noqa: F401  (the operators take it from here)

#: A word, as every contract of this package defines it.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows, and bytes as Catalyst counts them (a written table: its files), up to which a
#: per-source or per-item table may be broadcast; both must hold.
BROADCAST_ROWS, BROADCAST_BYTES = 100_000, 32 << 20


def workers_find_package(spark: SparkSession) -> None:
    """Put this checkout on the Python path of the workers, for sessions started
    without it there (``--py-files`` or an installed package do the same)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in (paths := env.get("PYTHONPATH", "").split(os.pathsep)):
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fits(df: DataFrame, rows: int, limit: int | None = None) -> bool:
    """Whether ``df`` (read from a written table, of ``rows`` counted rows) may be broadcast."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return rows <= (BROADCAST_ROWS if limit is None else limit) and size <= BROADCAST_BYTES


def small_side(df: DataFrame, rows: int, limit: int | None = None) -> DataFrame:
    """``df`` with a broadcast hint if its counted ``rows`` and its bytes are within
    the limits; beyond them the join is left to Catalyst (shuffle join, AQE skew
    splitting)."""
    return F.broadcast(df) if fits(df, rows, limit) else df


def shield(docs: DataFrame, *cols: str) -> tuple[DataFrame, list[str], list]:
    """``docs`` with neutral column names, so that none can clash with an
    operator's own; the neutral names of ``cols``; and the columns that restore
    the old names."""
    inner = {c: f"c{i}__" for i, c in enumerate(docs.columns)}
    return (docs.select(*[F.col(f"`{c}`").alias(n) for c, n in inner.items()]), [inner[c] for c in cols],
            [F.col(n).alias(c) for c, n in inner.items()])


#: Salts that deal a hot key's rows out where a lookup table is too large to broadcast.
SALTS = 32


def lookup(left: DataFrame, right: DataFrame, left_key: str, right_key: str, rows: int, spread: list[str]) -> DataFrame:
    """``left`` with the columns of ``right`` (one row per key) where the keys
    agree, null included.  ``rows``: counted rows of ``right``; within the limits of
    ``fits`` it is broadcast, beyond that a hot key's rows are dealt over SALTS keys
    by the hash of the ``spread`` columns."""
    same = F.col(left_key).eqNullSafe(F.col(right_key))
    if fits(right, rows):
        return left.join(F.broadcast(right), same, "left")
    salted = right.withColumn("__salt2", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = left.withColumn("__salt1", F.pmod(F.xxhash64(*spread), F.lit(SALTS)).cast("int"))
    return dealt.join(salted, same & (F.col("__salt1") == F.col("__salt2")), "left").drop("__salt1", "__salt2")


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def text_buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and int64 offsets of an Arrow string column (null: empty)."""
    import pyarrow as pa

    wide = pa.types.is_large_string(column.type)
    off = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    off = off[column.offset:column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    data = column.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[off[0]:off[-1]], off - off[0]


def word_spans(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word of concatenated texts, and the index of
    each text's first word (one entry more than there are texts)."""
    n = len(buf)
    if not n:
        e = np.zeros(0, np.int64)
        return e, e, np.zeros(len(off), np.int64)
    black = ~_SPACE[buf]
    first, last = black.copy(), black.copy()
    first[1:] &= ~black[:-1]
    last[:-1] &= ~black[1:]
    cut = off[(off > 0) & (off < n)]
    first[cut] = black[cut]
    last[cut - 1] = black[cut - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, off)


def slices(off: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Consecutive ranges of texts of at most ``most`` bytes together (a longer
    text is a range of its own)."""
    out, a, n = [], 0, len(off) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + most, "right")) - 1)
        out.append((a, min(b, n)))
        a = out[-1][1]
    return out


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift and multiply)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
