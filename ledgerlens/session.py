"""Session and shared-folder helpers.

Scratch output (CSV round trips, materialised intermediates) always goes under
the folder the cluster names in ``spark.checkpoint.dir``; a folder of our own is
only created for local sessions where nothing is configured (tests).
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def get_session(master: str | None = None, app: str = "ledgerlens",
                shuffle_partitions: int | None = None) -> SparkSession:
    builder = (SparkSession.builder.appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               .config("spark.sql.session.timeZone", "UTC"))
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session.

    Order: a directory already set on the context, then the
    ``spark.checkpoint.dir`` setting, then (local master only) a new folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or \
        spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerlens-ckpt-"))
        return sc.getCheckpointDir()
    raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder, removed when the driver's
    JVM ends."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/ledgerlens/{name}-{uuid.uuid4().hex}"
    _drop_at_exit(spark, path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet under the shared checkpoint folder and read
    back: lineage is cut, every reader sees the same rows, lost executors cost
    nothing, and Catalyst knows the real size.  The files go when the driver's
    JVM ends."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Parquet bytes of one partition of a ``compacted`` table (some 64 MB in memory).
PART_BYTES = 16 << 20


def compacted(df: DataFrame, name: str, spread_bytes: int | None = None) -> DataFrame:
    """``df`` stored, and read in partitions of about PART_BYTES by its measured
    size: one for a small table, many for a large one, whatever the number of
    shuffle partitions.  For tables that iterative estimators scan many times.

    With ``spread_bytes`` a table of more bytes is dealt out evenly, a partition for
    each that many but no more than there are cores, so that one executor does not
    hold it all; past PART_BYTES a core there are more partitions again."""
    out = stored(df, name)
    size = int(str(out._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    parts = max(1, -(-size // PART_BYTES))
    if spread_bytes:
        wide = min(-(-size // spread_bytes), df.sparkSession.sparkContext.defaultParallelism)
        if max(parts, wide) > 1:
            return out.repartition(max(parts, wide))
    return out.coalesce(parts)


def _drop_at_exit(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)


def rightsized(df: DataFrame) -> DataFrame:
    """``df`` rebalanced, so that no partition is much larger than the others.  AQE
    may still keep many small partitions of a small cached table; ``compacted``
    sizes them by the bytes measured."""
    return df.hint("rebalance")


@contextmanager
def persisted(df: DataFrame):
    """Persist ``df`` for the block (memory, spilling to disk) and release it after."""
    p = df.persist()
    try:
        yield p
    finally:
        p.unpersist()


def materialize(df: DataFrame) -> DataFrame:
    """Eagerly write ``df`` to the shared checkpoint folder and cut its lineage,
    so caches it depends on can be released (survives executor loss, unlike
    a local checkpoint)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
