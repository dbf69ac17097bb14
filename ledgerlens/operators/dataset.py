"""Supervised-learning tables: labelled set, feature choice, temporal split,
deterministic stratified down-sampling, folds and DataFrame-form scaling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.rules import hash_bucket
from ledgerlens.sources.schemas import ILLICIT, LICIT, TRAIN_CUTOFF

META_COLUMNS = frozenset({"txId", "Time step", "time_step", "label_raw", "label", "class"})


def labelled_dataset(features: DataFrame, classes: DataFrame) -> DataFrame:
    """features ⋈ classes on txId, rows with any null dropped, classes 1/2 kept,
    ``label`` = 1 for illicit else 0 (int); the class code stays as label_raw."""
    cls = classes.select("txId", F.col("class").alias("label_raw"))
    return (features.join(cls, "txId")
                    .dropna()
                    .where(F.col("label_raw").isin(ILLICIT, LICIT))
                    .withColumn("label", (F.col("label_raw") == ILLICIT).cast("int")))


def fill_numeric(df: DataFrame, value: float = 0) -> DataFrame:
    """Replace nulls with ``value`` in numeric columns only (strings untouched)."""
    numeric = [f.name for f in df.schema.fields
               if f.dataType.typeName() in ("byte", "short", "integer", "long", "float",
                                            "double", "decimal")]
    return df.fillna(value, subset=numeric)


def feature_columns(df: DataFrame, meta: frozenset[str] = META_COLUMNS) -> list[str]:
    """All columns except identifiers, time step and labels, in table order."""
    return [c for c in df.columns if c not in meta]


def temporal_split(ds: DataFrame, cutoff: int = TRAIN_CUTOFF,
                   time_col: str = "time_step") -> tuple[DataFrame, DataFrame]:
    """(train = steps <= cutoff, test = steps > cutoff)."""
    return ds.where(F.col(time_col) <= cutoff), ds.where(F.col(time_col) > cutoff)


def split_column(ds: DataFrame, cutoff: int = TRAIN_CUTOFF, time_col: str = "time_step"):
    """The temporal split as a column: 'train' / 'test'."""
    return F.when(F.col(time_col) <= cutoff, F.lit("train")).otherwise(F.lit("test"))


SAMPLE_BUCKETS = 100


def stratified_sample(ds: DataFrame, fractions: Mapping[int, float], label_col: str = "label",
                      id_col: str = "txId", method: str = "hash", seed: int = 42) -> DataFrame:
    """Keep a ``fractions[label]`` share of each label; labels not listed are
    kept whole.  ``method='hash'`` picks rows by a hash of the id (the same rows
    for any partitioning or retry); ``'random'`` draws per row with a seed."""
    if method not in ("hash", "random"):
        raise ValueError(method)
    draw = F.rand(seed) if method == "random" else hash_bucket(id_col, SAMPLE_BUCKETS) / F.lit(float(SAMPLE_BUCKETS))
    keep = F.lit(True)
    for label, frac in fractions.items():
        keep = F.when(F.col(label_col) == label, draw < F.lit(float(frac))).otherwise(keep)
    return ds.where(keep)


def downsample_majority(ds: DataFrame, ratio: float = 1.0, label_col: str = "label",
                        id_col: str = "txId") -> DataFrame:
    """Keep every minority (label 1) row and about ``ratio`` x as many majority
    rows; the fraction comes from one scalar subquery, so the plan stays lazy."""
    counts = ds.agg(F.struct(F.count_if(F.col(label_col) == 1).alias("pos"),
                             F.count_if(F.col(label_col) == 0).alias("neg")).alias("s")).scalar()
    frac = F.least(F.lit(1.0), F.try_divide(counts.getField("pos") * ratio, counts.getField("neg")))
    bucket = hash_bucket(id_col, 10000)
    keep = (F.col(label_col) == 1) | (bucket < F.coalesce(frac, F.lit(1.0)) * 10000)
    return ds.where(keep)


def fold_column(id_col: str = "txId", folds: int = 5):
    """Deterministic CV fold from a hash of the id (independent of partitioning
    and of any structure in the ids)."""
    return hash_bucket(id_col, folds)


def standardise_columns(df: DataFrame, cols: Sequence[str], fit: DataFrame | None = None,
                        prefix: str = "") -> DataFrame:
    """(x - mean) / sample stddev per column, statistics taken from ``fit``
    (default: df) through one scalar subquery; zero variance gives 0."""
    fit = df if fit is None else fit
    stats = fit.agg(F.struct(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
                             *[F.stddev_samp(c).alias(f"s{i}") for i, c in enumerate(cols)])
                    .alias("s")).scalar()
    out = df.withColumn("_std_st", stats)       # the subquery once, fields by reference
    for i, c in enumerate(cols):
        m, s = F.col(f"_std_st.m{i}"), F.col(f"_std_st.s{i}")
        z = F.when(s > 0, (F.col(c) - m) / s).otherwise(F.lit(0.0))
        out = out.withColumn(f"{prefix}{c}", z)
    return out.drop("_std_st")
