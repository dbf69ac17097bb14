"""Wallet clustering: standardised behaviour features, k sweep by silhouette,
the best-k assignment, and a 2-D PCA projection.

The scaled table is persisted once for the whole sweep (each k-means fit and
each silhouette scans it several times) and released afterwards.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.models import SEED, assembler, scaler
from ledgerlens.session import rightsized

K_VALUES = (2, 3, 4, 5, 6)


def scaled(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """df with a standardised ``features`` vector (scaler fitted on df)."""
    return Pipeline(stages=[assembler(cols), scaler()]).fit(df).transform(df)


def kmeans_sweep(features: DataFrame, ks: Sequence[int] = K_VALUES, seed: int = SEED,
                 parallelism: int | None = None):
    """Fit k-means for each k; returns (table of (k, silhouette), {k: model}).

    The fits are independent, so they are submitted as concurrent Spark jobs
    (``parallelism`` threads, default one per k) over the persisted table."""
    owned = not features.is_cached
    if owned:
        features = rightsized(features).persist()

    def one(k):
        m = KMeans(featuresCol="features", k=k, seed=seed).fit(features)
        return k, m, float(ClusteringEvaluator(featuresCol="features").evaluate(m.transform(features)))

    try:
        with ThreadPoolExecutor(max_workers=parallelism or len(ks)) as pool:
            done = list(pool.map(one, ks))
    finally:
        if owned:
            features.unpersist()
    models = {k: m for k, m, _ in done}
    rows = [(k, s) for k, _, s in done]
    spark = features.sparkSession
    return spark.createDataFrame(rows, "k int, silhouette double"), models


def best_clustering(features: DataFrame, scores: DataFrame, models: dict) -> DataFrame:
    """Assign clusters with the model of the best silhouette (ties -> smaller k)."""
    best = scores.orderBy(F.desc("silhouette"), "k").first()["k"]
    return models[best].transform(features)


def pca_2d(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """keep + x, y: first two principal components of ``features``."""
    model = PCA(k=2, inputCol="features", outputCol="pca_features").fit(df)
    arr = vector_to_array(F.col("pca_features"))
    return model.transform(df).select(*keep, arr[0].alias("x"), arr[1].alias("y"))
