"""Fraud models on Spark ML: assemble -> standardise -> classify, temporal
hold-out, cross-validation with deterministic folds, and result tables.

Differences from the analysed script, on purpose: each estimator gets its own
cross-validation (not the forest twice), models are scored on held-out steps
(not on their own training rows), and the scaler is fitted inside each fold.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from threading import Lock

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.rules import feature_group
from ledgerlens.operators import metrics
from ledgerlens.operators.dataset import fold_column
from ledgerlens.session import compacted, rightsized, scratch_path

# Fixed values of the analysed model set-up.
RF_TREES, RF_DEPTH, SEED = 100, 10, 42
LR_MAX_ITER, LR_REG = 100, 0.01
GRID_TREES, GRID_DEPTHS = (50, 100), (5, 10)
# Ours: the analysed script never tunes the logistic regression.
GRID_REGS = (0.001, LR_REG, 0.1)
N_FOLDS = 5
#: Parquet bytes of the training table (some 20,000 rows of five features) worth a task
#: of their own: a forest's pass over them takes a second.
FOLD_BYTES = 512 << 10


def assembler(cols: Sequence[str], out: str = "features_raw") -> VectorAssembler:
    """Numeric columns -> vector; rows with null/NaN features are skipped."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="skip")


def scaler(inp: str = "features_raw", out: str = "features") -> StandardScaler:
    """Mean 0, sample stddev 1 (zero variance -> 0)."""
    return StandardScaler(inputCol=inp, outputCol=out, withMean=True, withStd=True)


def standardise(train: DataFrame, df: DataFrame, cols: Sequence[str], keep: Sequence[str] = (),
                prefix: str = "z_", digits: int | None = None) -> DataFrame:
    """Fit the scaler on ``train`` only and return ``keep`` + one standardised
    column per feature for every row of ``df``."""
    pipe = Pipeline(stages=[assembler(cols), scaler()]).fit(train)
    arr = vector_to_array(F.col("features"))
    zs = [arr[i] if digits is None else F.round(arr[i], digits) for i in range(len(cols))]
    return pipe.transform(df).select(*keep, *[z.alias(f"{prefix}{c}") for z, c in zip(zs, cols)])


def forest(num_trees: int = RF_TREES, max_depth: int = RF_DEPTH, seed: int = SEED):
    return RandomForestClassifier(featuresCol="features", labelCol="label",
                                  numTrees=num_trees, maxDepth=max_depth, seed=seed)


def logistic(max_iter: int = LR_MAX_ITER, reg: float = LR_REG):
    return LogisticRegression(featuresCol="features", labelCol="label",
                              maxIter=max_iter, regParam=reg)


def fraud_estimator(clf, cols: Sequence[str]) -> Pipeline:
    """assemble -> scale -> classify; inside CV the scaler is refitted per fold."""
    return Pipeline(stages=[assembler(cols), scaler(), clf])


def fit(train: DataFrame, clf, cols: Sequence[str]) -> PipelineModel:
    return fraud_estimator(clf, cols).fit(train)


def fit_many(train: DataFrame, classifiers: dict, cols: Sequence[str]) -> dict[str, PipelineModel]:
    """Fit several pipelines on the same (persisted) training table as
    concurrent Spark jobs; returns name -> fitted pipeline."""
    owned = not train.is_cached
    if owned:
        train = rightsized(train).persist()
    try:
        with ThreadPoolExecutor(max_workers=len(classifiers)) as pool:
            futures = {n: pool.submit(fit, train, clf, cols) for n, clf in classifiers.items()}
            return {n: f.result() for n, f in futures.items()}
    finally:
        if owned:
            train.unpersist()


def score_column(pred: DataFrame) -> DataFrame:
    """Add ``score`` = probability of label 1 (a double, JVM-side)."""
    return pred.withColumn("score", vector_to_array(F.col("probability"))[1])


def predictions(model: PipelineModel, df: DataFrame, id_col: str = "txId") -> DataFrame:
    """id, label, prediction (int), score for every scorable row."""
    pred = score_column(model.transform(df))
    return pred.select(id_col, "label", F.col("prediction").cast("int").alias("prediction"),
                       "score")


def rule_scored(ds: DataFrame, score_col: str, threshold: float, id_col: str = "txId") -> DataFrame:
    """A fixed score/prediction from one feature (metric checks without a model)."""
    s = F.col(score_col).cast("double")
    return ds.select(id_col, "label", s.alias("score"),
                     (s > threshold).cast("double").alias("prediction"))


def param_grid(clf, **values):
    """Grid over the named parameters of ``clf``; without any, the default grid
    of a forest (trees x depth) or a logistic regression (regularisation)."""
    if not values:
        values = ({"numTrees": GRID_TREES, "maxDepth": GRID_DEPTHS} if isinstance(clf, RandomForestClassifier)
                  else {"regParam": GRID_REGS})
    grid = ParamGridBuilder()
    for name, choices in values.items():
        grid = grid.addGrid(clf.getParam(name), list(choices))
    return grid.build()


@dataclass(frozen=True)
class GridResult:
    """The winner, refitted on all training rows, and the mean AUC-PR of each grid point."""

    bestModel: PipelineModel
    avgMetrics: list[float]


def _featurised(data: DataFrame, prepare: Sequence, fold: int) -> tuple[DataFrame, DataFrame]:
    """Training and validation rows (label, features) of one fold, persisted; the
    feature stages are fitted on the training rows only."""
    held = F.col("_fold") == fold
    made = Pipeline(stages=list(prepare)).fit(data.where(~held))
    train, valid = (made.transform(data.where(side)).select("label", "features").persist() for side in (~held, held))
    return train, valid


def _fit_point(clf, point: dict, fold) -> float:
    """AUC-PR on a fold's validation rows of one grid point fitted on its training rows."""
    train, valid = fold.result()
    ev = BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderPR")
    return ev.evaluate(clf.fit(train, point).transform(valid))


def fit_grids(train: DataFrame, prepare: Sequence, grids: dict, folds: int = N_FOLDS, id_col: str = "txId",
              parallelism: int | None = None) -> dict[str, GridResult]:
    """Cross-validate several classifiers over their grids, fold by fold.

    ``prepare``: the feature stages; ``grids``: name -> (classifier, grid).  A fold's
    rows are featurised and scaled once, persisted, and read by every grid point of
    every classifier; folds come from the id, so they are reproducible.  Fits run
    as concurrent jobs in fold order (``parallelism`` at a time, default: the cores,
    but at least one fold's points), and a fold is released after its last fit.  Scores equal those
    of Spark's CrossValidator on the same folds.
    """
    points = [(name, k, clf, point) for name, (clf, grid) in grids.items() for k, point in enumerate(grid)]
    parallelism = parallelism or max(len(points), train.sparkSession.sparkContext.defaultParallelism)
    data = compacted(train.withColumn("_fold", fold_column(id_col, folds)), "folds", FOLD_BYTES).persist()
    scores = {(name, k): [] for name, k, _, _ in points}
    queued = []
    try:
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            for f in range(folds):      # queued in this order, a fit never waits for a fold behind it
                fold = pool.submit(_featurised, data, prepare, f)
                queued.append((fold, [(name, k, pool.submit(_fit_point, clf, point, fold)) for name, k, clf, point in points]))
            for fold, fits in queued:
                for name, k, fitted in fits:
                    scores[name, k].append(fitted.result())
                _release(fold)
            mean = {name: [sum(scores[name, k]) / folds for k in range(len(grid))] for name, (_, grid) in grids.items()}
            best = {name: pool.submit(Pipeline(stages=[*prepare, clf]).fit, data, grid[mean[name].index(max(mean[name]))])
                    for name, (clf, grid) in grids.items()}
            return {name: GridResult(best[name].result(), mean[name]) for name in grids}
    finally:
        for fold, _ in queued:
            _release(fold)
        data.unpersist()


def _release(fold) -> None:
    if fold.done() and fold.exception() is None:
        for part in fold.result():
            part.unpersist()


def point_name(point: dict) -> str:
    """Readable parameters of a grid point, by name."""
    return ", ".join(f"{p.name}={v}" for p, v in sorted(point.items(), key=lambda kv: kv[0].name))


def cross_validate(train: DataFrame, estimator: Pipeline, grid, folds: int = N_FOLDS,
                   id_col: str = "txId", parallelism: int | None = None) -> tuple[GridResult, DataFrame]:
    """k-fold CV of one estimator (feature stages, then a classifier) on AUC-PR by
    ``fit_grids``.  Returns (result, scores) where scores is (params, avg_auc_pr)
    per grid point."""
    *prepare, clf = estimator.getStages()
    result = fit_grids(train, prepare, {"": (clf, grid)}, folds, id_col, parallelism)[""]
    rows = [(point_name(p), float(m)) for p, m in zip(grid, result.avgMetrics, strict=True)]
    return result, train.sparkSession.createDataFrame(rows, "params string, avg_auc_pr double")


def _fingerprint(train: DataFrame, cols: Sequence[str], id_col: str) -> tuple:
    """Equal for equal training rows in any order: their number and the sum of
    their hashes; one aggregation."""
    h = F.xxhash64(F.col(id_col), F.col("label"), *[F.col(f"`{c}`") for c in cols]).cast("decimal(20,0)")
    return tuple(train.agg(F.count(F.lit(1)), F.sum(h)).first())


class GridStore:
    """Fitted grids of one application, written to the shared scratch folder: a grid
    is fitted once, and every later use with equal training rows, columns, folds,
    parameters and grid reads the winner back."""

    _of_application: dict[str, GridStore] = {}

    def __init__(self):
        self._kept: dict[tuple, tuple[str, list[float]]] = {}
        self._lock = Lock()

    @classmethod
    def of(cls, spark) -> GridStore:
        return cls._of_application.setdefault(spark.sparkContext.applicationId, cls())

    def get(self, key: tuple) -> GridResult | None:
        with self._lock:
            kept = self._kept.get(key)
        return GridResult(PipelineModel.load(kept[0]), list(kept[1])) if kept else None

    def put(self, spark, key: tuple, result: GridResult) -> None:
        path = scratch_path(spark, "grid")
        result.bestModel.write().save(path)
        with self._lock:
            self._kept[key] = (path, list(result.avgMetrics))


def select_models(train: DataFrame, classifiers: dict, cols: Sequence[str], folds: int = N_FOLDS,
                  id_col: str = "txId", store: GridStore | None = None) -> tuple[dict[str, PipelineModel], DataFrame]:
    """Cross-validate each classifier over its default grid; returns (name ->
    the winning pipeline, refitted on all of ``train``) and the score table
    (model, params, avg_auc_pr, selected).  All classifiers share the folds'
    features; with a ``store``, grids fitted before are read back."""
    grids = {name: (clf, param_grid(clf)) for name, clf in classifiers.items()}
    found, keys = {}, {}
    if store is not None:
        rows = _fingerprint(train, cols, id_col)
        for name, (clf, grid) in grids.items():
            params = sorted((p.name, str(v)) for p, v in clf.extractParamMap().items() if p.name not in ("featuresCol", "labelCol"))
            keys[name] = (type(clf).__name__, str(params), tuple(map(point_name, grid)), tuple(cols), folds, id_col, rows)
            if (kept := store.get(keys[name])) is not None:
                found[name] = kept
    missing = {name: g for name, g in grids.items() if name not in found}
    if missing:
        made = fit_grids(train, [assembler(cols), scaler()], missing, folds, id_col)
        for name, result in made.items():
            if store is not None:
                store.put(train.sparkSession, keys[name], result)
        found |= made
    rows = [(name, point_name(p), float(m), m == max(found[name].avgMetrics))
            for name, (_, grid) in grids.items() for p, m in zip(grid, found[name].avgMetrics, strict=True)]
    return ({name: found[name].bestModel for name in grids},
            train.sparkSession.createDataFrame(rows, "model string, params string, avg_auc_pr double, selected boolean"))


def default_classifiers() -> dict:
    return {"Random Forest": forest(), "Logistic Regression": logistic()}


def evaluate(pred: DataFrame) -> dict:
    """accuracy, f1, auc_pr, precision, recall of a scored table: one
    aggregation for the confusion counts (accuracy, weighted F1, precision and
    recall follow from them, equal to the multiclass evaluator) plus the
    AUC-PR evaluator."""
    pr = BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderPR",
                                       rawPredictionCol="rawPrediction")
    conf = metrics.confusion_counts(pred).first()
    out = metrics.scores_from_counts(conf.tp, conf.fp, conf.fn, conf.tn)
    out.update(auc_pr=pr.evaluate(pred), tp=conf.tp, fp=conf.fp, fn=conf.fn, tn=conf.tn)
    return out


def model_comparison(spark, results: dict[str, dict]) -> DataFrame:
    """model, accuracy, f1, auc_pr, precision, recall (one row per model)."""
    rows = [(name, *(float(r[k]) for k in ("accuracy", "f1", "auc_pr", "precision", "recall")))
            for name, r in results.items()]
    return spark.createDataFrame(
        rows, "model string, accuracy double, f1 double, auc_pr double, precision double, "
              "recall double")


def feature_importance(model: PipelineModel, cols: Sequence[str]) -> DataFrame:
    """feature, importance of the fitted forest (one row per feature), descending."""
    from pyspark.sql import SparkSession
    imp = model.stages[-1].featureImportances.toArray()
    df = SparkSession.active().createDataFrame([(c, float(v)) for c, v in zip(cols, imp)],
                                               "feature string, importance double")
    return df.orderBy(F.desc("importance"), "feature")


def importance_groups(importance: DataFrame, k: int = 20) -> DataFrame:
    """Top-k features (by importance, then name) with their family from the name
    (Local / Aggregate / Augmented)."""
    return (importance.orderBy(F.desc("importance"), "feature").limit(k)
                      .withColumn("group", feature_group("feature")))
