"""Cross-validated grids: equal to Spark's CrossValidator, fitted once a session."""

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import functions as F

from ledgerlens.operators import dataset, models
from ledgerlens.plans.queries import queries
from ledgerlens.sources.fixtures import DOC_FEATURE_COLS

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def train(tables):
    ds = dataset.labelled_dataset(tables.txs_features, tables.doc_classes)
    return dataset.temporal_split(ds)[0].coalesce(1).sortWithinPartitions("txId").cache()


@pytest.mark.parametrize("clf", ["forest", "logistic"])
def test_scores_equal_sparks_cross_validator(train, clf):
    """Same folds, same rows in the same order: the same mean scores and the same winner."""
    est = {"forest": models.forest(6, 3), "logistic": models.logistic(20)}[clf]
    grid = models.param_grid(est, **({"maxDepth": (1, 4)} if clf == "forest" else {"regParam": (0.001, 1.0)}))
    got, scores = models.cross_validate(train, models.fraud_estimator(est, DOC_FEATURE_COLS), grid, folds=3, parallelism=2)
    data = models.compacted(train.withColumn("_fold", models.fold_column("txId", 3)), "folds").cache()
    ev = BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderPR")
    want = CrossValidator(estimator=models.fraud_estimator(est, DOC_FEATURE_COLS), estimatorParamMaps=grid, evaluator=ev, numFolds=3, foldCol="_fold").fit(data)
    assert got.avgMetrics == pytest.approx(want.avgMetrics, abs=1e-9)
    name = next(iter(grid[0])).name
    assert got.bestModel.stages[-1].getOrDefault(name) == want.bestModel.stages[-1].getOrDefault(name)
    assert [r.avg_auc_pr for r in scores.collect()] == got.avgMetrics


def test_no_fold_stays_persisted(spark, train):
    held = spark.sparkContext._jsc.getPersistentRDDs().size()
    models.select_models(train, {"Logistic Regression": models.logistic(5)}, DOC_FEATURE_COLS, folds=2)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == held


def test_seven_queries_fit_one_grid_per_classifier(spark, monkeypatch):
    monkeypatch.setattr(models, "GRID_TREES", (2, 3))
    monkeypatch.setattr(models, "GRID_DEPTHS", (2,))
    monkeypatch.setattr(models, "GRID_REGS", (0.1, 1.0))
    fitted, plain = [], models.fit_grids
    monkeypatch.setattr(models, "fit_grids", lambda train, prepare, grids, *a, **k: fitted.extend(grids) or plain(train, prepare, grids, *a, **k))
    monkeypatch.setattr(models.GridStore, "_of_application", {})
    names = ["rf_predictions", "lr_predictions", "cv_scores", "rf_feature_importance", "importance_groups", "model_comparison", "model_confusion_matrix"]
    rows = {n: queries()[n](spark, SF_SMALL).collect() for n in names}
    assert sorted(fitted) == ["Logistic Regression", "Random Forest"]
    assert all(rows.values()) and len(rows["cv_scores"]) == 4
    assert {r.model for r in rows["cv_scores"] if r.selected} == {"Logistic Regression", "Random Forest"}


def test_other_rows_or_parameters_are_fitted_anew(train, monkeypatch):
    monkeypatch.setattr(models, "GRID_REGS", (0.1,))
    store, fitted, plain = models.GridStore(), [], models.fit_grids
    monkeypatch.setattr(models, "fit_grids", lambda *a, **k: fitted.append(1) or plain(*a, **k))

    def run(rows, clf, folds=2):
        best, scores = models.select_models(rows, {"m": clf}, DOC_FEATURE_COLS, folds=folds, store=store)
        return best["m"].stages[-1].coefficients.toArray().tolist(), scores.collect()

    first = run(train, models.logistic(5))
    assert run(train.repartition(3), models.logistic(5)) == first and len(fitted) == 1   # equal rows: read back
    run(train, models.logistic(6))
    run(train, models.logistic(5), folds=3)
    run(train.withColumn("label", F.lit(1) - F.col("label")), models.logistic(5))
    assert len(fitted) == 4


def test_folds_of_a_large_table_are_dealt_over_the_cores(spark, monkeypatch):
    """All rows, one fold each, evenly in several partitions; a small table stays whole."""
    rows = spark.range(4000, numPartitions=1).select(F.col("id").alias("txId"), (F.col("id") % 2).cast("int").alias("label"),
                                                     (F.col("id") * 7 % 1000).cast("double").alias("x"))
    seen, plain = [], models._featurised

    def featurised(data, prepare, fold):
        seen.append(data.groupBy(F.spark_partition_id()).count().collect())
        return plain(data, prepare, fold)

    monkeypatch.setattr(models, "_featurised", featurised)

    def run(size):
        monkeypatch.setattr(models, "FOLD_BYTES", size)
        seen.clear()
        clf = models.logistic(1)
        models.fit_grids(rows, [models.assembler(["x"]), models.scaler()], {"m": (clf, models.param_grid(clf, regParam=(0.1,)))}, folds=2)
        return [sorted(r["count"] for r in parts) for parts in seen]

    cores = spark.sparkContext.defaultParallelism
    for parts in run(1 << 10):
        assert len(parts) == cores > 1 and sum(parts) == 4000 and parts[-1] - parts[0] <= 4000 // cores // 10
    assert run(64 << 20) == [[4000], [4000]]
