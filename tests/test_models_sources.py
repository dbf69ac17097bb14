"""Model behaviour (never a golden score), sources and sinks, driver contract."""

import os
import tempfile

import pytest
from pyspark.sql import types as T

from ledgerlens.operators import dataset, models
from ledgerlens.sources import catalog, sinks
from ledgerlens.sources.fixtures import DOC_FEATURE_COLS


@pytest.fixture(scope="module")
def split(tables):
    ds = dataset.labelled_dataset(tables.txs_features, tables.doc_classes)
    return dataset.temporal_split(ds)


def test_train_test_disjoint(split):
    train, test = split
    assert train.join(test, "txId", "inner").count() == 0
    assert train.agg({"time_step": "max"}).first()[0] <= 34
    assert test.agg({"time_step": "min"}).first()[0] > 34


def test_forest_beats_prevalence_on_held_out_steps(split):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    train, test = split
    m = models.fit(train, models.forest(num_trees=20, max_depth=5), DOC_FEATURE_COLS)
    pred = m.transform(test)
    prevalence = test.where("label = 1").count() / test.count()
    auc = BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderPR").evaluate(pred)
    assert auc >= 2 * prevalence


def test_same_seed_same_predictions(split):
    train, test = split
    a = models.predictions(models.fit(train, models.forest(10, 4), DOC_FEATURE_COLS), test)
    b = models.predictions(models.fit(train, models.forest(10, 4), DOC_FEATURE_COLS), test)
    assert sorted(a.collect()) == sorted(b.collect())


def test_cross_validate_reports_each_grid_point(split):
    train, _ = split
    rf = models.forest(num_trees=5, max_depth=3)
    grid = models.param_grid(rf, numTrees=(5,), maxDepth=(2, 3))
    _, scores = models.cross_validate(train, models.fraud_estimator(rf, DOC_FEATURE_COLS), grid,
                                      folds=3)
    rows = scores.collect()
    assert len(rows) == 2 and all(0 <= r.avg_auc_pr <= 1 for r in rows)


def test_feature_columns_exclude_meta(split):
    train, _ = split
    assert dataset.feature_columns(train) == DOC_FEATURE_COLS


def test_csv_with_odd_header_quotes_and_empty_cells(spark):
    d = tempfile.mkdtemp(prefix="ll-csv-")
    p = os.path.join(d, "f.csv")
    with open(p, "w") as fh:
        fh.write('txId,Time step,note\n1,3,"a, b"\n2,,plain\n3,7,\n')
    schema = T.StructType([T.StructField("txId", T.LongType()),
                           T.StructField("time_step", T.IntegerType()),
                           T.StructField("note", T.StringType())])
    df = catalog.read_table(spark, p, schema, fmt="csv", header_names={"time_step": "Time step"})
    rows = sorted(df.collect())
    assert rows[0].note == "a, b" and rows[1].time_step is None and rows[2].note is None


def test_read_optional_absent_path(spark):
    assert catalog.read_optional(spark, "/nonexistent/ledgerlens/table.parquet") is None


def test_write_result_roundtrip(spark):
    d = tempfile.mkdtemp(prefix="ll-out-")
    df = spark.createDataFrame([(1, None), (2, "x")], "a long, b string")
    sinks.write_result(df, d + "/r", fmt="csv", single_file=True)
    back = catalog.read_table(spark, d + "/r", df.schema, fmt="csv")
    assert sorted(back.collect()) == sorted(df.collect())


def test_driver_contract(spark):
    import __spark_entry__ as entry
    out = entry.entry(spark)
    assert out.columns == ["case_type", "count", "avg_neighbours", "avg_illicit_ratio"]
    assert out.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_assert_unique(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "txId long, class int")
    with pytest.raises(ValueError):
        catalog.assert_unique(df, "txId")
    assert catalog.assert_unique(df, ["txId", "class"]) is df


def test_reported_models_are_the_cross_validated_winners(split, monkeypatch):
    monkeypatch.setattr(models, "GRID_TREES", (3, 8))
    monkeypatch.setattr(models, "GRID_DEPTHS", (1, 4))
    train, test = split
    best, scores = models.select_models(train, {"Random Forest": models.forest(5, 2), "Logistic Regression": models.logistic()},
                                        DOC_FEATURE_COLS, folds=3)
    rows = scores.collect()
    assert {r.model for r in rows} == set(best) and len(rows) == 4 + len(models.GRID_REGS)
    for name, model in best.items():
        own = [r for r in rows if r.model == name]
        top = max(own, key=lambda r: r.avg_auc_pr)
        assert top.selected
        chosen = dict(p.split("=") for p in top.params.split(", "))
        clf = model.stages[-1]
        for k, v in chosen.items():
            assert float(clf.getOrDefault(k)) == float(v)
        assert models.predictions(model, test).count() == test.count()


def test_importance_groups_by_name(spark):
    imp = spark.createDataFrame([("Local_1", 0.3), ("Aggregate_2", 0.4), ("in_degree", 0.2), ("Local_9", 0.05), ("Aggregate_1", 0.05)],
                                "feature string, importance double")
    got = [(r.feature, r.group) for r in models.importance_groups(imp, 4).collect()]
    assert got == [("Aggregate_2", "Aggregate"), ("Local_1", "Local"), ("in_degree", "Augmented"), ("Aggregate_1", "Aggregate")]


def test_malformed_csv_values_fail(spark, tmp_path):
    (tmp_path / "f.csv").write_text("txId,Time step\n1,3\n2,three\n")
    schema = T.StructType([T.StructField("txId", T.LongType()), T.StructField("time_step", T.IntegerType())])
    df = catalog.read_table(spark, str(tmp_path / "f.csv"), schema, fmt="csv", header_names={"time_step": "Time step"})
    with pytest.raises(Exception, match="malformed value in column time_step"):
        df.collect()


def test_optional_wallet_tables(spark, tmp_path):
    from ledgerlens.sources.reference_csv import CsvTables
    assert CsvTables(spark, str(tmp_path)).wallets_features is None
    (tmp_path / "wallets_features.csv").write_text("address,fee mean,n.txs\na,1.5,2\nb,,3\n")
    t = CsvTables(spark, str(tmp_path)).wallets_features
    assert sorted(t.collect()) == [("a", 1.5, 2.0), ("b", None, 3.0)]


def test_report_writes_predictions(spark, tmp_path):
    df = spark.createDataFrame([(1, 1, 1.0, "m"), (2, 0, 0.0, "m")], "txId long, label int, prediction double, model string")
    sinks.write_predictions(df, str(tmp_path / "p"), keep=["model"])
    assert sorted(spark.read.parquet(str(tmp_path / "p")).collect()) == [("m", 1, 1, 1), ("m", 2, 0, 0)]


@pytest.fixture(scope="module")
def labelled_texts(spark, tmp_path_factory):
    """500 short texts, two in three labelled, ids 7 and 8 twice."""
    d = tmp_path_factory.mktemp("texts")
    ids = [*range(500), 7, 8]
    texts = [(i, " ".join(["word!" if (i + k) % 5 else "word"] * 3 + [str(i * k)]), i % 3) for k, i in enumerate(ids, 1)]
    spark.createDataFrame([(i, t, len(t)) for i, t, _ in texts], "doc_id long, text string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, c % 2) for i, _, c in texts[:500] if c < 2], "doc_id long, quality int").write.parquet(f"{d}/labels.parquet")
    return str(d)


def test_model_queries_measure_the_texts_once(spark, labelled_texts, monkeypatch):
    """Fits and evaluations read stored rows, the same as the labelled table has; none goes back to the texts."""
    from ledgerlens.plans import q_ml
    from ledgerlens.plans.tables import Tables
    t, read = Tables(spark, labelled_texts), []

    def select(train, classifiers, cols, **options):
        read.append(train)
        return {n: models.fit(train, models.logistic(2), cols) for n in classifiers}, None

    monkeypatch.setattr(q_ml.models, "select_models", select)
    for query in (q_ml.model_confusion_matrix, q_ml.model_comparison, q_ml.lr_predictions):
        out = query(t)
        read.append(out)
        assert out.count() > 0
    files = [f for df in read for f in df.inputFiles()]
    assert files and not any("documents.parquet" in f or "labels.parquet" in f for f in files)
    want = dataset.temporal_split(dataset.labelled_dataset(t.txs_features, t.doc_classes))
    for got, plain in zip(q_ml._split(t), want, strict=True):
        assert sorted(got.collect()) == sorted(plain.collect()) and got.columns == plain.columns


def test_model_comparison_holds_only_what_evaluations_read(spark, labelled_texts, monkeypatch):
    from ledgerlens.plans import q_ml
    from ledgerlens.plans.tables import Tables
    held, plain = [], models.evaluate
    monkeypatch.setattr(q_ml.models, "select_models", lambda train, classifiers, cols, **o: ({n: models.fit(train, models.logistic(2), cols) for n in classifiers}, None))
    monkeypatch.setattr(q_ml.models, "evaluate", lambda p: held.append((p.columns, p.is_cached)) or plain(p))
    rows = q_ml.model_comparison(Tables(spark, labelled_texts)).collect()
    assert held == [(["label", "prediction", "rawPrediction"], True)] * 2
    assert [r.model for r in rows] == ["Random Forest", "Logistic Regression"] and rows[0][1:] == rows[1][1:]
