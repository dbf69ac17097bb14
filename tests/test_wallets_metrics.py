"""Wallet operators, metric forms vs Spark ML evaluators, sampling and scaling."""

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from ledgerlens.operators import dataset, metrics, models, wallets
from ledgerlens.sources.fixtures import DOC_FEATURE_COLS


def test_edge_flow_sums_to_edge_count_and_merges_unknown(spark):
    e = spark.createDataFrame([("a", "b"), ("a", "b"), ("c", "a"), ("x", "b"), ("b", "y")],
                              "input_address string, output_address string")
    w = spark.createDataFrame([("a", 1), ("b", 2), ("c", None), ("y", 3)], "address string, class int")
    flow = {(r.from_class, r.to_class): r.edge_count for r in wallets.edge_flow(e, w).collect()}
    assert sum(flow.values()) == 5
    assert flow == {("illicit", "licit"): 2, ("unknown", "illicit"): 1, ("unknown", "licit"): 1,
                    ("licit", "unknown"): 1}
    m = {r.from_class: r for r in wallets.edge_flow_matrix(wallets.edge_flow(e, w)).collect()}
    assert m["illicit"].licit == 2 and m["illicit"].unknown == 0


def test_wallet_features_fill_and_class_zero(spark):
    e = spark.createDataFrame([("a", "b"), ("a", "b"), ("a", "c")],
                              "input_address string, output_address string")
    at = spark.createDataFrame([("a", 1), ("a", 1), ("d", 2)], "input_address string, txId long")
    ta = spark.createDataFrame([(1, "b")], "txId long, output_address string")
    cls = spark.createDataFrame([("a", 1)], "address string, class int")
    wf = {r.address: r for r in wallets.wallet_features(e, at, ta, cls).collect()}
    assert set(wf) == {"a", "b", "c", "d"}
    assert (wf["a"].out_degree, wf["a"].unique_out, wf["a"].txs_sent, wf["a"]["class"]) == (3, 2, 1, 1)
    assert (wf["b"].in_degree, wf["b"].unique_in, wf["b"].txs_received, wf["b"]["class"]) == (2, 1, 1, 0)
    assert wf["d"].out_degree == 0 and wf["d"].txs_sent == 1


def test_cluster_type_rule_order(spark):
    prof = spark.createDataFrame([(0, 60.0, 70.0), (1, 1.0, 2.0), (2, 2.0, 1.0), (3, 1.0, 1.0)],
                                 "prediction int, avg_out_deg double, avg_in_deg double")
    got = {r.prediction: r.cluster_type for r in wallets.cluster_types(prof).collect()}
    assert got == {0: "High Activity Hub", 1: "Receiver Wallet", 2: "Sender Wallet",
                   3: "Low Activity"}


@pytest.fixture(scope="module")
def scored(tables):
    ds = dataset.labelled_dataset(tables.txs_features, tables.doc_classes)
    return models.rule_scored(ds, "f_punct_ratio", 0.1).persist()


def test_auc_equals_spark_evaluator(scored):
    ours = metrics.curve_areas(scored, digits=12).first()
    ev = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="score", numBins=0)
    assert abs(ours.auc_pr - ev.setMetricName("areaUnderPR").evaluate(scored)) < 1e-9
    assert abs(ours.auc_roc - ev.setMetricName("areaUnderROC").evaluate(scored)) < 1e-9


def test_accuracy_f1_equal_spark_evaluator(scored):
    ours = metrics.classification_metrics(scored, digits=12).first()
    ev = MulticlassClassificationEvaluator(labelCol="label")
    assert abs(ours.accuracy - ev.setMetricName("accuracy").evaluate(scored)) < 1e-9
    assert abs(ours.f1 - ev.setMetricName("f1").evaluate(scored)) < 1e-9


def test_confusion_sums_to_rows_and_zero_guard(spark, scored):
    c = metrics.confusion_counts(scored).first()
    assert c.tp + c.fp + c.fn + c.tn == scored.count()
    none_pred = spark.createDataFrame([(1, 0.0), (0, 0.0)], "label int, prediction double")
    m = metrics.classification_metrics(none_pred).first()
    assert m.precision == 0.0 and m.recall == 0.0


def test_roc_is_monotone(scored):
    pts = sorted((r.threshold, r.tpr, r.fpr) for r in metrics.roc_curve(scored).collect())
    pts.reverse()
    assert all(a[1] <= b[1] and a[2] <= b[2] for a, b in zip(pts, pts[1:]))
    assert pts[-1][1] == 1.0 and pts[-1][2] == 1.0


def test_stratified_sample_is_reproducible(tables):
    ds = dataset.labelled_dataset(tables.txs_features, tables.doc_classes)
    a = sorted(r.txId for r in dataset.stratified_sample(ds, {0: 0.3}).collect())
    b = sorted(r.txId for r in dataset.stratified_sample(ds.repartition(5), {0: 0.3}).collect())
    assert a == b
    kept = dataset.stratified_sample(ds, {0: 0.3})
    assert kept.where("label = 1").count() == ds.where("label = 1").count()
    bal = dataset.downsample_majority(ds, 1.0)
    assert bal.where("label = 1").count() == ds.where("label = 1").count()
    assert bal.where("label = 0").count() < ds.where("label = 0").count()


def test_standardise_fits_on_train_only(tables):
    ds = dataset.labelled_dataset(tables.txs_features, tables.doc_classes)
    train, test = dataset.temporal_split(ds)
    z = models.standardise(train, ds, DOC_FEATURE_COLS, keep=["txId", "time_step"])
    zt = z.join(train.select("txId"), "txId", "left_semi")
    means = zt.agg(*[F.avg(f"z_{c}") for c in DOC_FEATURE_COLS]).first()
    assert all(abs(m) < 1e-9 for m in means)
    ours = dataset.standardise_columns(ds, DOC_FEATURE_COLS, fit=train, prefix="d_")
    both = z.join(ours, "txId").select(
        F.max(F.abs(F.col("z_f_chars") - F.col("d_f_chars"))).alias("d")).first()
    assert both.d < 1e-9


def test_zero_variance_feature_scales_to_zero(spark):
    df = spark.createDataFrame([(1, 5.0, 1.0), (2, 5.0, 2.0)], "txId long, c double, v double")
    z = models.standardise(df, df, ["c", "v"], keep=["txId"]).collect()
    assert all(r.z_c == 0.0 for r in z)


def test_silhouette_equals_evaluator(spark):
    from pyspark.ml.evaluation import ClusteringEvaluator
    from pyspark.ml.feature import VectorAssembler
    rows = [(i, float(i % 7), float((i * 3) % 5), i % 3) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, a double, b double, prediction int")
    ours = metrics.silhouette(df, ["a", "b"], digits=12).first().silhouette
    vec = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    ref = ClusteringEvaluator(featuresCol="features").evaluate(vec)
    assert abs(ours - ref) < 1e-9


def test_sql_views_give_the_same_flow(spark, tables):
    from ledgerlens.sources.catalog import register_views
    register_views({"wallets": tables.wallet_classes, "addr_edges": tables.addr_addr})
    sql = spark.sql("""
        SELECT CASE wi.class WHEN 1 THEN 'illicit' WHEN 2 THEN 'licit' ELSE 'unknown' END AS from_class,
               CASE wo.class WHEN 1 THEN 'illicit' WHEN 2 THEN 'licit' ELSE 'unknown' END AS to_class,
               COUNT(*) AS edge_count
        FROM addr_edges e
        LEFT JOIN wallets wi ON e.input_address = wi.address
        LEFT JOIN wallets wo ON e.output_address = wo.address
        GROUP BY 1, 2""")
    ours = wallets.edge_flow(tables.addr_addr, tables.wallet_classes)
    assert sorted(sql.collect()) == sorted(ours.collect())
    assert sum(r.edge_count for r in ours.collect()) == tables.addr_addr.count()


def test_fill_numeric_leaves_strings(spark):
    df = spark.createDataFrame([(None, None, 1.0)], "a long, s string, d double")
    r = dataset.fill_numeric(df).first()
    assert r.a == 0 and r.s is None and r.d == 1.0


def test_rule_cluster_sizes_sum_to_wallets(tables):
    wf = wallets.wallet_features(tables.addr_addr, tables.addr_tx, tables.tx_addr,
                                 tables.wallet_classes)
    prof = wallets.cluster_profile(wallets.rule_clusters(wf)).collect()
    assert [r.wallet_count for r in prof] == [330, 84, 1111]      # FIXTURES facts, sf0.01
    assert sum(r.wallet_count for r in prof) == wf.count()


def test_approximate_modes_stay_close(tables):
    from ledgerlens.operators import profile
    exact = {r.address: r for r in wallets.wallet_out(tables.addr_addr).collect()}
    approx = {r.address: r for r in wallets.wallet_out(tables.addr_addr, approx=True).collect()}
    assert exact.keys() == approx.keys()
    assert all(abs(approx[a].unique_out - e.unique_out) <= max(2, 0.05 * e.unique_out)
               for a, e in exact.items())
    ex = {r.column: r for r in profile.feature_summary(tables.txs_features, DOC_FEATURE_COLS).collect()}
    ap = {r.column: r for r in profile.feature_summary(tables.txs_features, DOC_FEATURE_COLS,
                                                       accuracy=10000).collect()}
    assert all(abs(ap[c].p50 - ex[c].p50) <= 0.05 * (ex[c].max - ex[c]["min"] + 1e-9) for c in ex)


def test_scores_from_counts_equal_evaluators(scored):
    c = metrics.confusion_counts(scored).first()
    got = metrics.scores_from_counts(c.tp, c.fp, c.fn, c.tn)
    ev = MulticlassClassificationEvaluator(labelCol="label")
    assert abs(got["accuracy"] - ev.setMetricName("accuracy").evaluate(scored)) < 1e-12
    assert abs(got["f1"] - ev.setMetricName("f1").evaluate(scored)) < 1e-12
    row = metrics.classification_metrics(scored, digits=12).first()
    assert abs(got["precision"] - row.precision) < 1e-9 and abs(got["recall"] - row.recall) < 1e-9


def test_correlation_rule_does_not_depend_on_the_width(spark):
    from ledgerlens.operators import profile
    cols = [f"c{i}" for i in range(40)]
    full = spark.range(300).select(*[((F.col("id") * (i + 3)) % (17 + i)).cast("double").alias(c)
                                     for i, c in enumerate(cols)])
    holes = full.select(*[F.when(F.pmod(F.xxhash64(c, F.lit(i)), F.lit(9)) > 0, F.col(c)).alias(c)
                          for i, c in enumerate(cols)])
    cells = lambda d, c, **k: {(r.a, r.b): r.r for r in profile.correlation_matrix(d, c, **k).collect()}
    wide, narrow = cells(holes, cols), cells(holes, cols[:5])
    assert len(wide) == len(cols) ** 2 and all(wide[k] == v for k, v in narrow.items())
    pdf = holes.toPandas().corr()
    assert all(abs(pdf.loc[a, b] - r) < 2e-6 for (a, b), r in wide.items())
    complete = cells(holes, cols[:5], method="complete")
    pdf = holes.select(*cols[:5]).toPandas().dropna().corr()
    assert all(abs(pdf.loc[a, b] - r) < 2e-6 for (a, b), r in complete.items())


def test_silhouette_lazy_path_equals_collect_path(spark):
    rows = [(i, float(i % 7), float((i * 3) % 5), i % 3) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, a double, b double, prediction int")
    lazy = metrics.silhouette(df, ["a", "b"], digits=12, cluster_ids=[0, 1, 2]).first()[0]
    eager = metrics.silhouette(df, ["a", "b"], digits=12).first()[0]
    with_empty = metrics.silhouette(df, ["a", "b"], digits=12, cluster_ids=[0, 1, 2, 7]).first()[0]
    assert abs(lazy - eager) < 1e-12 and abs(with_empty - eager) < 1e-12


def test_random_stratified_sample_keeps_minority(tables):
    ds = dataset.labelled_dataset(tables.txs_features, tables.doc_classes)
    s = dataset.stratified_sample(ds, {0: 0.2}, method="random", seed=7)
    assert s.where("label = 1").count() == ds.where("label = 1").count()
    assert 0 < s.where("label = 0").count() < ds.where("label = 0").count()


def test_pair_count_inputs_equal_raw_edges(tables):
    e, c = tables.addr_addr, tables.wallet_classes
    pairs = wallets.pair_counts(e)
    assert sorted(wallets.edge_flow(pairs, c, weight="n").collect()) == \
        sorted(wallets.edge_flow(e, c).collect())
    assert wallets.top_illicit_senders(pairs, c, 15, weight="n").collect() == \
        wallets.top_illicit_senders(e, c, 15).collect()
    assert wallets.illicit_to_licit(pairs, c, 15, weight="n").collect() == \
        wallets.illicit_to_licit(e, c, 15).collect()


def test_wallet_features_from_shared_pairs(tables):
    args = (tables.addr_addr, tables.addr_tx, tables.tx_addr, tables.wallet_classes)
    shared = wallets.wallet_features(*args, pairs=wallets.pair_counts(tables.addr_addr))
    assert sorted(shared.collect()) == sorted(wallets.wallet_features(*args).collect())
