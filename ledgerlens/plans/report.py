"""The analysis report: every stage's result tables from one table bundle.

``report_tables(t)`` composes the operators into named, lazy result tables
(the tables the analysed script drew its charts from and saved as CSV);
``write_report(t, out_dir)`` writes them with the distributed sinks.  ``t`` is
any bundle with the table attributes of ``plans.tables.Tables`` - the test
data bundle or ``sources.reference_csv.CsvTables``.

Model and clustering tables need fitted estimators, so they are built eagerly
(fits are actions) when ``models=True``; everything else stays lazy until
written.

usage: python -m ledgerlens.plans.report <csv_dir> <out_dir> [--no-models]
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators import (cases, classes, clustering, dataset, graph, metrics, models,
                                  profile, temporal, wallets)
from ledgerlens.operators.class_bitmap import class_bitmap
from ledgerlens.session import compacted, materialize, persisted, stored
from ledgerlens.sources.sinks import write_predictions, write_result

# Fixed values of the analysed script's report (sizes of its top lists, bins).
TOP_HUBS, TOP_WALLETS, TOP_RATIO = 20, 15, 500
DEGREE_BINS, RATIO_BINS = 60, 30

# result tables that grow with the data: written as many files
LARGE = {"roc_curve", "pr_curve", "wallet_pca", "predictions", "degree_distribution"}


def _relational(t, shared: list) -> dict[str, DataFrame]:
    edges, tx_cls, w_cls = t.tx_edges, t.tx_classes, t.wallet_classes
    deg = graph.total_degree(edges)
    hubs = graph.label_hubs(graph.top_hubs(deg, TOP_HUBS), tx_cls)
    # the wallet edge list is counted per pair once (shared[0]) and feeds the
    # flow, the top lists and the behaviour table
    pairs = wallets.pair_counts(t.addr_addr).persist()
    shared.append(pairs)
    # one edge/class lookup for both the neighbour profile and the case grading
    # (by bitmap where the class table fits one, else by join)
    nb_counts = cases.neighbour_counts(edges, tx_cls, bitmap=class_bitmap(tx_cls)).persist()
    shared.append(nb_counts)
    nb = graph.profile_from_counts(nb_counts, tx_cls)
    steps = t.tx_steps if t.tx_steps is not None else temporal.synthetic_steps(tx_cls)
    counts = temporal.step_class_counts(temporal.tx_time(steps, tx_cls))
    flow = wallets.edge_flow(pairs, w_cls, weight="n")
    return {
        "null_profile": profile.null_profile(t.reference_tables()),
        "class_distribution": classes.class_distribution(tx_cls, w_cls),
        "class_imbalance": classes.class_imbalance(tx_cls),
        "degree_stats": graph.degree_stats(deg),
        "top_hubs": hubs,
        "hub_class_share": graph.hub_class_share(hubs),
        "degree_histogram": graph.degree_histogram(deg, DEGREE_BINS),
        "degree_distribution": graph.degree_distribution(edges),
        "edge_flow_by_class": flow,
        "edge_flow_matrix": wallets.edge_flow_matrix(flow),
        "top_illicit_wallets": wallets.top_illicit_senders(pairs, w_cls, TOP_WALLETS, weight="n"),
        "illicit_to_licit_transfers": wallets.illicit_to_licit(pairs, w_cls, TOP_WALLETS,
                                                               weight="n"),
        "temporal_distribution": temporal.temporal_distribution(counts),
        "rolling_illicit_rate": temporal.rolling_illicit_rate(counts),
        "fraud_bursts": temporal.fraud_bursts(counts),
        "top_neighbour_ratio": graph.top_neighbour_ratio(nb, TOP_RATIO),
        "neighbour_ratio_histogram": graph.neighbour_ratio_histogram(nb, RATIO_BINS),
        "case_summary": cases.case_summary(cases.grade_cases(nb_counts, tx_cls)),
    }


def _feature_profile(t, cols: list[str] | None = None) -> dict[str, DataFrame]:
    """Summaries and correlations of the named feature columns (default: all)."""
    feats = t.txs_features
    cols = cols or dataset.feature_columns(feats)
    q = profile.quartiles(feats, cols)      # selected once for both tables
    return {
        "feature_summary": profile.feature_summary(feats, cols, q=q),
        "feature_box_stats": profile.box_stats(feats, cols, q=q),
        "feature_correlation": profile.correlation_matrix(feats, cols),
    }


def _models(t, cross_validation: bool) -> dict[str, DataFrame]:
    ds = stored(dataset.labelled_dataset(t.txs_features, t.doc_classes), "labelled")    # read by every fit and evaluation
    cols = dataset.feature_columns(ds)
    train, test = dataset.temporal_split(ds)
    out, results, confusion, predicted = {}, {}, None, None
    # with cross-validation the winners are what is reported
    if cross_validation:
        fitted, out["cv_scores"] = models.select_models(train, models.default_classifiers(), cols)
    else:
        fitted = models.fit_many(train, models.default_classifiers(), cols)
    for name, model in fitted.items():
        with persisted(models.score_column(model.transform(test))) as pred:
            results[name] = models.evaluate(pred)
            m = metrics.confusion_matrix(metrics.confusion_counts(pred), name)
            confusion = m if confusion is None else confusion.unionByName(m)
            if name == "Random Forest":
                out["roc_curve"] = materialize(metrics.roc_curve(pred))
                out["pr_curve"] = materialize(metrics.pr_curve(pred))
            own = materialize(pred.select("txId", "label", "prediction", F.lit(name).alias("model")))
            predicted = own if predicted is None else predicted.unionByName(own)
    out["model_comparison"] = models.model_comparison(t.spark, results)
    out["confusion_matrices"] = materialize(confusion)
    out["predictions"] = predicted
    importance = models.feature_importance(fitted["Random Forest"], cols)
    out["feature_importance"] = importance
    out["importance_groups"] = models.importance_groups(importance)
    return out


def _clusters(t, pairs: DataFrame | None = None) -> dict[str, DataFrame]:
    wf = wallets.wallet_features(t.addr_addr, t.addr_tx, t.tx_addr, t.wallet_classes,
                                 pairs=pairs)
    with persisted(compacted(wf, "wallets")) as wf, \
            persisted(clustering.scaled(wf, wallets.WALLET_FEATURES)) as scaled:
        scores, fitted = clustering.kmeans_sweep(scaled)
        clustered = clustering.best_clustering(scaled, scores, fitted)
        return {"k_selection": scores,
                "cluster_profiles": materialize(
                    wallets.cluster_types(wallets.cluster_profile(clustered))),
                "wallet_pca": materialize(clustering.pca_2d(clustered, ["address", "prediction"]))}


def report_tables(t, models_too: bool = True, cross_validation: bool = True,
                  shared: list | None = None) -> dict[str, DataFrame]:
    """Named result tables.  Intermediates persisted for sharing between
    tables are appended to ``shared``; the caller unpersists them when done."""
    shared = [] if shared is None else shared
    out = _relational(t, shared)
    if t.txs_features is not None:
        out.update(_feature_profile(t))
        if models_too:
            out.update(_models(t, cross_validation))
    if models_too:
        out.update(_clusters(t, pairs=shared[0] if shared else None))
    return out


def write_report(t, out_dir: str, fmt: str = "csv", models_too: bool = True,
                 cross_validation: bool = True) -> list[str]:
    """Write every report table under ``out_dir/<name>``; returns the names."""
    shared: list = []
    try:
        tables = report_tables(t, models_too, cross_validation, shared)
        for name, df in tables.items():
            path = f"{out_dir.rstrip('/')}/{name}"
            if name == "predictions":
                write_predictions(df, path, fmt=fmt, keep=["model"])
            else:
                write_result(df, path, fmt=fmt, single_file=name not in LARGE)
    finally:
        for df in shared:
            df.unpersist()
    return list(tables)


def main(argv) -> int:
    from ledgerlens.session import get_session
    from ledgerlens.sources.reference_csv import CsvTables
    if len(argv) < 3:
        print(__doc__)
        return 2
    from pyspark import SparkConf
    # spark-submit supplies the master; a plain `python -m` run falls back to local
    spark = get_session(None if SparkConf().contains("spark.master") else "local[*]")
    names = write_report(CsvTables(spark, argv[1]), argv[2], models_too="--no-models" not in argv)
    print("\n".join(names))
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
