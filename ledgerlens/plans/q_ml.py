"""Queries: fraud models and wallet clustering (checked rows-only here; their
metric and profile operators are SQL-checked on fixed scores/clusters in
q_metrics / q_wallets, and the models are unit-tested for hold-out quality)."""

from __future__ import annotations

from contextlib import contextmanager

from ledgerlens.operators import clustering, dataset, metrics, models, wallets
from ledgerlens.plans.queries import register
from ledgerlens.session import compacted, materialize, persisted, stored
from ledgerlens.sources.fixtures import DOC_FEATURE_COLS


def _split(t):
    """Training and held-out rows of the labelled table, stored once: the texts are read and
    measured in one pass, whatever number of fits and evaluations read the rows."""
    ds = dataset.labelled_dataset(t.txs_features, t.doc_classes)
    return dataset.temporal_split(stored(ds, "labelled"))


def _selected(t, *names):
    """The cross-validated winners of the named classifiers, the held-out rows
    and the score table; a session fits the grid of a classifier once."""
    train, test = _split(t)
    wanted = {n: c for n, c in models.default_classifiers().items() if n in names or not names}
    best, scores = models.select_models(train, wanted, DOC_FEATURE_COLS, store=models.GridStore.of(t.spark))
    return best, test, scores


@register("rf_predictions", None)
def rf_predictions(t):
    best, test, _ = _selected(t, "Random Forest")
    return models.predictions(best["Random Forest"], test)


@register("lr_predictions", None)
def lr_predictions(t):
    best, test, _ = _selected(t, "Logistic Regression")
    return models.predictions(best["Logistic Regression"], test)


@register("cv_scores", None)
def cv_scores(t):
    return _selected(t)[2]


@register("rf_feature_importance", None)
def rf_feature_importance(t):
    best, _, _ = _selected(t, "Random Forest")
    return models.feature_importance(best["Random Forest"], DOC_FEATURE_COLS)


@register("importance_groups", None)
def importance_groups(t):
    best, _, _ = _selected(t, "Random Forest")
    return models.importance_groups(models.feature_importance(best["Random Forest"], DOC_FEATURE_COLS), 20)


@register("model_comparison", None)
def model_comparison(t):
    best, test, _ = _selected(t)
    results = {}
    for name, model in best.items():
        # scanned by two evaluations, without the vectors they do not read
        with persisted(model.transform(test).select("label", "prediction", "rawPrediction")) as p:
            results[name] = models.evaluate(p)
    return models.model_comparison(t.spark, results)


@register("model_confusion_matrix", None)
def model_confusion_matrix(t):
    best, test, _ = _selected(t)
    out = None
    for name, model in best.items():
        m = metrics.confusion_matrix(metrics.confusion_counts(model.transform(test)), name)
        out = m if out is None else out.unionByName(m)
    return out


def _wallet_features(t):
    return wallets.wallet_features(t.addr_addr, t.addr_tx, t.tx_addr, t.wallet_classes)


@contextmanager
def _scaled_wallets(t):
    """The wallet table with its scaled vector, persisted without the raw vector;
    the unscaled copy is released once the scaler is fitted."""
    with persisted(compacted(_wallet_features(t), "wallets")) as wf:
        slim = clustering.scaled(wf, wallets.WALLET_FEATURES).select("address", "class", *wallets.WALLET_FEATURES, "features").persist()
        slim.count()
    try:
        yield slim
    finally:
        slim.unpersist()


def _best_clusters(scaled):
    scores, fitted = clustering.kmeans_sweep(scaled)
    return scores, clustering.best_clustering(scaled, scores, fitted)


@register("kmeans_sweep", None)
def kmeans_sweep(t):
    with _scaled_wallets(t) as scaled:
        scores, _ = clustering.kmeans_sweep(scaled)
        return materialize(scores)


@register("kmeans_profile", None)
def kmeans_profile(t):
    with _scaled_wallets(t) as scaled:
        _, clustered = _best_clusters(scaled)
        return materialize(wallets.cluster_types(wallets.cluster_profile(clustered)))


@register("wallet_pca", None)
def wallet_pca(t):
    with _scaled_wallets(t) as scaled:
        _, clustered = _best_clusters(scaled)
        return materialize(clustering.pca_2d(clustered, keep=["address", "prediction"]))
