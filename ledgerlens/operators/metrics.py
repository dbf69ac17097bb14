"""Classification and clustering metrics as DataFrame plans.

These equal the Spark ML evaluators on the same rows (see the tests) but stay
lazy and can be checked against SQL.  Curves group rows by distinct score and
cumulate counts in descending score order with the range-sliced running sums,
so no step collects all scores into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.ordering import with_running_sums


def confusion_counts(pred: DataFrame, label_col: str = "label",
                     pred_col: str = "prediction") -> DataFrame:
    """tp, fp, fn, tn of the positive class (label 1) in one pass."""
    y, p = F.col(label_col), F.col(pred_col)
    return pred.agg(F.count_if((y == 1) & (p == 1)).alias("tp"),
                    F.count_if((y == 0) & (p == 1)).alias("fp"),
                    F.count_if((y == 1) & (p == 0)).alias("fn"),
                    F.count_if((y == 0) & (p == 0)).alias("tn"))


def confusion_matrix(conf: DataFrame, model: str | None = None) -> DataFrame:
    """Long form: [model,] actual, predicted, count (4 rows per model)."""
    cells = F.array(
        F.struct(F.lit(0).alias("actual"), F.lit(0).alias("predicted"), F.col("tn").alias("count")),
        F.struct(F.lit(0).alias("actual"), F.lit(1).alias("predicted"), F.col("fp").alias("count")),
        F.struct(F.lit(1).alias("actual"), F.lit(0).alias("predicted"), F.col("fn").alias("count")),
        F.struct(F.lit(1).alias("actual"), F.lit(1).alias("predicted"), F.col("tp").alias("count")))
    cols = ([F.lit(model).alias("model")] if model is not None else []) + [F.inline(cells)]
    return conf.select(*cols)


def scores_from_counts(tp: int, fp: int, fn: int, tn: int) -> dict[str, float]:
    """accuracy, f1 (support-weighted), precision, recall from the four counts
    (the same formulas as ``classification_metrics``, on four numbers)."""
    def d(a, b):
        return a / b if b > 0 else 0.0

    def f1(t, f_p, f_n):
        p, r = d(t, t + f_p), d(t, t + f_n)
        return 2 * p * r / (p + r) if p + r > 0 else 0.0

    n = tp + fp + fn + tn
    return {"accuracy": d(tp + tn, n),
            "f1": d(f1(tp, fp, fn) * (tp + fn) + f1(tn, fn, fp) * (tn + fp), n),
            "precision": d(tp, tp + fp), "recall": d(tp, tp + fn)}


def _div(a, b):
    return F.when(b > 0, a.cast("double") / b).otherwise(F.lit(0.0))


def classification_metrics(pred: DataFrame, label_col: str = "label",
                           pred_col: str = "prediction", digits: int = 6) -> DataFrame:
    """accuracy, f1 (support-weighted over labels 0/1, as the multiclass
    evaluator), precision and recall of label 1 (0 when undefined)."""
    conf = confusion_counts(pred, label_col, pred_col)
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn

    def f1(tp_, fp_, fn_):
        p, r = _div(tp_, tp_ + fp_), _div(tp_, tp_ + fn_)
        return F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))

    weighted_f1 = _div(f1(tp, fp, fn) * (tp + fn) + f1(tn, fn, fp) * (tn + fp), n)
    return conf.select(
        F.round(_div(tp + tn, n), digits).alias("accuracy"),
        F.round(weighted_f1, digits).alias("f1"),
        F.round(_div(tp, tp + fp), digits).alias("precision"),
        F.round(_div(tp, tp + fn), digits).alias("recall"))


def _curve_base(scored: DataFrame, score_col: str, label_col: str) -> DataFrame:
    """One row per distinct score: score, pos, neg, cum_pos, cum_neg (score desc)."""
    by_score = scored.groupBy(F.col(score_col).cast("double").alias("score")).agg(
        F.count_if(F.col(label_col) == 1).alias("pos"),
        F.count_if(F.col(label_col) != 1).alias("neg"))
    return with_running_sums(by_score, [F.col("score").desc()], ["pos", "neg"])


def _with_totals(base: DataFrame):
    """base + a ``_tot`` struct column (P, N), summed from the per-score table;
    returns (df, P, N) with P and N as column references."""
    s = base.agg(F.struct(F.coalesce(F.sum("pos"), F.lit(0)).alias("P"),
                          F.coalesce(F.sum("neg"), F.lit(0)).alias("N")).alias("s")).scalar()
    return base.withColumn("_tot", s), F.col("_tot.P"), F.col("_tot.N")


def roc_curve(scored: DataFrame, score_col: str = "score", label_col: str = "label",
              digits: int = 6) -> DataFrame:
    """threshold, tp, fp, tpr, fpr: one point per distinct score (predict
    positive when score >= threshold)."""
    base, P, N = _with_totals(_curve_base(scored, score_col, label_col))
    return base.select(F.col("score").alias("threshold"),
                       F.col("cum_pos").alias("tp"), F.col("cum_neg").alias("fp"),
                       F.round(_div(F.col("cum_pos"), P), digits).alias("tpr"),
                       F.round(_div(F.col("cum_neg"), N), digits).alias("fpr"))


def pr_curve(scored: DataFrame, score_col: str = "score", label_col: str = "label",
             digits: int = 6) -> DataFrame:
    """threshold, precision, recall: one point per distinct score."""
    base, P, _ = _with_totals(_curve_base(scored, score_col, label_col))
    return base.select(F.col("score").alias("threshold"),
                       F.round(_div(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg")), digits)
                        .alias("precision"),
                       F.round(_div(F.col("cum_pos"), P), digits).alias("recall"))


def curve_areas(scored: DataFrame, score_col: str = "score", label_col: str = "label",
                digits: int = 6) -> DataFrame:
    """auc_roc, auc_pr by the trapezoid rule over all distinct scores.

    The previous curve point is the running total minus the row's own counts,
    so no lag (and no ordering) is needed in the final sum.  PR starts at
    (recall 0, precision of the first point), as Spark's binary metrics do.
    """
    base, P, N = _with_totals(_curve_base(scored, score_col, label_col))
    tp, fp = F.col("cum_pos"), F.col("cum_neg")
    tp0, fp0 = tp - F.col("pos"), fp - F.col("neg")
    tpr, fpr, tpr0, fpr0 = _div(tp, P), _div(fp, N), _div(tp0, P), _div(fp0, N)
    prec = _div(tp, tp + fp)
    prec0 = F.when(tp0 + fp0 > 0, tp0.cast("double") / (tp0 + fp0)).otherwise(prec)
    rec, rec0 = _div(tp, P), _div(tp0, P)
    return base.agg(
        F.round(F.sum((fpr - fpr0) * (tpr + tpr0) / 2), digits).alias("auc_roc"),
        F.round(F.sum((rec - rec0) * (prec + prec0) / 2), digits).alias("auc_pr"))


def binned_curve(scored: DataFrame, points: int = 1000, score_col: str = "score", label_col: str = "label",
                 digits: int = 9) -> DataFrame:
    """The ROC and precision-recall curves in at most 2 x ``points`` + 1 rows,
    whatever the number of scores: bin (rising as scores fall), threshold (the
    bin's lowest score), scores (distinct ones in it), pos, neg, tp, fp, tpr, fpr, precision
    (= the full curves' point at that threshold), roc_area and pr_area.

    A bin ends where the positives or the negatives pass the next of ``points``
    equal steps, so every point of the full curve lies within 1 / ``points`` in recall (tpr)
    and in fpr of a kept one, unless a single score holds more.  The areas are those of the
    full curve between two kept points, so their sums are its areas, not those of the
    thinned curve.
    """
    base, P, N = _with_totals(_curve_base(scored, score_col, label_col))
    tp, fp = F.col("cum_pos"), F.col("cum_neg")
    tp0, fp0 = tp - F.col("pos"), fp - F.col("neg")
    step = F.floor(_div(tp0 * points, P)) + F.floor(_div(fp0 * points, N))   # never falls along the order
    prec = _div(tp, tp + fp)
    prec0 = F.when(tp0 + fp0 > 0, tp0.cast("double") / (tp0 + fp0)).otherwise(prec)
    rows = base.select("score", "pos", "neg", tp.alias("tp"), fp.alias("fp"), P.alias("P"), N.alias("N"), step.alias("step"),
                       ((_div(fp, N) - _div(fp0, N)) * (_div(tp, P) + _div(tp0, P)) / 2).alias("roc"),
                       ((_div(tp, P) - _div(tp0, P)) * (prec + prec0) / 2).alias("pr"))
    bins = rows.groupBy("step").agg(F.min("score").alias("threshold"), F.count(F.lit(1)).alias("scores"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg"),
                                    F.max("tp").alias("tp"), F.max("fp").alias("fp"), F.max("P").alias("P"), F.max("N").alias("N"),
                                    F.sum("roc").alias("roc"), F.sum("pr").alias("pr"))
    return bins.select(F.col("step").cast("int").alias("bin"), "threshold", "scores", "pos", "neg", "tp", "fp",
                       F.round(_div(F.col("tp"), F.col("P")), digits).alias("tpr"), F.round(_div(F.col("fp"), F.col("N")), digits).alias("fpr"),
                       F.round(_div(F.col("tp"), F.col("tp") + F.col("fp")), digits).alias("precision"),
                       F.round("roc", digits).alias("roc_area"), F.round("pr", digits).alias("pr_area"))


#: More distinct ids than this are no clustering (their sums are columns of one row).
MOST_CLUSTERS = 1000


def silhouette(df: DataFrame, feature_cols: Sequence[str], cluster_col: str = "prediction",
               digits: int = 6, cluster_ids: Sequence[int] | None = None) -> DataFrame:
    """Mean silhouette with squared Euclidean distance (as ClusteringEvaluator).

    Per-cluster sums (count, feature sums, sum of squared norms: k x (d + 2)
    numbers, like k-means centres) come from one scalar subquery; each point's
    mean distance to a cluster is then a closed form, O(n * k) in one
    projection and one global average - no pairs of points are formed.  With
    ``cluster_ids`` given (k-means: 0..k-1) the plan stays lazy; otherwise the
    k distinct ids are fetched first.
    """
    if cluster_ids is None:
        found = df.select(cluster_col).distinct().limit(MOST_CLUSTERS + 1).collect()
        if len(found) > MOST_CLUSTERS:
            raise ValueError(f"{cluster_col} has more than {MOST_CLUSTERS} values; not a cluster id")
        cluster_ids = sorted(r[0] for r in found)
    if len(cluster_ids) < 2:
        raise ValueError("silhouette needs at least two clusters")
    cid_col = F.col(cluster_col)
    sq = sum((F.col(c) * F.col(c) for c in feature_cols[1:]), F.col(feature_cols[0]) ** 2)
    fields = []
    for j, cid in enumerate(cluster_ids):
        member = cid_col == cid
        fields += [F.count_if(member).alias(f"n{j}"), F.sum(F.when(member, sq)).alias(f"p{j}")]
        fields += [F.sum(F.when(member, F.col(c))).alias(f"y{j}_{i}")
                   for i, c in enumerate(feature_cols)]
    # the subquery is attached once as a column; every later expression refers
    # to columns, so no expression tree repeats the subquery's plan
    out = df.withColumn("_sil_st", df.agg(F.struct(*fields).alias("s")).scalar())

    def stat(name):
        return F.col(f"_sil_st.{name}")

    for j in range(len(cluster_ids)):
        n = stat(f"n{j}")          # empty cluster -> null distance, which least() skips
        dot = sum((F.col(c) * stat(f"y{j}_{i}") for i, c in enumerate(feature_cols)), F.lit(0.0))
        out = out.withColumn(f"_sil_d{j}", sq + F.try_divide(stat(f"p{j}"), n)
                             - 2 * F.try_divide(dot, n))
    own_n, a, b = (F.lit(None).cast("double"),) * 3
    for j, cid in enumerate(cluster_ids):
        n = stat(f"n{j}").cast("double")
        others = [F.col(f"_sil_d{k}") for k in range(len(cluster_ids)) if k != j]
        nearest = others[0] if len(others) == 1 else F.least(*others)
        mine = cid_col == cid
        own_n = F.when(mine, n).otherwise(own_n)
        a = F.when(mine, F.try_divide(F.col(f"_sil_d{j}") * n, n - 1)).otherwise(a)
        b = F.when(mine, nearest).otherwise(b)
    out = out.select(own_n.alias("_own_n"), a.alias("_a"), b.alias("_b"))
    a, b = F.col("_a"), F.col("_b")
    s = (F.when(F.col("_own_n") <= 1, F.lit(0.0))
          .when(a < b, 1 - a / b)
          .when(a > b, b / a - 1)
          .otherwise(F.lit(0.0)))
    return out.agg(F.round(F.avg(s), digits).alias("silhouette"))
