"""Queries: labelled set, split, sampling, scaling, curves and metrics on a
fixed rule score (so every metric is checked against SQL before any model)."""

from __future__ import annotations

from ledgerlens.operators import dataset, metrics, models, sampling, wallets
from ledgerlens.plans.oracle import with_fixtures
from ledgerlens.plans.queries import register
from ledgerlens.session import materialize
from ledgerlens.sources.fixtures import DOC_FEATURE_COLS
from pyspark.sql import functions as F

# Fixed values of the rule score used to check the metric operators.
RULE_SCORE_COL = "f_punct_ratio"
RULE_THRESHOLD = 0.1

_FEATS = ", ".join(f"f.{c}" for c in DOC_FEATURE_COLS)
_NOT_NULL = " and ".join(f"f.{c} is not null" for c in ["txId", "time_step"] + DOC_FEATURE_COLS)
DS_SQL = f"""
ds as (
  select f.txId, f.time_step, {_FEATS}, f.class as label_raw,
         cast(case when f.class = 1 then 1 else 0 end as integer) as label
  from doc_features f
  where f.class in (1, 2) and {_NOT_NULL})"""

SCORED_SQL = f"""
scored as (
  select txId, label, cast({RULE_SCORE_COL} as double) as score,
         cast(case when {RULE_SCORE_COL} > {RULE_THRESHOLD} then 1 else 0 end as double)
           as prediction
  from ds)"""

CURVE_SQL = """
g as (select score, count(*) filter (where label = 1) as pos,
             count(*) filter (where label <> 1) as neg from scored group by score),
c as (select *, sum(pos) over w as cum_pos, sum(neg) over w as cum_neg from g
      window w as (order by score desc rows between unbounded preceding and current row)),
t as (select count(*) filter (where label = 1) as P, count(*) filter (where label <> 1) as N
      from scored)"""

CONF_SQL = """
conf as (select count(*) filter (where label = 1 and prediction = 1) as tp,
                count(*) filter (where label = 0 and prediction = 1) as fp,
                count(*) filter (where label = 1 and prediction = 0) as fn,
                count(*) filter (where label = 0 and prediction = 0) as tn from scored)"""


def labelled_ds(t):
    return dataset.labelled_dataset(t.txs_features, t.doc_classes)


def _scored(t):
    return models.rule_scored(labelled_ds(t), RULE_SCORE_COL, RULE_THRESHOLD)


def _sql(body: str) -> str:
    return with_fixtures(body, "doc_features")


@register("labelled_dataset", _sql(f"with {DS_SQL} select * from ds"))
def labelled_dataset(t):
    return labelled_ds(t)


@register("temporal_split", _sql(f"""
with {DS_SQL}
select txId, time_step, label, case when time_step <= 34 then 'train' else 'test' end as split
from ds"""))
def temporal_split(t):
    ds = labelled_ds(t)
    return ds.select("txId", "time_step", "label", dataset.split_column(ds).alias("split"))


@register("stratified_sample", _sql(f"""
with {DS_SQL}
select txId, label from ds
where label = 1 or cast(('0x' || substr(md5(cast(txId as varchar)), 1, 8)) as bigint) % 100 < 25"""))
def stratified_sample(t):
    return dataset.stratified_sample(labelled_ds(t), {0: 0.25}).select("txId", "label")


_Z = ",\n".join(
    f"round(case when s_{c} > 0 then ({c} - m_{c}) / s_{c} else 0 end, 6) as z_{c}"
    for c in DOC_FEATURE_COLS)
_ST = ", ".join(f"avg({c}) as m_{c}, stddev_samp({c}) as s_{c}" for c in DOC_FEATURE_COLS)


@register("standardised_features", _sql(f"""
with {DS_SQL}, st as (select {_ST} from ds where time_step <= 34)
select txId, {_Z} from ds, st"""))
def standardised_features(t):
    ds = labelled_ds(t)
    train, _ = dataset.temporal_split(ds)
    return models.standardise(train, ds, DOC_FEATURE_COLS, keep=["txId"], prefix="z_", digits=6)


@register("roc_curve", _sql(f"""
with {DS_SQL}, {SCORED_SQL}, {CURVE_SQL}
select score as threshold, cast(cum_pos as bigint) as tp, cast(cum_neg as bigint) as fp,
       round(case when P > 0 then cum_pos / P else 0 end, 6) as tpr,
       round(case when N > 0 then cum_neg / N else 0 end, 6) as fpr
from c, t"""))
def roc_curve(t):
    return metrics.roc_curve(_scored(t))


@register("pr_curve", _sql(f"""
with {DS_SQL}, {SCORED_SQL}, {CURVE_SQL}
select score as threshold,
       round(case when cum_pos + cum_neg > 0 then cum_pos / (cum_pos + cum_neg) else 0 end, 6)
         as precision,
       round(case when P > 0 then cum_pos / P else 0 end, 6) as recall
from c, t"""))
def pr_curve(t):
    return metrics.pr_curve(_scored(t))


@register("auc_pr_rule_score", _sql(f"""
with {DS_SQL}, {SCORED_SQL}, {CURVE_SQL},
p as (
  select cum_pos / P as rec, (cum_pos - pos) / P as rec0,
         cum_neg / N as fpr, (cum_neg - neg) / N as fpr0,
         cum_pos / (cum_pos + cum_neg) as prec,
         case when cum_pos - pos + cum_neg - neg > 0
              then (cum_pos - pos) / (cum_pos - pos + cum_neg - neg)
              else cum_pos / (cum_pos + cum_neg) end as prec0
  from c, t)
select round(sum((fpr - fpr0) * (rec + rec0) / 2), 6) as auc_roc,
       round(sum((rec - rec0) * (prec + prec0) / 2), 6) as auc_pr
from p"""))
def auc_pr_rule_score(t):
    return metrics.curve_areas(_scored(t))


# Feature names of each family, for the family counts of a fixed importance.
FAMILY_NAMES = {"f_chars": "Local_chars", "f_words": "Local_words", "f_digit_ratio": "Aggregate_digits",
                "f_punct_ratio": "Aggregate_punct", "f_distinct_ratio": "distinct_share"}


@register("importance_groups_rule", _sql(f"""
with {DS_SQL},
i as ({" union all ".join(f"select '{n}' as feature, round(abs(corr({c}, label)), 6) as importance from ds" for c, n in FAMILY_NAMES.items())})
select feature, importance, case when feature like 'Local%' then 'Local' when feature like 'Aggregate%' then 'Aggregate'
                                 else 'Augmented' end as "group"
from i order by importance desc, feature limit 4"""))
def importance_groups_rule(t):
    """Families of the top features where a feature's importance is its correlation
    with the label, so that the table can be checked without a model."""
    ds = labelled_ds(t)
    row = ds.agg(*[F.round(F.abs(F.corr(c, "label")), 6).alias(n) for c, n in FAMILY_NAMES.items()])
    cells = F.array(*[F.struct(F.lit(n).alias("feature"), F.col(n).alias("importance")) for n in FAMILY_NAMES.values()])
    return models.importance_groups(row.select(F.inline(cells)), 4)


# Steps of the bounded curve in its query.
CURVE_POINTS = 100


@register("binned_curve", _sql(f"""
with {DS_SQL}, {SCORED_SQL}, {CURVE_SQL},
s as (
  select score, pos, neg, cum_pos, cum_neg, P, N,
         floor((cum_pos - pos) * {CURVE_POINTS} / P) + floor((cum_neg - neg) * {CURVE_POINTS} / N) as step,
         (cum_neg / N - (cum_neg - neg) / N) * (cum_pos / P + (cum_pos - pos) / P) / 2 as roc,
         (cum_pos / P - (cum_pos - pos) / P) * (cum_pos / (cum_pos + cum_neg)
           + case when cum_pos - pos + cum_neg - neg > 0 then (cum_pos - pos) / (cum_pos - pos + cum_neg - neg)
                  else cum_pos / (cum_pos + cum_neg) end) / 2 as pr
  from c, t)
select cast(step as integer) as bin, min(score) as threshold, count(*) as scores,
       cast(sum(pos) as bigint) as pos, cast(sum(neg) as bigint) as neg, cast(max(cum_pos) as bigint) as tp, cast(max(cum_neg) as bigint) as fp,
       round(max(cum_pos) / max(P), 9) as tpr, round(max(cum_neg) / max(N), 9) as fpr,
       round(max(cum_pos) / (max(cum_pos) + max(cum_neg)), 9) as precision, round(sum(roc), 9) as roc_area, round(sum(pr), 9) as pr_area
from s group by step"""))
def binned_curve(t):
    return metrics.binned_curve(_scored(t), CURVE_POINTS)


# Majority rows kept for each minority row.
BALANCE = 1.5


@register("balanced_sample", _sql(f"""
with {DS_SQL}, n as (select cast(round_even({BALANCE} * count(*) filter (where label = 1), 0) as bigint) as keep from ds),
r as (select *, row_number() over (partition by label order by md5(cast(txId as varchar)), txId) as rn from ds)
select txId, label from r, n where label = 1 or rn <= keep"""))
def balanced_sample(t):
    return sampling.balanced(labelled_ds(t), BALANCE).select("txId", "label")


@register("confusion_counts", _sql(f"with {DS_SQL}, {SCORED_SQL}, {CONF_SQL} select * from conf"))
def confusion_counts(t):
    return metrics.confusion_counts(_scored(t))


@register("confusion_matrix", _sql(f"""
with {DS_SQL}, {SCORED_SQL}, {CONF_SQL}
select 'rule' as model, 0 as actual, 0 as predicted, tn as count from conf
union all select 'rule', 0, 1, fp from conf
union all select 'rule', 1, 0, fn from conf
union all select 'rule', 1, 1, tp from conf"""))
def confusion_matrix(t):
    return metrics.confusion_matrix(metrics.confusion_counts(_scored(t)), "rule")


@register("classification_metrics", _sql(f"""
with {DS_SQL}, {SCORED_SQL}, {CONF_SQL},
r as (
  select *, tp + fp + fn + tn as n,
         case when tp + fp > 0 then tp / (tp + fp) else 0 end as p1,
         case when tp + fn > 0 then tp / (tp + fn) else 0 end as r1,
         case when tn + fn > 0 then tn / (tn + fn) else 0 end as p0,
         case when tn + fp > 0 then tn / (tn + fp) else 0 end as r0
  from conf),
f as (
  select *, case when p1 + r1 > 0 then 2 * p1 * r1 / (p1 + r1) else 0 end as f1_1,
            case when p0 + r0 > 0 then 2 * p0 * r0 / (p0 + r0) else 0 end as f1_0
  from r)
select round(case when n > 0 then (tp + tn) / n else 0 end, 6) as accuracy,
       round(case when n > 0 then (f1_1 * (tp + fn) + f1_0 * (tn + fp)) / n else 0 end, 6) as f1,
       round(p1, 6) as precision, round(r1, 6) as recall
from f"""))
def classification_metrics(t):
    return metrics.classification_metrics(_scored(t))


_WF_COLS = wallets.WALLET_FEATURES


def _silhouette_sql() -> str:
    from ledgerlens.plans.q_wallets import _FEATURES_SQL
    cols = _WF_COLS
    st = ", ".join(f"avg({c}) as m{i}, stddev_samp({c}) as s{i}" for i, c in enumerate(cols))
    zs = ", ".join(f"case when s{i} > 0 then ({c} - m{i}) / s{i} else 0 end as z{i}"
                   for i, c in enumerate(cols))
    sq = " + ".join(f"z{i} * z{i}" for i in range(len(cols)))
    ys = ", ".join(f"sum(z{i}) as y{i}" for i in range(len(cols)))
    dot = " + ".join(f"z{i} * cs.y{i}" for i in range(len(cols)))
    return with_fixtures(f"""
with {_FEATURES_SQL},
st as (select {st} from wf),
z as (select address,
             case when out_degree > 50 then 0 when in_degree > 0 then 1 else 2 end as prediction,
             {zs}
      from wf, st),
cs as (select prediction as cid, count(*) as cn, sum({sq}) as psi, {ys} from z group by prediction),
d as (select z.address, z.prediction, cs.cid, cs.cn,
             ({sq}) + cs.psi / cs.cn - 2 * ({dot}) / cs.cn as dist
      from z cross join cs),
pt as (select address,
              max(case when cid = prediction then cn end) as own_n,
              max(case when cid = prediction and cn > 1 then dist * cn / (cn - 1) end) as a,
              min(case when cid <> prediction then dist end) as b
       from d group by address),
sil as (select case when own_n <= 1 then 0.0 when a < b then 1 - a / b
                    when a > b then b / a - 1 else 0.0 end as v from pt)
select round(avg(v), 6) as silhouette from sil""", "addr_addr", "addr_tx", "tx_addr",
                         "wallet_classes")


@register("silhouette_rule_clusters", _silhouette_sql())
def silhouette_rule_clusters(t):
    wf = wallets.wallet_features(t.addr_addr, t.addr_tx, t.tx_addr, t.wallet_classes)
    z = dataset.standardise_columns(wallets.rule_clusters(wf), _WF_COLS)
    # two passes read the standardised table (cluster sums, point distances):
    # write it once to the shared checkpoint folder instead of deriving it twice
    z = materialize(z.select("prediction", *_WF_COLS))
    return metrics.silhouette(z, _WF_COLS, cluster_ids=[0, 1, 2])

