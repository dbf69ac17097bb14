"""Queries: profiling (nulls, summaries, box-plot numbers, correlations)."""

from __future__ import annotations

from ledgerlens.operators import profile
from ledgerlens.plans.oracle import with_fixtures
from ledgerlens.plans.queries import register
from ledgerlens.sources.fixtures import DOC_FEATURE_COLS

_REF_TABLES = {  # name in the analysed workload -> derived table -> its columns
    "txs_classes": ("tx_classes", ["txId", "class"]),
    "txs_edgelist": ("tx_edges", ["txId1", "txId2"]),
    "wallets_classes": ("wallet_classes", ["address", "class"]),
    "addr_addr": ("addr_addr", ["input_address", "output_address"]),
    "addr_tx": ("addr_tx", ["input_address", "txId"]),
    "tx_addr": ("tx_addr", ["txId", "output_address"]),
    "txs_features": ("doc_features", ["txId", "time_step"] + DOC_FEATURE_COLS),
}


def _null_profile_sql() -> str:
    parts = []
    for name, (cte, cols) in _REF_TABLES.items():
        nulls = " + ".join(f"count(*) filter (where {c} is null)" for c in cols)
        parts.append(f"select '{name}' as dataset, count(*) as total_rows, "
                     f"cast({nulls} as bigint) as null_count from {cte}")
    return with_fixtures("\nunion all\n".join(parts), *{v[0] for v in _REF_TABLES.values()})


def _null_columns_sql() -> str:
    parts = []
    for name, (cte, cols) in _REF_TABLES.items():
        for c in cols:
            parts.append(f"select '{name}' as dataset, '{c}' as \"column\", "
                         f"count(*) filter (where {c} is null) as nulls from {cte}")
    return with_fixtures("\nunion all\n".join(parts), *{v[0] for v in _REF_TABLES.values()})


def _long_sql(cols) -> str:
    return " union all ".join(
        f"select '{c}' as \"column\", cast({c} as double) as value from doc_features "
        f"where {c} is not null" for c in cols)


@register("null_profile", _null_profile_sql())
def null_profile(t):
    return profile.null_profile(t.reference_tables())


@register("null_columns", _null_columns_sql())
def null_columns(t):
    return profile.null_columns(t.reference_tables())


@register("feature_summary", with_fixtures(f"""
with long as ({_long_sql(DOC_FEATURE_COLS)})
select "column", count(*) as count, min(value) as min,
       round(quantile_cont(value, 0.25), 6) as p25,
       round(quantile_cont(value, 0.5), 6) as p50,
       round(quantile_cont(value, 0.75), 6) as p75,
       max(value) as max, round(avg(value), 6) as mean, round(stddev_samp(value), 6) as stddev
from long group by "column" """, "doc_features"))
def feature_summary(t):
    return profile.feature_summary(t.doc_features, DOC_FEATURE_COLS)


@register("feature_box_stats", with_fixtures(f"""
with long as ({_long_sql(DOC_FEATURE_COLS)}),
q as (
  select "column", quantile_cont(value, 0.25) as q1, quantile_cont(value, 0.5) as median,
         quantile_cont(value, 0.75) as q3
  from long group by "column"),
f as (select *, q3 - q1 as iqr, q1 - 1.5 * (q3 - q1) as lo_f, q3 + 1.5 * (q3 - q1) as hi_f from q)
select f."column", round(q1, 6) as q1, round(median, 6) as median, round(q3, 6) as q3,
       round(iqr, 6) as iqr,
       round(min(value) filter (where value >= lo_f and value <= hi_f), 6) as whisker_low,
       round(max(value) filter (where value >= lo_f and value <= hi_f), 6) as whisker_high,
       count(*) filter (where value < lo_f or value > hi_f) as outliers
from long join f using ("column")
group by f."column", q1, median, q3, iqr""", "doc_features"))
def feature_box_stats(t):
    return profile.box_stats(t.doc_features, DOC_FEATURE_COLS)


def _corr_sql(cols) -> str:
    parts = []
    for a in cols:
        for b in cols:
            parts.append(f"select '{a}' as a, '{b}' as b, round(corr({a}, {b}), 6) as r "
                         f"from doc_features")
    return with_fixtures("\nunion all\n".join(parts), "doc_features")


@register("feature_correlation", _corr_sql(DOC_FEATURE_COLS))
def feature_correlation(t):
    return profile.correlation_matrix(t.doc_features, DOC_FEATURE_COLS)
