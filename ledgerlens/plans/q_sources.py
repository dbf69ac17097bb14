"""Queries: CSV round trip through the shared folder, table inventory,
prediction sink."""

from __future__ import annotations

from ledgerlens.operators import graph, models
from ledgerlens.plans.oracle import with_fixtures
from ledgerlens.plans.q_metrics import DS_SQL, RULE_SCORE_COL, RULE_THRESHOLD, labelled_ds
from ledgerlens.plans.queries import register
from ledgerlens.session import scratch_path
from ledgerlens.sources import catalog, sinks
from ledgerlens.sources.schemas import TXS_CLASSES
from pyspark.sql import functions as F
from pyspark.sql import types as T

EDGE_CLASS_SCHEMA = T.StructType([
    T.StructField("txId1", T.LongType()), T.StructField("txId2", T.LongType()),
    T.StructField("c1", T.IntegerType()), T.StructField("c2", T.IntegerType()),
])


@register("csv_roundtrip", with_fixtures("""
select e.txId1, e.txId2, c1.class as c1, c2.class as c2
from tx_edges e left join tx_classes c1 on e.txId1 = c1.txId
left join tx_classes c2 on e.txId2 = c2.txId""", "tx_edges", "tx_classes"))
def csv_roundtrip(t):
    """Write a table with nulls as header CSV into the shared folder and read it
    back with an explicit schema."""
    path = scratch_path(t.spark, "csv_roundtrip")
    sinks.write_result(graph.edges_with_classes(t.tx_edges, t.tx_classes), path, fmt="csv")
    return catalog.read_table(t.spark, path, EDGE_CLASS_SCHEMA, fmt="csv")


# Class text of an order status; the text of orders in progress is no class code.
CLASS_TEXT = {"F": "1", "O": "2", "P": "pending"}


@register("quarantine_counts", """
select case o_orderstatus when 'F' then 'class 1' when 'O' then 'class 2' else 'quarantined' end as outcome, count(*) as n_rows
from orders group by 1
union all select 'all', count(*) from orders""")
def quarantine_counts(t):
    """Write classes as header CSV in which some are malformed, read it with a
    quarantine, and count what was read, set aside and (by the counts per file) seen."""
    path = scratch_path(t.spark, "quarantine")
    status = F.create_map(*[F.lit(x) for kv in CLASS_TEXT.items() for x in kv])
    sinks.write_result(t.raw("orders").select(F.col("o_orderkey").alias("txId"), status[F.col("o_orderstatus")].alias("class")), path, fmt="csv")
    q = catalog.read_quarantined(t.spark, path, TXS_CLASSES)
    read = q.rows.groupBy(F.concat(F.lit("class "), F.col("class").cast("string")).alias("outcome")).agg(F.count(F.lit(1)).alias("n_rows"))
    aside = q.rejected.groupBy(F.lit("quarantined").alias("outcome")).agg(F.count(F.lit(1)).alias("n_rows"))
    seen = q.per_file.groupBy(F.lit("all").alias("outcome")).agg(F.sum(F.col("rows_read") + F.col("rows_quarantined")).alias("n_rows"))
    return read.unionByName(aside).unionByName(seen)


def _inventory_sql() -> str:
    from ledgerlens.plans.q_profile import _REF_TABLES
    parts = [f"select '{name}' as \"table\", {len(cols)} as n_cols, count(*) as n_rows from {cte}"
             for name, (cte, cols) in _REF_TABLES.items()]
    return with_fixtures("\nunion all\n".join(parts),
                         *{v[0] for v in _REF_TABLES.values()})


@register("table_inventory", _inventory_sql())
def table_inventory(t):
    return catalog.table_inventory(t.reference_tables())


@register("scored_output", with_fixtures(f"""
with {DS_SQL}
select txId, label, cast(case when {RULE_SCORE_COL} > {RULE_THRESHOLD} then 1 else 0 end as integer)
         as prediction
from ds""", "doc_features"))
def scored_output(t):
    """Write (txId, label, prediction) of the rule score as Parquet and read it back."""
    path = scratch_path(t.spark, "scored_output")
    sinks.write_predictions(models.rule_scored(labelled_ds(t), RULE_SCORE_COL, RULE_THRESHOLD), path)
    return catalog.read_table(t.spark, path)
