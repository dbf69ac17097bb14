"""The derived reference-shaped tables reproduce the measured facts of the
fixture definitions (row counts, degrees, cases) and the invariants between
operators."""

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import cases, graph, temporal
from ledgerlens.plans.tables import Tables

FACTS = {  # sf dir -> (edges, distinct sources, nodes, max degree, EASY, HARD, AVERAGE, addr_addr)
    "/root/testdata/sf0.001": (5790, 1466, 1473, 24, 24, 114, 343, 6000),
    "/root/testdata/sf0.01": (57986, 14706, 14743, 26, 281, 1268, 3294, 60000),
    "/root/testdata/sf0.1": (579990, 146839, 147236, 33, 2659, 12783, 33151, 600000),
}


@pytest.mark.parametrize("sf_dir", sorted(FACTS))
def test_measured_facts(spark, sf_dir):
    t = Tables(spark, sf_dir)
    e_rows, src, nodes, max_deg, easy, hard, avg, aa = FACTS[sf_dir]
    e = t.tx_edges
    assert e.count() == e_rows
    assert e.select("txId1").distinct().count() == src
    stats = graph.degree_stats(graph.total_degree(e)).first()
    assert (stats.nodes, stats.max_degree) == (nodes, max_deg)
    summary = {r.case_type: r["count"] for r in
               cases.case_summary(cases.fraud_cases(e, t.tx_classes)).collect()}
    assert summary == {"EASY": easy, "HARD": hard, "AVERAGE": avg}
    assert t.addr_addr.count() == aa


def test_temporal_invariants(tables):
    counts = temporal.step_class_counts(temporal.tx_time(tables.tx_steps, tables.tx_classes))
    dist = temporal.temporal_distribution(counts).collect()
    assert dist[-1].cum_total == sum(r.total for r in dist) == tables.tx_classes.count()
    assert dist[-1].cum_illicit == tables.tx_classes.where("class = 1").count()
    assert all(r.illicit + r.licit + r.unknown == r.total for r in dist)
    assert [r.time_step for r in dist] == list(range(1, 50))


def test_pca_components_orthonormal(spark):
    import numpy as np
    from pyspark.ml.feature import PCA, StandardScaler
    from pyspark.ml.functions import array_to_vector
    emb = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    vec = emb.select(array_to_vector(F.col("embedding")).alias("raw"))
    sc = StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True)
    z = sc.fit(vec).transform(vec)
    pc = PCA(k=2, inputCol="features").fit(z).pc.toArray()
    assert np.allclose(pc.T @ pc, np.eye(2), atol=1e-9)
