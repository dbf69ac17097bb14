"""Edge cases of the graph, neighbour and case operators on hand-made tables."""

from pyspark.sql import functions as F

from ledgerlens.operators import cases, graph
from ledgerlens.operators.profile import histogram

EDGES = [(1, 2), (1, 2), (1, 3), (2, 2), (3, 4), (5, 1), (6, 4)]   # duplicate, self-edge, sink 4
CLASSES = [(1, 1), (2, 2), (3, None), (4, 1), (5, 9), (5, 1)]        # null, class 9, 6 absent


def edges(spark, rows=EDGES):
    return spark.createDataFrame(rows, "txId1 long, txId2 long")


def classes(spark, rows=CLASSES[:-1]):
    return spark.createDataFrame(rows, "txId long, class int")


def test_degree_invariants(spark):
    e = edges(spark)
    n = e.count()
    assert graph.out_degree(e).agg(F.sum("out_degree")).first()[0] == n
    assert graph.in_degree(e).agg(F.sum("in_degree")).first()[0] == n
    tot = {r.txId: r.degree for r in graph.total_degree(e).collect()}
    assert sum(tot.values()) == 2 * n
    assert tot[2] == 4          # two in from 1, self-edge counts out and in
    assert 7 not in tot         # no edge, no row


def test_degree_stats_population_stdev(spark):
    e = edges(spark)
    s = graph.degree_stats(graph.total_degree(e)).first()
    import statistics
    degs = [r.degree for r in graph.total_degree(e).collect()]
    assert s.nodes == len(degs) and s.max_degree == max(degs)
    assert abs(s.stdev_degree - round(statistics.pstdev(degs), 6)) < 1e-9


def test_top_hubs_tie_break(spark):
    deg = spark.createDataFrame([(5, 3), (2, 3), (9, 3), (1, 1)], "txId long, degree long")
    assert [r.txId for r in graph.top_hubs(deg, 2).collect()] == [2, 5]


def test_label_hubs_missing_and_null_class(spark):
    deg = spark.createDataFrame([(3, 5), (6, 4), (1, 3)], "txId long, degree long")
    got = {r.txId: r.label for r in graph.label_hubs(deg, classes(spark)).collect()}
    assert got == {3: "unknown", 6: "unknown", 1: "illicit"}


def test_neighbour_profile_counts_unknown_as_neighbour(spark):
    prof = {r.txId1: r for r in graph.neighbour_profile(edges(spark), classes(spark)).collect()}
    assert prof[1].total_nb == 3 and prof[1].illicit_nb == 0     # 2,2 licit; 3 null
    assert prof[3].illicit_nb_ratio == 1.0                         # 3 -> 4 illicit
    assert 4 not in prof                                           # sink: no out-edge
    assert prof[6].c1 is None                                      # absent source class


def test_cases_use_rounded_ratio(spark):
    n = 25000
    e = spark.range(n).select(F.lit(0).cast("long").alias("txId1"), (F.col("id") + 1).alias("txId2"))
    c = spark.createDataFrame([(0, 1), (1, 1)], "txId long, class int")
    row = cases.fraud_cases(e, c).first()
    assert row.illicit_nb == 1 and row.illicit_ratio == 0.0 and row.case_type == "HARD"


def test_case_summary_partitions_illicit_with_out_edges(spark):
    e, c = edges(spark), classes(spark)
    fc = cases.fraud_cases(e, c)
    illicit_with_edges = (e.join(c.where("class = 1").withColumnRenamed("txId", "txId1"), "txId1")
                           .select("txId1").distinct().count())
    assert fc.count() == illicit_with_edges
    types = {r.txId1: r.case_type for r in fc.collect()}
    assert types == {1: "HARD"}      # 5 has class 9, 3 a null class: not illicit


def test_direction_parameter(spark):
    e, c = edges(spark), classes(spark)
    inn = {r.txId1: r.total_nb for r in cases.neighbour_counts(e, c, "in").collect()}
    both = {r.txId1: r.total_nb for r in cases.neighbour_counts(e, c, "both").collect()}
    assert inn[4] == 2 and both[2] == 4


def test_histogram_keeps_empty_bins_and_max(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (10.0,)], "x double")
    h = {r.bin: r["count"] for r in histogram(df, "x", 5).collect()}
    assert len(h) == 5 and h[0] == 2 and h[4] == 1 and sum(h.values()) == 3


def test_degree_sample_is_bounded_and_reproducible(spark):
    deg = spark.range(1000).select(F.col("id").alias("txId"), F.lit(1).alias("degree"))
    a = sorted(r.txId for r in graph.degree_sample(deg, 50).collect())
    b = sorted(r.txId for r in graph.degree_sample(deg.repartition(7), 50).collect())
    import hashlib
    brute = sorted(sorted(range(1000), key=lambda i: (hashlib.md5(str(i).encode()).hexdigest(), i))[:50])
    assert len(a) == 50 and a == b == brute


def test_null_targets_do_not_divide_by_zero(spark):
    e = spark.createDataFrame([(1, None), (1, None), (2, 1)], "txId1 long, txId2 long")
    c = spark.createDataFrame([(1, 1), (2, 1)], "txId long, class int")
    got = {r.txId1: (r.total_nb, r.illicit_ratio, r.case_type)
           for r in cases.fraud_cases(e, c).collect()}
    assert got == {1: (0, None, "AVERAGE"), 2: (1, 1.0, "EASY")}
