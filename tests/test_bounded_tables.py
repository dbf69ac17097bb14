"""Class bitmap, exact strata, bounded curves, quarantine, cluster assignment."""

import hashlib
import random

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.operators import cases, clustering, graph, metrics, sampling, wallets
from ledgerlens.operators.class_bitmap import PAGE_BYTES, class_bitmap, classes_of
from ledgerlens.sources.catalog import read_quarantined
from ledgerlens.sources.reference_csv import CsvTables
from ledgerlens.sources.schemas import TXS_CLASSES


def _graph(spark, ids):
    r = random.Random(4)
    classes = spark.createDataFrame([(i, r.choice([1, 2, 3])) for i in ids] + [(None, 2)], "txId long, class int")
    ends = [*ids, 10 ** 12, -1, None]
    edges = spark.createDataFrame([(r.choice(ends), r.choice(ends)) for _ in range(3000)], "txId1 long, txId2 long")
    return edges, classes


IDS = {"dense": range(-700, 3000), "sparse": [k * 1_000_003 for k in range(-50, 400)], "ends": [-(1 << 63), (1 << 63) - 1, 0, 31, 32, 255, 256]}


@pytest.mark.parametrize("ids", IDS.values(), ids=IDS)
def test_bitmap_lookup_equals_the_join(spark, ids):
    edges, classes = _graph(spark, list(ids))
    bitmap = class_bitmap(classes)
    assert sorted(map(str, graph.edges_with_classes(edges, classes, bitmap).collect())) == sorted(map(str, graph.edges_with_classes(edges, classes).collect()))
    for way in ("out", "in", "both"):
        got, want = (cases.neighbour_counts(edges, classes, way, bitmap=b).collect() for b in (bitmap, None))
        assert sorted(map(str, got)) == sorted(map(str, want))


def test_edges_are_not_shuffled_for_the_lookup(spark):
    edges, classes = _graph(spark, range(3000))
    plan = graph.edges_with_classes(edges, classes, class_bitmap(classes))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 2


def test_bitmap_limit_in_bytes(spark):
    """One page below and above the limit."""
    _, classes = _graph(spark, range(256 * 5))
    assert class_bitmap(classes, limit=5 * PAGE_BYTES) is not None and class_bitmap(classes, limit=5 * PAGE_BYTES - 1) is None


@pytest.mark.parametrize("extra", [(5, 1), (5, None), (9999, 7), (9999, 0), (9999, None)], ids=str)
def test_classes_that_fit_no_bitmap_are_left_to_the_join(spark, extra):
    """An id with two rows (a join repeats its edges), a null or unknown class."""
    _, classes = _graph(spark, range(100))
    assert class_bitmap(classes.union(spark.createDataFrame([extra], "txId long, class int"))) is None


def test_bitmap_of_an_empty_table(spark):
    edges, classes = _graph(spark, range(10))
    bitmap = class_bitmap(classes.limit(0))
    assert bitmap is None or classes_of(edges, "txId1", bitmap, "c").where("c is not null").count() == 0


@pytest.mark.parametrize("options", [{}, {"digits": 1, "most": 2}])
def test_strata_have_exact_sizes_for_any_partitioning(spark, options):
    rows = [(i, 1 if i % 9 == 0 else 0) for i in range(2000)] + [(5000, None), (5001, 2)]
    ds = spark.createDataFrame(rows, "txId long, label int")
    digest = lambda i: hashlib.md5(str(i).encode()).hexdigest()
    pos = [i for i, y in rows if y == 1]
    for ratio in (0.0, 0.5, 1.0, 2.5, 100.0):
        neg = sorted((i for i, y in rows if y == 0), key=digest)[:round(ratio * len(pos))]
        for df in (ds, ds.repartition(7)):
            assert sorted(r.txId for r in sampling.balanced(df, ratio, **options).collect()) == sorted([*pos, *neg, 5000, 5001])
    three = sampling.exact_strata(ds, {0: 10, 1: 20}, **options).groupBy("label").count().collect()
    assert {r.label: r["count"] for r in three} == {0: 10, 1: 20, None: 1, 2: 1}


@pytest.mark.parametrize("points", [1, 10, 64])
def test_binned_curve_is_bounded_and_keeps_the_area(spark, points):
    """Bins end on the full curve, are few, hold all counts, and sum up to its areas."""
    r = random.Random(1)
    rows = [(y, (r.random() + (0.4 if y else 0)) if k % 3 else 0.5) for k in range(6000) for y in [int(r.random() < 0.2)]]   # a third share a score
    df = spark.createDataFrame(rows, "label int, score double").cache()
    got = sorted(metrics.binned_curve(df, points).collect(), key=lambda x: x.bin)
    full = {x.threshold: x for x in metrics.roc_curve(df, digits=9).collect()}
    area = metrics.curve_areas(df, digits=9).first()
    assert len(got) <= 2 * points + 1 < len(full) and sum(x.scores for x in got) == len(full)
    assert sum(x.pos for x in got) == sum(y for y, _ in rows) and sum(x.neg for x in got) == sum(1 - y for y, _ in rows)
    assert sum(x.roc_area for x in got) == pytest.approx(area.auc_roc, abs=5e-7) and sum(x.pr_area for x in got) == pytest.approx(area.auc_pr, abs=5e-7)
    for x in got:
        at = full[x.threshold]
        assert (x.tp, x.fp, x.tpr, x.fpr) == (at.tp, at.fp, at.tpr, at.fpr)
    ends = [(0.0, 0.0), *[(x.tpr, x.fpr) for x in got]]
    widest = max(x.pos for x in full_groups(rows))
    for x in full.values():
        assert min(abs(x.tpr - a) for a, _ in ends) <= 1 / points + widest / got[-1].tp
    assert [x.threshold for x in got] == sorted((x.threshold for x in got), reverse=True)


def full_groups(rows):
    from collections import Counter
    from types import SimpleNamespace
    n = Counter(s for y, s in rows if y)
    return [SimpleNamespace(pos=k) for k in n.values()]


def test_quarantine_counts_every_row(spark, tmp_path):
    """Malformed cells and rows with a wrong number of cells are set aside; rows in = read + quarantined."""
    d = tmp_path / "in"
    d.mkdir()
    (d / "a.csv").write_text("txId,class\n1,2\n2,\nx,1\n3,1,9\n4\n")
    (d / "b.csv").write_text('txId,class\n5,3\n"6",1\n7,one\n')
    (d / "c.csv").write_text("txId,class\n")
    q = read_quarantined(spark, str(d), TXS_CLASSES)
    assert sorted(map(tuple, q.rows.collect()), key=str) == [(1, 2), (2, None), (5, 3), (6, 1)]
    assert sorted((r.file.rsplit("/", 1)[1], r.record) for r in q.rejected.collect()) == [("a.csv", "3,1,9"), ("a.csv", "4"), ("a.csv", "x,1"), ("b.csv", "7,one")]
    assert {r.file.rsplit("/", 1)[1]: (r.rows_read, r.rows_quarantined) for r in q.per_file.collect()} == {"a.csv": (2, 3), "b.csv": (2, 1)}
    assert q.rows.select("class").count() == 4 and q.rejected.select("file").count() == 4    # whichever columns are read


def test_dataset_with_quarantine(spark, tmp_path):
    (tmp_path / "txs_classes.csv").write_text("txId,class\n1,1\n2,suspect\n")
    (tmp_path / "txs_features.csv").write_text("txId,Time step,f\n1,3,0.5\n2,three,0.5\n3,4,\n")
    t = CsvTables(spark, str(tmp_path), quarantine=True)
    assert [tuple(r) for r in t.tx_classes.collect()] == [(1, 1)]
    assert sorted(map(tuple, t.txs_features.collect())) == [(1, 3, 0.5), (3, 4, None)] and t.txs_features.columns == ["txId", "time_step", "f"]
    assert {k: q.rejected.count() for k, q in t.set_aside.items()} == {"tx_classes": 1, "txs_features": 1}
    with pytest.raises(Exception, match="suspect|MALFORMED|malformed"):
        CsvTables(spark, str(tmp_path)).tx_classes.collect()


def test_cluster_assignment_equals_sql_on_the_stored_centres(spark, tables, tmp_path):
    """k-means assigns every wallet to the nearest of its centres, as DuckDB finds from the written tables."""
    wf = wallets.wallet_features(tables.addr_addr, tables.addr_tx, tables.tx_addr, tables.wallet_classes)
    table = clustering.scaled(wf, wallets.WALLET_FEATURES).cache()
    scores, fitted = clustering.kmeans_sweep(table, ks=(2, 4))
    best = scores.orderBy(F.desc("silhouette"), "k").first()["k"]
    centres = [(j, [float(x) for x in c]) for j, c in enumerate(fitted[best].clusterCenters())]
    from pyspark.ml.functions import vector_to_array
    clustering.best_clustering(table, scores, fitted).select("address", "prediction", vector_to_array("features").alias("z")).write.parquet(str(tmp_path / "a"))
    spark.createDataFrame(centres, "cid int, c array<double>").write.parquet(str(tmp_path / "c"))
    wrong, n = duckdb.connect().execute(f"""
        with d as (select address, prediction, cid, list_sum(list_transform(range(1, len(z) + 1), lambda j: (z[j] - c[j]) * (z[j] - c[j]))) as dist
                   from '{tmp_path}/a/*.parquet', '{tmp_path}/c/*.parquet'),
        m as (select address, min(dist) as least, min(dist) filter (cid = prediction) as own from d group by address)
        select count(*) filter (own > least + 1e-9), count(*) from m""").fetchone()
    assert wrong == 0 and n == table.count() > 100


def test_importance_groups_reach_every_family(spark):
    from ledgerlens.plans.queries import queries
    rows = queries()["importance_groups_rule"](spark, "/root/testdata/sf0.01").collect()
    assert {r.group for r in rows} >= {"Local", "Aggregate"} and len(rows) == 4
